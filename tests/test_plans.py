"""What the plans look like: shuffles, pushed filters, no nested-loop joins."""

import re

import pytest

import __spark_entry__ as entry
from ratecal.operators import asof, clean, grid
from ratecal.plans.catalog import QUERIES, SPINE
from ratecal.sources import collections as src
from ratecal.sources.testtables import TestTables

FOLDER = "/root/testdata/sf0.001"


def plan_of(df, mode="simple"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def exchanges(df):
    return len(re.findall(r"\bExchange (?:hash|range|Single)", plan_of(df)))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stored"))
    t = TestTables(spark, FOLDER)
    t.cash_raw().write.parquet(f"{folder}/raw")
    clean.cash_quotes(t.cash_raw()).write.parquet(f"{folder}/cash")
    clean.points_quotes(t.points_raw()).write.parquet(f"{folder}/points")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in ("raw", "cash", "points")}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("append_table", "csv_export", "incremental_ingest", "dupe_rows")])
def test_no_query_pairs_rows_without_keys(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "PythonUDF" not in plan and "InPandas" not in plan


def test_newest_is_limited_before_the_shuffle(stored):
    plan = plan_of(clean.cash_quotes(stored["raw"]))
    final, partial = plan.index(", Final"), plan.index(", Partial")
    assert final < plan.index("Exchange") < partial
    assert exchanges(clean.cash_quotes(stored["raw"])) == 1


def test_cleaning_filters_reach_the_scan(stored):
    plan = plan_of(clean.cash_quotes(stored["raw"]), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "GreaterThan(cash_value,1" in pushed and "EqualTo(currency,USD)" in pushed
    schema = re.search(r"ReadSchema: (.*)", plan).group(1)
    assert "award_category" not in schema and "hotel_name:" not in schema


def test_estimates_take_one_shuffle_of_cells_and_quotes(stored):
    # two for the hotel list (its distinct, and spreading it out), one for everything else
    assert exchanges(asof.sample_estimates(stored["cash"], stored["points"], *SPINE)) == 3


def test_dense_grid_shuffles_no_cells(stored):
    cells = grid.dense_grid(stored["cash"], stored["points"], *SPINE)
    plan = plan_of(cells)
    assert "Exchange" not in plan[: plan.index("Generate inline")]
    # nor do windows over a stay's booking days
    assert exchanges(asof.adjacent_interpolation(cells)) == exchanges(cells)


def test_time_and_id_ranges_are_scan_filters(stored):
    copied = plan_of(src.window_copy(stored["raw"], "hotel_calendar_x", "1998-01-01", "1998-02-01"), "formatted")
    assert "GreaterThanOrEqual(created_at" in copied and "LessThan(created_at" in copied
    assert "Subquery" in plan_of(src.id_range(stored["raw"], "1998-01-01", "1998-02-01"))
