"""Work that may not grow faster than the input: what is shuffled, and where."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from ratecal.functions.ranking import number_rows
from ratecal.operators import asof, grid, quality, refresh
from ratecal.plans.catalog import QUERIES
from ratecal.schemas import CELL
from ratecal.sources import tables
from ratecal.sources.testtables import TestTables
from test_plans import FOLDER, plan_of

SPINE = ("2023-01-01", "2023-01-05")
QUOTE = "hotel_group string, hotel_name_key string, date_stay date, date_booked date, {} int"


def day(n, month=1):
    return dt.date(2023, month, n)


@pytest.fixture(scope="module")
def quotes(spark):
    cash = [("g", "k", day(8), day(1), 10), ("g", "k", day(8), day(5), 30), (None, "k", day(8), day(2), 7), ("g", "k", day(1, 9), day(1), 9)]
    points = [("g", "k", day(8), day(2), 100), ("g", "only points", day(8), day(2), 5), (None, "k", day(8), day(4), 50)]
    return spark.createDataFrame(cash, QUOTE.format("cash")), spark.createDataFrame(points, QUOTE.format("points"))


def test_sampled_cells_are_made_after_every_shuffle(quotes):
    estimates = asof.sample_estimates(*quotes, *SPINE)
    found = asof.nearest_quotes(grid.sample_base(*quotes, *SPINE), *quotes)
    for df in (estimates, grid.sparse_grid(*quotes, *SPINE), found):
        plan = plan_of(df)
        above = plan[: plan.index("Generate posexplode")]
        # only the quotes' side of the join may have a shuffle there, and nothing is sorted
        assert "Window" not in above and "Sort" not in above and "Aggregate" not in above and "Exchange" not in above


def test_stays_without_quotes_are_not_shuffled(quotes):
    for df in (asof.sample_estimates(*quotes, *SPINE), grid.sparse_grid(*quotes, *SPINE)):
        plan = plan_of(df)
        assert "Exchange" not in plan[: plan.index("Generate inline")]


def test_cells_and_neighbours_of_hotels_without_a_group(quotes):
    cells = {tuple(r)[:4]: r for r in asof.sample_estimates(*quotes, *SPINE).collect()}
    r = cells["g", "k", day(8), day(5)]
    assert (r.cash, r.cash_prev, r.cp_gap, r.cash_next, r.points, r.points_prev, r.pp_gap) == (30, 10, 4, None, None, 100, 3)
    r = cells["g", "k", day(8), day(1)]
    assert (r.cash, r.cash_prev, r.cash_next, r.cn_gap, r.cash_est, r.points_next, r.pn_gap) == (10, None, 30, 4, 30, 100, 1)
    r = cells[None, "k", day(8), day(5)]
    assert (r.cash, r.cash_prev, r.cp_gap, r.points_prev, r.pp_gap) == (None, 7, 3, 50, 1)
    steps = asof.interpolate(asof.nearest_quotes(grid.sample_base(*quotes, *SPINE), *quotes)).collect()
    assert {tuple(r)[:4]: r.asDict() for r in steps} == {k: r.asDict() for k, r in cells.items()}
    assert not any(r.hotel_name_key == "only points" for r in cells.values())
    sparse = {tuple(r)[:4] for r in grid.sparse_grid(*quotes, *SPINE).collect()}
    priced = {tuple(r)[:4] for q in quotes for r in q.select(*CELL).collect()}
    assert sparse == set(cells) | priced


def test_numbers_of_rows_meet_their_runs_without_a_shuffle(spark):
    rows = spark.createDataFrame([("k", i) for i in range(40)] + [(None, i) for i in range(40)], "k string, v int")
    numbered = number_rows(rows, ["k"], F.col("v").desc())
    plan = plan_of(numbered)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {(r.k, r.rn + r.v) for r in numbered.collect()} == {("k", 40), (None, 40)}


def test_weeks_and_combinations_keep_the_width(spark, quotes):
    weeks = quality.week_weekday_fill(*quotes, *SPINE)
    assert "Exchange hashpartitioning(hotel_group" in plan_of(weeks)
    assert re.search(r"hashpartitioning\(hotel_group#\d+, hotel_name_key#\d+, week_booked#\d+, 4\), REPARTITION_BY_NUM", plan_of(weeks))
    assert re.search(r"rangepartitioning\(.*\), REPARTITION_BY_NUM", plan_of(weeks))
    keys = [(r.hotel_group or "", r.week_booked, r.hotel_name_key) for r in weeks.collect()]
    assert keys == sorted(keys) and len(keys) == 4
    docs = spark.createDataFrame([("t", "k", "c", "2023-01-01", dt.datetime(2023, 1, 1), "2")], "input_table string, hotel_name_key string, city string, date string, created_at timestamp_ntz, cash_value string")
    stats = quality.collection_stats(docs)
    assert "REPARTITION_BY_NUM" in plan_of(stats) and tuple(stats.first()) == ("t", 1, 1, 1, 1)


@pytest.mark.parametrize("name", ["incremental_ingest", "first_per_id", "clean_by_chunks", "resumed_ingest", "ingest_figures", "estimates_refreshed"])
def test_source_tables_are_joined_once(spark, monkeypatch, name):
    read, table = [], TestTables.table
    monkeypatch.setattr(TestTables, "table", lambda self, x: read.append(x) or table(self, x))
    QUERIES[name](spark, FOLDER)
    assert read.count("lineitem") == 1


def test_stored_tables_hold_the_same_rows(spark):
    t = TestTables(spark, FOLDER)
    for ours, theirs in ((t.stored().documents(), t.documents()), (t.stored().points_raw(), t.points_raw())):
        assert ours.dtypes == theirs.dtypes and ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


@pytest.mark.parametrize("spine", [("2023-01-01", "2023-01-20"), ("2024-02-20", "2024-03-03"), ("2023-02-27", "2024-03-02")])
def test_dense_grid_unpacks_runs_of_days(spark, spine):
    def cell(stay, booked, price, key="k"):
        return ("g", key, "c", dt.date.fromisoformat(stay), dt.date.fromisoformat(booked), price)

    cash = [cell("2024-02-29", d, n) for n, d in enumerate(["2023-02-28", "2023-03-01", "2024-02-20", "2024-02-29"])]
    cash += [cell("2025-02-28", "2024-02-29", 5), cell("2025-02-28", "2024-02-28", 6), cell("2023-01-09", "2023-01-09", 7, "one"), cell("2029-01-01", "2023-01-01", 8)]
    points = [cell("2024-02-29", "2024-02-21", 50), cell("2024-02-29", "2024-02-20", 60), cell("2024-02-29", "2024-02-20", 1, "only points")]
    schema = "hotel_group string, hotel_name_key string, city string, date_stay date, date_booked date, {} int"
    quotes = spark.createDataFrame(cash, schema.format("cash")), spark.createDataFrame(points, schema.format("points"))
    cells = grid.dense_grid(*quotes, *spine)
    plan = plan_of(cells)
    assert re.search(r"Generate explode\(sequence\(from#\d+, to#\d+.*Generate inline", plan, re.S) and "array_except" not in plan

    priced = [{(r[1], r[3], r[4]): r[5] for r in rows} for rows in (cash, points)]
    first, last = map(dt.date.fromisoformat, spine)
    expected = set()
    for n in range((last - first).days + 1):
        booked = first + dt.timedelta(n)
        until = booked.replace(year=booked.year + 1) if (booked.month, booked.day) != (2, 29) else dt.date(booked.year + 1, 2, 28)
        for ahead in range((until - booked).days):
            stay = booked + dt.timedelta(ahead)
            expected |= {("g", key, stay, booked, ahead, *(p.get((key, stay, booked)) for p in priced)) for key in ("k", "one")}
    found = [tuple(r) for r in cells.collect()]
    assert len(found) == len(expected) and set(found) == expected
    twice = grid.dense_grid_v1(quotes[0], quotes[1].unionByName(quotes[1]), *spine)
    assert twice.count() == len(expected) + sum(x[6] is not None for x in expected)


@pytest.mark.parametrize("name", ["hotel_grid", "hotel_grid_v1"])
def test_cells_without_a_price_are_kept_from_the_sums(spark, name):
    assert len(re.findall(r"partial_sum\([^F]*\) FILTER \(WHERE", plan_of(QUERIES[name](spark, FOLDER)))) == 3


def test_arrivals_write_their_changes_only(spark, monkeypatch):
    written, overwrite, write_run = [], tables.overwrite, tables.write_run
    monkeypatch.setattr(tables, "overwrite", lambda df, path, **x: written.append(path.split("/")[-2:]) or overwrite(df, path, **x))
    monkeypatch.setattr(tables, "write_run", lambda df, path, schema, run: written.append([run, path.split("/")[-1]]) or write_run(df, path, schema, run))
    plan = plan_of(QUERIES["estimates_refreshed"](spark, FOLDER))
    assert [w for w in written if w[1] == "estimates"] == [["0", "estimates"]]
    assert [w for w in written if w[1] == "changes"] == [[k, "changes"] for k in (1, 2, 3)]
    # all arrivals meet the first table in one join, without sorting it
    assert plan.count("LeftAnti") == 1 and re.search(r"ShuffledHashJoin .*LeftAnti, BuildRight", plan) and plan.count("FILTER (WHERE") >= 12


def test_first_estimates_with_changes_equal_a_rebuild(spark, tmp_path):
    schema = QUOTE + ", created_at timestamp_ntz, _id string"

    def table(price, rows, seen):
        rows = [(*r, dt.datetime(2023, 1, seen), f"{seen}-{n}") for n, r in enumerate(rows)]
        return spark.createDataFrame(rows, schema.format(price))

    def keep(name, rows):
        rows.write.parquet(f"{tmp_path}/{k}/{name}")
        return spark.read.parquet(f"{tmp_path}/{k}/{name}")

    cash = table("cash", [("g", "k", day(8), day(1), 10), (None, "k", day(8), day(2), 7), ("g", "m", day(9), day(1), 5)], 1)
    points = table("points", [("g", "k", day(8), day(2), 100)], 1)
    arrivals = [
        ([("g", "k", day(8), day(5), 30)], [("g", "k", day(8), day(4), 50)]),
        ([("g", "k", day(8), day(5), 31), ("g", "new", day(8), day(3), 4)], []),  # a later price for a cell that has changed, and a new hotel
        ([("g", "new", day(8), day(1), 6), ("g", "k", day(8), day(3), 20)], [("g", "m", day(9), day(2), 9)]),
    ]
    first = estimates = asof.sample_estimates(cash, points, *SPINE).checkpoint()
    for k, (new_cash, new_points) in enumerate(arrivals, 1):
        now = refresh.refresh(estimates, cash, points, table("cash", new_cash, k + 1), table("points", new_points, k + 1), *SPINE, keep=keep)
        tables.write_run(now.changes, f"{tmp_path}/changes", now.changes.schema, k)
        assert now.changes.select(*CELL).exceptAll(now.touched).isEmpty() and now.touched.exceptAll(now.changes.select(*CELL)).isEmpty()
        cash, points = now.cash, now.points
        estimates = refresh.current(first, spark.read.parquet(f"{tmp_path}/changes"))
        rebuilt = asof.sample_estimates(cash, points, *SPINE)
        for table_ in (estimates, now.estimates):
            assert table_.columns == rebuilt.columns and table_.exceptAll(rebuilt).isEmpty() and rebuilt.exceptAll(table_).isEmpty()


def test_accounted_documents_are_parsed_once(spark, monkeypatch):
    read, table = [], TestTables.table
    monkeypatch.setattr(TestTables, "table", lambda self, x: read.append(x) or table(self, x))
    plan = plan_of(QUERIES["cash_accounted"](spark, FOLDER))
    assert read.count("lineitem") == 1 and "Join" not in plan
    assert plan.count("parseJson") == plan.count("schemaOfVariant") == plan.count("$.amount") == plan.count("$.currency") == 1


def test_changes_meet_the_first_table_by_stay(spark):
    schema = QUOTE.format("cash")
    first = spark.createDataFrame([("g", "k", day(8), day(n), n) for n in range(1, 5)] + [(None, "k", day(8), day(1), 9)], schema)
    changes = [("g", "k", day(8), day(2), 20, 1), ("g", "k", day(8), day(2), 21, 2), ("g", "k", day(8), day(7), 70, 1), (None, "k", day(8), day(1), 8, 1)]
    now = refresh.current(first, spark.createDataFrame(changes, schema + ", run int"))
    assert sorted(r["cash"] for r in now.collect()) == [1, 3, 4, 8, 9, 21, 70]
    join = re.search(r"ShuffledHashJoin \[(.*?)\], .*LeftAnti", plan_of(now))
    assert join and "date_stay" in join[1] and "date_booked" not in join[1]
