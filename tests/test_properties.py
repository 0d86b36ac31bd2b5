"""Operators against brute force and against each other, on whole test tables or skewed rows."""

from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from benchmarks.designs import band_join, joined_grid
from ratecal.functions.frames import newest
from ratecal.functions.ranking import number_rows
from ratecal.operators import asof, clean, grid
from ratecal.plans.catalog import SPINE
from ratecal.schemas import CELL
from ratecal.sources.testtables import TestTables
from rows import clean as clean_rows

MONTH = ("1998-02-01", "1998-03-05")


@pytest.fixture(scope="module")
def quotes(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("clean")
    t = TestTables(spark, "/root/testdata/sf0.001")
    for name, df in (("cash", clean.cash_quotes(t.cash_raw())), ("points", clean.points_quotes(t.points_raw()))):
        df.write.parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/cash"), spark.read.parquet(f"{folder}/points")


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_clean_tables_are_unique_on_their_key(quotes):
    for df in quotes:
        assert df.groupBy(*CELL).count().filter("count > 1").count() == 0


def test_neighbours_equal_the_band_join(spark, quotes):
    cash, points = quotes
    # quotes moved by some days, so that stays have many
    shift = F.explode(F.array(*map(F.lit, (0, 1, 4, 9, 40))))
    dense = cash.select("hotel_group", "hotel_name_key", "date_stay", F.col("date_booked").alias("d"), "cash", shift.alias("s"))
    dense = dense.withColumn("date_booked", F.date_sub("d", F.col("s"))).groupBy(*CELL).agg(F.max("cash").alias("cash"))
    cells = dense.select(*CELL).union(points.select(*CELL)).distinct()
    ours = asof.nearest_quotes(cells, dense, points).select(*CELL, "cash_prev", "cash_next")
    assert same(ours, band_join(cells, dense))


def test_estimates_lie_between_their_neighbours(quotes):
    est = asof.sample_estimates(*quotes, *SPINE)
    outside = est.filter("cash_est < least(cash_prev, cash_next) OR cash_est > greatest(cash_prev, cash_next)")
    assert est.filter("cash_est IS NOT NULL").count() > 0 and outside.count() == 0


def test_fused_estimates_equal_the_steps(quotes):
    steps = asof.interpolate(asof.nearest_quotes(grid.sample_base(*quotes, *MONTH), *quotes))
    assert same(asof.sample_estimates(*quotes, *MONTH), steps)


def test_estimates_for_many_offsets(quotes):
    many = tuple(range(1, 60))
    steps = asof.interpolate(asof.nearest_quotes(grid.sample_base(*quotes, *MONTH, many), *quotes))
    assert same(asof.sample_estimates(*quotes, *MONTH, many), steps)
    few = asof.sample_estimates(*quotes, *MONTH, many[:20])
    assert few.count() > 0 and same(few, steps.filter("booking_window <= 20"))


def test_offset_cells_equal_the_filtered_grid(quotes):
    assert same(grid.sample_base(*quotes, *MONTH), grid.at_windows(grid.dense_grid(*quotes, *MONTH)))


def test_dense_grid_equals_the_joins(quotes):
    ours = grid.dense_grid(*quotes, *SPINE).select(*CELL, "cash", "points").filter("date_booked BETWEEN '1995-12-25' AND '1996-03-05'")
    theirs = joined_grid(*quotes).filter("date_booked BETWEEN '1995-12-25' AND '1996-03-05'")
    assert ours.count() > 0 and same(ours, theirs)


def test_observed_cells_equal_the_filtered_grid(quotes):
    assert same(grid.observed_cells(*quotes, *SPINE), grid.with_price(grid.dense_grid(*quotes, *SPINE)))


def test_sparse_grid_holds_the_sample_and_all_quotes(quotes):
    cash, points = quotes
    sparse = grid.sparse_grid(cash, points, *MONTH)
    assert sparse.groupBy(*CELL).count().filter("count > 1").count() == 0
    assert grid.sample_base(cash, points, *MONTH).exceptAll(sparse).count() == 0
    for df in (cash, points):
        assert df.select(*CELL).exceptAll(sparse.select(*CELL)).count() == 0


# One key holds most rows.

@pytest.fixture(scope="module")
def skewed(spark):
    return spark.range(20_000).select(
        F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 3 == 2, F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") * 7919 % 101).cast("int").alias("v"),
        (F.col("id") % 4000).cast("string").alias("_id"),
    ).withColumn("k", F.when(F.col("v") == 7, None).otherwise(F.col("k")))


def test_row_numbers_of_a_hot_key(skewed):
    w = Window.partitionBy("k").orderBy(F.col("v").desc(), F.col("_id").desc())
    expected = skewed.withColumn("rn", F.row_number().over(w))
    assert same(number_rows(skewed, ["k"], F.col("v").desc(), F.col("_id").desc()), expected)


def test_row_numbers_cut_a_hot_key_into_runs(spark, skewed):
    ranged = skewed.repartitionByRange(4, "k", "v").withColumn("p", F.spark_partition_id())
    assert ranged.filter("k = 'hot'").select("p").distinct().count() > 1


def test_newest_of_a_hot_key(skewed):
    expected = skewed.groupBy("k").agg(F.max(F.struct("v", "_id")).alias("m")).select("k", "m.v", "m._id")
    assert same(newest(skewed, ["k"], F.col("v").desc(), F.col("_id").desc()), expected)


def test_interpolation_is_exact_for_long_gaps(spark):
    base = clean_rows(spark, "cash", [("h", "2030-01-01", "2020-01-02", 1)]).drop("cash")
    cash = clean_rows(spark, "cash", [("h", "2030-01-01", "2020-01-01", "10.00"), ("h", "2030-01-01", "2027-01-01", "10.01")])
    points = clean_rows(spark, "points", [("h", "2030-01-01", "2020-01-01", 1000), ("h", "2030-01-01", "2020-01-03", 1001)])
    row = asof.interpolate(asof.nearest_quotes(base, cash, points)).first()
    assert (row.cash_est, row.points_est) == (Decimal("10.0000"), Decimal("1001.0000"))
