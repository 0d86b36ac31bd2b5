"""As-of neighbours of keys of any size, copies replaced by window, and batch resume by key, against plain Python."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ratecal.operators.asof_runs import neighbours_of_any_size
from ratecal.schemas import CASH_DOCUMENT
from ratecal.sources import resume, windows

START = datetime(2023, 1, 1)


def _at(minutes):
    return None if minutes is None else START + timedelta(minutes=minutes)


@pytest.mark.parametrize("seed", range(2))
def test_neighbours_equal_plain_search(spark, seed):
    random.seed(seed)
    keys = ["hot"] * 6 + ["a", "b", None]
    quotes = [(random.choice(keys), _at(random.choice([None, *range(200)])), random.choice([None, 1, 2, 3]), str(i)) for i in range(400)]
    rows = [(random.choice([*keys, "none"]), _at(random.choice([None, *range(210)])), i % 300) for i in range(600)]
    best = {}
    for key, at, price, i in quotes:
        if at is not None and price is not None:
            best[key, at] = max(best.get((key, at), ("", 0)), (i, price))

    def expected(key, at):
        if at is None:
            return (None,) * 4
        before = max((t for k, t in best if k == key and t < at), default=None)
        after = min((t for k, t in best if k == key and t > at), default=None)
        return tuple(x for t in (before, after) for x in ((best[key, t][1], t) if t else (None, None)))

    left = spark.createDataFrame(rows, "k string, t timestamp_ntz, price_prev_seen int")
    right = spark.createDataFrame(quotes, "k string, t timestamp_ntz, price int, _id string")
    got = neighbours_of_any_size(left.repartition(3), right.repartition(3), ("k",), "t", "price")
    found = sorted((tuple(r) for r in got.select(*left.columns, "price_prev", "price_prev_at", "price_next", "price_next_at").collect()), key=repr)
    assert found == sorted(((k, t, n, *expected(k, t)) for k, t, n in rows), key=repr)


def test_neighbours_lie_in_many_runs(spark):
    """Every second minute has a quote, all of one key: the runs' cuts are bridged, and no task holds the key."""
    n = 20_000
    times = lambda m: spark.range(m).select(F.lit("hot").alias("k"), "id")
    at = lambda c: (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(mins=c)).alias("t")
    left = times(n).select("k", "id", at(F.col("id").cast("int")))
    right = times(n // 2).select("k", at((2 * F.col("id")).cast("int")), F.col("id").alias("price"), F.col("id").cast("string").alias("_id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = neighbours_of_any_size(left, right, ("k",), "t", "price")
        odd = F.col("id") % 2 == 1
        prev = F.when(odd, (F.col("id") - 1) / 2).otherwise(F.col("id") / 2 - 1)
        nxt = prev + F.when(odd, 1).otherwise(2)
        prev, nxt = F.when(prev >= 0, prev), F.when(nxt < n // 2, nxt)
        wrong = got.filter(~(F.col("price_prev").eqNullSafe(prev) & F.col("price_next").eqNullSafe(nxt)))
        assert got.count() == n and wrong.count() == 0
        sizes = [len(x) for x in got.select("id").rdd.glom().collect()]
        assert max(sizes) < 0.7 * n
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("nothing", ["rows", "quotes", "both"])
def test_neighbours_of_empty_tables(spark, nothing):
    left = spark.createDataFrame([("a", START, 1)], "k string, t timestamp_ntz, x int")
    right = spark.createDataFrame([("a", _at(5), 2, "1")], "k string, t timestamp_ntz, price int, _id string")
    left, right = left.limit(0) if nothing != "quotes" else left, right.limit(0) if nothing != "rows" else right
    got = neighbours_of_any_size(left, right, ("k",), "t", "price").collect()
    assert [tuple(r)[3:] for r in got] == ([(None,) * 4] if nothing == "quotes" else [])


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_only_the_window_is_replaced(spark, tmp_path):
    path = str(tmp_path / "copy")

    def docs(*rows):
        return spark.createDataFrame([(i, None if t is None else datetime.fromisoformat(t)) for i, t in rows], "_id string, created_at timestamp_ntz")

    def stored():
        return sorted(r._id for r in windows.read_copy(spark, path, docs().schema).collect())

    first = docs(("1", "2023-01-01T10:00"), ("2", "2023-01-02T10:00"), ("3", "2023-01-02T18:00"), ("4", "2023-01-03T09:00"), ("5", "2023-01-04T09:00"), ("6", None))
    windows.replace_window(first, path, "2023-01-01", "2023-01-05")
    assert stored() == ["1", "2", "3", "4", "5"]
    before = _files(path)
    # 3 and 4 lie in the window and are gone from the source: a part of one day, and a day that holds nothing else
    again = docs(("2", "2023-01-02T10:00"), ("7", "2023-01-02T20:00"), ("8", "2023-01-09T09:00"))
    for _ in range(2):
        windows.replace_window(again, path, "2023-01-02T12:00", "2023-01-04")
        assert stored() == ["1", "2", "5", "7"]
    kept = {f for f in before if "2023-01-01" in f or "2023-01-04" in f}
    assert kept <= _files(path) and not any("2023-01-03" in f for f in _files(path))
    windows.replace_window(docs(), path, "2023-01-01", "2023-01-02")
    assert stored() == ["2", "5", "7"]


def _docs(spark, *rows):
    data = [{"_id": i, "hotel_id": i, "hotel_name_key": "k", "date": day, "cash_value": '{"amount":"5","currency":"USD"}'} for i, day in rows]
    return spark.createDataFrame(data, CASH_DOCUMENT).withColumn("created_at", F.lit("2023-01-01").cast("timestamp_ntz"))


def test_resume_behind_the_last_key(spark, tmp_path):
    target, name = str(tmp_path), "hotel_calendar_cash_g"
    run = lambda docs, n: resume.ingest_behind(spark, docs, target, "cash", name, n, "2024-01-01 00:00:00")
    kept = lambda: sorted(r._id for r in resume.read_resumed(spark, target, "cash").collect())
    figures = lambda: sorted((tuple(r)[1:] for r in resume.read_figures(spark, target).collect()))
    assert run(_docs(spark), 1) == 0 and figures() == []
    rows = [("01", "2023-05-01"), ("02", "bad"), (None, "2023-05-01")]
    assert run(_docs(spark, *rows), 1) == 2 and kept() == ["01"]
    rows += [("03", "bad"), ("04", None)]  # nothing valid: the key moves on all the same
    assert run(_docs(spark, *rows), 2) == 2 and kept() == ["01"]
    rows += [("05", "2023-05-01"), ("05", "2023-05-01")]
    assert run(_docs(spark, *rows), 3) == 2 and kept() == ["01", "05"]
    assert run(_docs(spark, *rows), 4) == 0
    assert figures() == [("1", None, "02", 2, 1, 1), ("2", "02", "04", 2, 0, 2), ("3", "04", "05", 2, 1, 1)]
    # a run that failed before its figures were written is repeated from the same key, with what has arrived since
    for d, _, files in os.walk(tmp_path / "figures"):
        if any("05" == r[3] for r in (tuple(x) for x in (spark.read.parquet(d).collect() if any(f.endswith(".parquet") for f in files) else []))):
            os.rename(d, tmp_path / "_lost")
    rows += [("06", "2023-05-02")]
    assert run(_docs(spark, *rows), 5) == 3 and kept() == ["01", "05", "06"]
    assert figures()[-1] == ("5", "04", "06", 3, 2, 1)
    # another collection starts from its own first key
    assert resume.ingest_behind(spark, _docs(spark, ("00", "2023-05-01")), target, "cash", "hotel_calendar_cash_h", 1, "2024-01-01 00:00:00") == 1
