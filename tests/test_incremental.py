"""Accounted cleaning, refreshed estimates, merged chunks and copies across a stream's chunks, on small tables."""

import os
import random
import time
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecal.operators import accounting, asof, refresh
from ratecal.schemas import CASH_DOCUMENT, CELL
from ratecal.sources import current
from ratecal.streaming import deduplicate
from rows import clean, raw_cash

DOCS = [
    ("1", "2023-05-01", '{"amount":"120.5","currency":"USD"}', None), ("2", "01/05/2023", '{"amount":99,"currency":"EUR"}', None),
    ("3", "2023-13-01", '{"amount":"1"}', "stay date does not parse"), ("4", None, '{"amount":"1"}', "stay date does not parse"),
    ("5", "2023-05-01", None, "no price"), ("6", "2023-05-01", "120.5", "price is no object"), ("7", "2023-05-01", "null", "price is no object"),
    ("8", "2023-05-01", '{"amount": ', "price is no object"), ("9", "2023-05-01", '["amount"]', "price is no object"), ("10", "2023-05-01", '{"currency":"USD"}', "no amount"),
    ("11", "2023-05-01", '{"amount":"x"}', "amount is no number"), ("12", "2023-05-01", '{"amount":1e20}', "amount out of range"), ("13", "2023-05-01", '{"amount":{"a":1}}', "amount is no number"),
    ("14", "2023-05-01", '  {"amount":"7"}', None), ("14", "2023-05-01", '  {"amount":"7"}', None), (None, "2023-05-01", "", "price is no object"),
]


def test_every_document_is_accounted_for(spark):
    docs = spark.createDataFrame([(i, day, price) for i, day, price, _ in DOCS], "_id string, date string, cash_value string").withColumns(
        {"hotel_group": F.lit("g"), "input_table": F.lit("t"), "created_at": F.lit("2023-01-01").cast("timestamp_ntz")}
    )
    judged = accounting.judge_cash(docs, ("yyyy-MM-dd", "dd/MM/yyyy"))
    assert sorted(((r._id, r._reason) for r in judged.collect()), key=str) == sorted(((i, why) for i, _, _, why in DOCS), key=str)
    kept, aside = accounting.kept_cash(judged).collect(), accounting.quarantine(judged).collect()
    assert len(kept) + sum(r.dropped for r in aside) == len(DOCS)
    prices = {r._id: (r.date, r.cash_value and float(r.cash_value)) for r in kept}
    assert prices["2"] == (date(2023, 5, 1), 99.0) and prices["14"][1] == 7.0 and prices["12"][1] is None
    assert {r._id for r in aside if not r.dropped} == {"10", "11", "12", "13"} and {r._id: r.value for r in aside}["6"] == "120.5"
    counts = accounting.ledger(judged, "input_table").collect()
    assert sum(r.n for r in counts) == len(DOCS) and {r.outcome: r.n for r in counts}["kept"] == 4
    assert accounting.ledger(judged.limit(0)).collect() == []


def _quotes(spark, price, rows):
    extra = {"created_at": F.lit("2023-01-01").cast("timestamp_ntz"), "_id": F.monotonically_increasing_id().cast("string")}
    return clean(spark, price, rows).withColumns(extra)


@pytest.mark.parametrize("seed", range(3))
def test_refresh_equals_rebuild(spark, seed):
    random.seed(seed)
    spine, day = ("2023-01-01", "2023-02-15"), date(2023, 1, 1)

    def some(n, keys):
        found = {}
        for _ in range(n):
            stay = day + timedelta(random.randrange(60))
            found[random.choice(keys), stay, stay - timedelta(random.randrange(1, 50))] = random.randrange(2, 500)
        return [(k, str(s), str(b), p) for (k, s, b), p in found.items()]

    cash, points = _quotes(spark, "cash", some(150, "ab")), _quotes(spark, "points", some(120, "abc"))
    estimates = asof.sample_estimates(cash, points, *spine).checkpoint()
    for arrivals in ("ab", "abc", "d"):
        later = {"created_at": F.lit("2023-06-01").cast("timestamp_ntz")}
        new_cash = _quotes(spark, "cash", some(12, arrivals)).withColumns(later)
        new_points = _quotes(spark, "points", some(9, arrivals)).withColumns(later)
        now = refresh.refresh(estimates, cash, points, new_cash, new_points, *spine)
        before, estimates, cash, points = estimates, now.estimates.checkpoint(), now.cash.checkpoint(), now.points.checkpoint()
        rebuilt = asof.sample_estimates(cash, points, *spine)
        assert estimates.exceptAll(rebuilt).count() == 0 and rebuilt.exceptAll(estimates).count() == 0
        touched = now.touched.distinct()
        changed = rebuilt.exceptAll(before).select(*CELL)
        assert now.touched.count() == touched.count() and changed.join(touched, list(CELL), "left_anti").count() == 0
        if arrivals == "ab":
            assert 0 < touched.count() < rebuilt.count() / 2
    nothing = refresh.refresh(estimates, cash, points, cash.limit(0), points.limit(0), *spine)
    assert nothing.touched.count() == 0 and nothing.estimates.exceptAll(estimates).count() == 0


@pytest.mark.parametrize("spine", [("2023-01-30", "2023-03-02"), ("2024-02-28", "2024-03-01"), ("2023-01-01", "2023-01-01")])
def test_adjacent_summary_equals_the_dense_grid(spark, spine):
    from ratecal.functions.calendar import month_of
    from ratecal.operators.grid import dense_grid

    random.seed(7)
    first, days = date.fromisoformat(spine[0]), (date.fromisoformat(spine[1]) - date.fromisoformat(spine[0])).days

    def some(n, keys):
        out = {}
        for _ in range(n):
            booked = first + timedelta(random.randrange(days + 1))
            stay = booked + timedelta(random.choice([0, 1, 2, 3, 300, 364, 365, 366]))
            out[random.choice(keys), stay, booked] = random.randrange(2, 5000) / 100
        return [(k, str(s), str(b), p) for (k, s, b), p in out.items()]

    cash, points = clean(spark, "cash", some(120, "ab")), clean(spark, "points", some(90, "abc"))
    rows = asof.adjacent_interpolation(dense_grid(cash, points, *spine)).groupBy("hotel_group", "hotel_name_key", month_of("date_booked").alias("month_booked"))
    sums = [f(c).alias(n) for p in ("cash", "points") for f, c, n in (
        (F.count, f"est_{p}", f"est_{p}_n"), (F.sum, f"est_{p}", f"est_{p}"), (F.sum, f"est_{p}_gap", f"est_{p}_gap"), (F.max, f"est_{p}_error", f"est_{p}_error"),
    )]
    slow = rows.agg(F.count(F.lit(1)).alias("cells"), *sums)
    fast = asof.adjacent_summary(cash, points, *spine)
    key = lambda df: sorted((tuple(map(lambda v: v if v is None or isinstance(v, (str, date)) else float(v), r)) for r in df.select(*sorted(slow.columns)).collect()), key=repr)
    assert key(fast) == key(slow) and key(fast)


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_chunks_rewrite_only_their_days(spark, tmp_path):
    from ratecal.operators.clean import cash_quotes

    path = str(tmp_path / "cash")
    chunks = [
        [("1", "a", "2023-05-09", "2023-05-01 10:00:00", 100), ("2", "a", "2023-05-09", "2023-05-02 10:00:00", 101)],
        [("3", "a", "2023-05-09", "2023-05-01 09:00:00", 50), ("4", "b", "2023-05-09", "2023-05-01 11:00:00", 60)],  # late: older than 1
        [("5", "a", "2023-05-09", "2023-05-02 11:00:00", 102), ("6", "a", "2023-05-10", "2023-05-03 10:00:00", 103)],
    ]
    seen = []
    for k, rows in enumerate(chunks):
        before = _files(path)
        current.merge_quotes(cash_quotes(raw_cash(spark, rows)), path, "cash")
        seen += rows
        expected = cash_quotes(raw_cash(spark, seen)).select("hotel_name_key", "date_stay", "date_booked", "cash", "_id")
        got = current.read_current(spark, path, "cash").select(*expected.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
        days = {r[3][:10] for r in rows}
        assert all(any(f"date_booked={d}" in f for d in days) for f in before ^ _files(path)), k
    once = _files(path)
    current.merge_quotes(cash_quotes(raw_cash(spark, chunks[2])), path, "cash")  # repeated
    assert len(_files(path)) == len(once) and current.read_current(spark, path, "cash").count() == 4


def test_late_documents_are_reported(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("docs", "first", "state"))

    def arrive(*rows):
        frame = spark.createDataFrame([(i, t) for i, t in rows], "_id string, created_at string")
        frame.coalesce(1).write.mode("append").json(source)
        return [tuple(r)[1:] for r in deduplicate.store_first(spark, source, target, state, CASH_DOCUMENT, "10 days").collect()]

    assert arrive(("a", "2023-01-01T00:00:00"), ("b", "2023-01-20T00:00:00"), ("b", "2023-01-20T00:00:00")) == [(3, 1, 0, 2)]
    # a copy within ten days of the newest, a new document, and one that is too old to tell
    assert arrive(("b", "2023-01-20T00:00:00"), ("c", "2023-01-21T00:00:00"), ("a", "2023-01-01T00:00:00")) == [(3, 1, 1, 1)]
    assert sorted(r._id for r in deduplicate.read_first(spark, target, CASH_DOCUMENT).collect()) == ["a", "b", "c"]


def test_what_a_stream_has_shuffled_leaves_the_disks(spark, tmp_path):
    schema = T.StructType([T.StructField("_id", T.StringType()), T.StructField("created_at", T.TimestampNTZType())])
    rows = spark.range(2000).select(F.concat(F.lit("d"), F.col("id") % 1500).alias("_id"), F.lit("2023-01-01").cast("timestamp_ntz").alias("created_at"))
    rows.write.json(f"{tmp_path}/docs")
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    settings = ("spark.sql.streaming.stateStore.compression.codec", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    before, had = files.getAllFiles().size(), [spark.conf.get(c) for c in settings]
    report = deduplicate.store_first(spark, f"{tmp_path}/docs", f"{tmp_path}/first", f"{tmp_path}/checkpoint", schema, "60 days")
    assert [tuple(r)[1:] for r in report.collect()] == [(2000, 500, 0, 1500)]
    for _ in range(50):  # they are removed in the background
        if files.getAllFiles().size() <= before:
            break
        time.sleep(0.1)
    assert files.getAllFiles().size() <= before and [spark.conf.get(c) for c in settings] == had
