"""The jobs end to end, in fresh folders."""

import json

import pytest
from pyspark.sql import functions as F

from ratecal.operators import asof, clean, documents, quality, sample
from ratecal.plans import jobs, reports
from ratecal.schemas import CASH_DOCUMENT, CELL, HOTEL_CASH, HOTEL_POINTS, HOTEL_TEMPLATE, RUN
from ratecal.sources import tables
from ratecal.sources.collections import choose_collections, scan
from ratecal.sources.testtables import TestTables
from ratecal.streaming.incremental import ingest_new_files, read_raw
from rows import values

FOLDER = "/root/testdata/sf0.001"
SPINE = ("1998-01-01", "1998-06-30")


@pytest.fixture(scope="module")
def t(spark):
    return TestTables(spark, FOLDER)


def chosen(t, cash):
    collections = t.collections()
    return {n: collections[n] for n in choose_collections(collections, True, cash)}


def test_extract_then_build(spark, t, tmp_path):
    folder = str(tmp_path)
    assert jobs.extract_quotes(spark, chosen(t, True), chosen(t, False), folder, "2024-01-01 00:00:00") == 1
    assert jobs.extract_templates(spark, {"hotel_directory_templates_all": t.template_documents()}, folder, "2024-01-01 00:00:00") == 2
    runs = spark.read.schema(RUN).parquet(f"{folder}/run")
    assert values(runs, "run_id", "run_name") == [(1, "extract_quotes"), (2, "extract_templates")]

    cash, points, templates = (
        tables.read_table(spark, f"{folder}/{n}", s)
        for n, s in (("hotel_cash", HOTEL_CASH), ("hotel_points", HOTEL_POINTS), ("hotel_template_raw", HOTEL_TEMPLATE))
    )
    # every declared column is stored, and nothing besides but the run's folder
    assert set(spark.read.parquet(f"{folder}/hotel_cash").columns) == {*HOTEL_CASH.names, "run"}
    assert cash.schema.names == HOTEL_CASH.names and points.schema.names == HOTEL_POINTS.names
    assert templates.schema.names == HOTEL_TEMPLATE.names
    assert cash.count() > 0 and points.count() > 0 and templates.count() > 0
    assert quality.duplicate_ids(templates).count() == 0

    built = jobs.build_sample(cash, points, templates, folder, "nation_19", SPINE[1], SPINE[0], "1998-02-01", "1998-05-31")
    hotels = clean.sampled_hotels(templates, "nation_19")
    expected = sample.final_sample(
        asof.sample_estimates(clean.cash_quotes(cash, hotels), clean.points_quotes(points, hotels), *SPINE), "1998-02-01", "1998-05-31"
    )
    assert built.count() > 0
    assert expected.exceptAll(built.select(*expected.columns)).count() == 0 and built.count() == expected.count()
    assert built.groupBy(*CELL).count().filter("count > 1").count() == 0

    clean_cash, clean_points, est = (
        spark.read.parquet(f"{folder}/{n}") for n in ("hotel_cash_clean", "hotel_points_clean", "hotel_sample_est")
    )
    everything = {
        **reports.raw_reports(cash), **reports.redundancy_reports(cash), **reports.estimate_reports(est),
        **reports.grid_reports(clean_cash, clean_points, *SPINE),
    }
    jobs.create_views(spark, folder, *SPINE)
    sql = "SELECT hotel_group, sum(cash) / sum(points) * 100.0 FROM {} WHERE cash IS NOT NULL AND points IS NOT NULL GROUP BY 1 ORDER BY 1"
    assert spark.sql(sql.format("hotel")).collect() == spark.sql(sql.format("hotel_dense")).collect()
    assert spark.sql("SELECT count(*) FROM hotel").first()[0] == 181 * 365
    reports.export_reports(everything, f"{folder}/reports")
    weeks = spark.read.csv(f"{folder}/reports/week_weekday_fill", header=True)
    assert len(everything) == 21 and weeks.count() == 27  # one hotel, first to last week of the spine


def test_run_numbers_go_up(spark, tmp_path):
    path = str(tmp_path / "run")
    assert [tables.start_run(spark, path, "x", "d") for _ in range(3)] == [1, 2, 3]


def test_append_fills_and_orders_columns(spark, tmp_path):
    path = str(tmp_path / "points")
    tables.append(spark.createDataFrame([("1", 5)], "_id string, points int"), path, HOTEL_POINTS)
    tables.append(spark.createDataFrame([("2", "x")], "_id string, other string"), path, HOTEL_POINTS)
    assert spark.read.parquet(path).columns == HOTEL_POINTS.names
    assert values(spark.read.parquet(path), "_id", "points") == [("1", 5), ("2", None)]


def test_create_table_replaces(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS scratch LOCATION '{tmp_path}/db'")
    try:
        df = spark.range(10).withColumnRenamed("id", "a")
        tables.create_table(df, "scratch.t")
        got = tables.create_table(df.filter("a < 3"), "scratch.t", buckets=4, bucket_by=("a",))
        assert got.count() == 3
    finally:
        spark.sql("DROP DATABASE scratch CASCADE")


def test_copies_are_replaced_and_cut_to_the_interval(spark, t, tmp_path):
    folder = str(tmp_path)
    collections = {"hotel_calendar_cash_x": t.documents(), "hotel_directory_templates_x": t.template_documents()}
    for _ in range(2):
        jobs.copy_collections(collections, folder, "1998-01-01", "1998-02-01")
    copied = scan(spark, f"{folder}/hotel_calendar_cash_x", CASH_DOCUMENT)
    assert 0 < copied.count() < t.documents().count()
    assert copied.filter("created_at < '1998-01-01' OR created_at >= '1998-02-01'").count() == 0
    assert spark.read.json(f"{folder}/hotel_directory_templates_x").count() == t.template_documents().count()


def test_ingest_in_parts_equals_ingest_at_once(spark, tmp_path):
    name = "hotel_calendar_cash_g"
    docs = [
        {"_id": f"{i:03d}", "hotel_id": str(i % 3), "hotel_name_key": f"k{i % 3}", "date": "2023-05-01",
         "cash_value": {"amount": 100 + i, "currency": "USD"}, "created_at": f"2023-01-{i % 20 + 1:02d}T0{i % 10}:00:00"}
        for i in range(40)
    ]

    def ingest(where, parts, per_chunk=None):
        source = tmp_path / where / "docs"
        source.mkdir(parents=True)
        for run, part in enumerate(parts):
            for i, doc in enumerate(part):
                (source / f"{run}-{i}.json").write_text(json.dumps(doc))
            ingest_new_files(spark, str(source), str(tmp_path / where / "raw"), str(tmp_path / where / "check"),
                             "cash", name, run, "2024-01-01 00:00:00", per_chunk)
        return read_raw(spark, str(tmp_path / where / "raw"), HOTEL_CASH)

    once = ingest("once", [docs])
    twice = ingest("twice", [docs[:25], docs[25:]], per_chunk=10)
    assert twice.select("chunk_n").distinct().count() == 5
    assert values(twice, "hotel_group", "input_table")[0] == ("g", name)
    columns = ("hotel_name_key", "date_stay", "date_booked", "cash", "_id")
    assert values(clean.cash_quotes(once), *columns) == values(clean.cash_quotes(twice), *columns)
    # a run without new files adds nothing
    before = twice.count()
    ingest_new_files(spark, str(tmp_path / "twice" / "docs"), str(tmp_path / "twice" / "raw"), str(tmp_path / "twice" / "check"),
                     "cash", name, 9, "2024-01-01 00:00:00")
    assert read_raw(spark, str(tmp_path / "twice" / "raw"), HOTEL_CASH).count() == before


def test_new_checkpoint_and_repeated_chunk(spark, tmp_path):
    """A second stream into the same table keeps the rows of the first; a chunk that is written again
    replaces itself."""
    def docs(numbers):
        return [{"_id": f"{i:03d}", "hotel_id": str(i), "hotel_name_key": f"k{i}", "date": "2023-05-01",
                 "cash_value": {"amount": 100, "currency": "USD"}, "created_at": "2023-01-01T00:00:00"} for i in numbers]

    def ingest(part, check, numbers, run):
        folder = tmp_path / part
        folder.mkdir(exist_ok=True)
        for d in docs(numbers):
            (folder / f"{d['_id']}.json").write_text(json.dumps(d))
        ingest_new_files(spark, str(folder), str(tmp_path / "raw"), str(tmp_path / check), "cash", "hotel_calendar_cash_g", run, "2024-01-01 00:00:00")
        return read_raw(spark, str(tmp_path / "raw"), HOTEL_CASH, "hotel_calendar_cash_g").count()

    assert ingest("one", "check1", range(5), 1) == 5
    assert ingest("two", "check2", range(5, 8), 2) == 8
    # as after a failure between the write and the commit: the chunk comes again, in a run of another number
    for commit in (tmp_path / "check2" / "commits").iterdir():
        commit.unlink()
    assert ingest("two", "check2", (), 3) == 8
    assert read_raw(spark, str(tmp_path / "raw"), HOTEL_CASH, "hotel_calendar_cash_x").count() == 0


def test_parquet_stream(spark, tmp_path):
    rows = spark.createDataFrame([("1", "h", "k", "2023-05-01", '{"amount": 5, "currency": "USD"}')], "_id string, hotel_id string, hotel_name_key string, date string, cash_value string")
    rows.withColumn("created_at", F.lit("2023-01-01 00:00:00").cast("timestamp_ntz")).write.parquet(str(tmp_path / "docs"))
    ingest_new_files(spark, str(tmp_path / "docs"), str(tmp_path / "raw"), str(tmp_path / "check"), "cash", "hotel_calendar_cash_g", 1,
                     "2024-01-01 00:00:00", format="parquet", pathGlobFilter="*.parquet")
    assert values(read_raw(spark, str(tmp_path / "raw"), HOTEL_CASH), "_id", "hotel_group") == [("1", "g")]


def test_repeated_extraction(spark, t, tmp_path):
    folder = str(tmp_path)
    run = lambda **more: jobs.extract_quotes(spark, chosen(t, True), chosen(t, False), folder, "2024-01-01 00:00:00", **more)
    count = lambda: tables.read_table(spark, f"{folder}/hotel_cash", HOTEL_CASH).count()
    assert run() == 1
    once = count()
    assert run(run_id=1) == 1 and count() == once
    assert run(ids_unique=True) == 2 and count() >= 2 * once


def test_cleaned_documents_match_the_raw_rows(t):
    rows = documents.clean_cash(t.documents())
    assert rows.schema.names == HOTEL_CASH.names
    assert rows.filter("date IS NULL").count() == 0
