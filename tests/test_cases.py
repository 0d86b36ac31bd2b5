"""Hand-written rows for the places where semantics are easily got wrong."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ratecal.functions.calendar import week_of, weekday, whole_days_ahead
from ratecal.functions.frames import newest
from ratecal.operators import asof, clean, documents, grid, quality, sample, value
from ratecal.schemas import CASH_DOCUMENT, POINTS_DOCUMENT, PRICE, TEMPLATE_DOCUMENT
from ratecal.sources import collections as src
from rows import D, TS, clean as clean_rows, raw_cash, raw_points, values


# calendar

def test_weekdays_and_weeks(spark):
    df = spark.sql("SELECT DATE '2023-01-01' AS sunday, TIMESTAMP_NTZ '2023-01-02 10:00:00' AS monday")
    assert df.select(weekday("sunday"), weekday("monday"), week_of("sunday"), week_of("monday")).first()[:] == (
        0, 1, D("2022-12-26"), D("2023-01-02"),
    )


def test_whole_days_ahead_rounds_down(spark):
    df = spark.sql("""SELECT * FROM VALUES (DATE '2023-03-02', TIMESTAMP_NTZ '2023-03-01 00:00:00'),
        (DATE '2023-03-02', TIMESTAMP_NTZ '2023-03-01 00:00:01'), (DATE '2023-03-01', TIMESTAMP_NTZ '2023-03-01 12:00:00') AS t(stay, created)""")
    assert sorted(r[0] for r in df.select(whole_days_ahead("stay", "created")).collect()) == [-1, 0, 1]


def test_leap_day_gives_366_stays(spark):
    bounds = spark.createDataFrame([(D("2023-03-01"), D("2024-02-29"))], "start date, end date")
    n = dict(grid.date_spine(bounds).groupBy("date_booked").count().collect())
    assert n[D("2023-03-01")] == 366
    # a year from the leap day itself ends on 27 February
    assert n[D("2024-02-29")] == 365


# clean tables

def test_latest_of_a_day_wins(spark):
    raw = raw_cash(spark, [
        ("1", "h", "2023-05-01", "2023-01-01T08:00:00", 100), ("2", "h", "2023-05-01", "2023-01-01T09:00:00", 90),
        ("3", "h", "2023-05-01", "2023-01-02T01:00:00", 80),
    ])
    assert values(clean.cash_quotes(raw), "_id", "cash") == [("2", Decimal("90.0000")), ("3", Decimal("80.0000"))]


def test_filters_come_before_the_latest_is_chosen(spark):
    raw = raw_cash(spark, [
        ("1", "h", "2023-05-01", "2023-01-01T08:00:00", 100),
        ("2", "h", "2023-05-01", "2023-01-01T09:00:00", 1),
        ("3", "h", "2023-05-01", "2023-01-01T10:00:00", 90, {"currency": "EUR"}),
        ("4", "", "2023-05-01", "2023-01-01T10:00:00", 90),
        ("5", None, "2023-05-01", "2023-01-01T10:00:00", 90),
        ("6", "h", "2022-12-31", "2023-01-01T10:00:00", 90),
        ("7", "h", "2023-01-01", "2023-01-01T10:00:00", 90),
        ("8", "h", "2023-05-01", "2023-01-01T11:00:00", None),
    ])
    assert [r[0] for r in values(clean.cash_quotes(raw), "_id")] == ["1", "7"]
    v1 = clean.cash_quotes_v1(raw.withColumn("city", F.lit("c")))
    assert [r[0] for r in values(v1, "_id")] == ["1", "4", "5", "7"]
    assert "6" in [r[0] for r in values(clean.cash_quotes_by_category(raw.withColumn("city", F.lit("c"))), "_id")]


def test_city_restriction_ignores_repeated_templates(spark):
    templates = spark.createDataFrame([("g", "1", "here"), ("g", "1", "here"), ("g", "2", "there")], "hotel_group string, hotel_id string, slug_city string")
    raw = raw_cash(spark, [("1", "h", "2023-05-01", "2023-01-01T08:00:00", 100), ("2", "k", "2023-05-01", "2023-01-01T08:00:00", 100, {"hotel_id": "2"})])
    assert values(clean.cash_quotes(raw, clean.sampled_hotels(templates, "here")), "_id") == [("1",)]


def test_newest_groups_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k string, v int")
    assert values(newest(df, ["k"], F.col("v").desc()), "k", "v") == [("a", 1), (None, 2)]


# documents

def nested(spark, tmp_path, rows, schema):
    path = tmp_path / "docs.json"
    path.write_text("\n".join(json.dumps(r) for r in rows))
    return src.scan(spark, str(path), schema)


def test_polymorphic_prices(spark, tmp_path):
    base = {"hotel_id": "1", "date": "2023-05-01", "created_at": "2023-01-01T00:00:00"}
    docs = nested(spark, tmp_path, [
        {"_id": "object", "cash_value": {"amount": 12.5, "currency": "USD"}, **base},
        {"_id": "text", "cash_value": {"amount": "13", "currency": "EUR"}, **base},
        {"_id": "junk", "cash_value": {"amount": "x", "currency": "USD"}, **base},
        {"_id": "scalar", "cash_value": 5, **base},
        {"_id": "null", "cash_value": None, **base},
        {"_id": "missing", **base},
        {"_id": "bad date", "cash_value": {"amount": 1, "currency": "USD"}, **base, "date": "soon"},
    ], CASH_DOCUMENT)
    rows = documents.clean_cash(docs)
    assert values(rows, "_id", "cash_value", "currency") == [
        ("junk", None, "USD"), ("object", Decimal("12.5000"), "USD"), ("text", Decimal("13.0000"), "EUR"),
    ]
    assert quality.object_count(docs).first()[:] == (7, 4)
    assert rows.columns[-4:] == ["run_id", "input_table", "chunk_n", "extract_dt"]


def test_prices_stored_as_structs(spark):
    docs = spark.createDataFrame(
        [("1", ("12.5", "USD"), "2023-05-01"), ("2", None, "2023-05-01"), ("3", ("x", "USD"), "2023-05-01")],
        "_id string, cash_value struct<amount:string,currency:string>, date string",
    )
    assert values(documents.clean_cash(docs), "_id", "cash_value", "currency") == [("1", Decimal("12.5000"), "USD"), ("3", None, "USD")]
    assert quality.object_count(docs).first()[:] == (3, 2)
    assert docs.filter(documents.price_amount(docs) > 1).count() == 1


def test_points_need_a_value_and_a_date(spark, tmp_path):
    docs = nested(spark, tmp_path, [
        {"_id": "1", "points": 5000, "date": "2023-05-01"}, {"_id": "2", "date": "2023-05-01"},
        {"_id": "3", "points": None, "date": "2023-05-01"}, {"_id": "4", "points": 1, "date": "never"},
    ], POINTS_DOCUMENT)
    assert values(documents.clean_points(docs), "_id", "date") == [("1", D("2023-05-01"))]


def test_templates_flatten_and_blank_becomes_null(spark, tmp_path):
    docs = nested(spark, tmp_path, [{
        "_id": "1", "name": "Inn", "hotel_id": "", "coordinates": {"latitude": "1.5", "longitude": ""},
        "cash_value": {"currency": "USD"}, "review_count": "7", "chain_rating": "", "extra": 1,
    }], TEMPLATE_DOCUMENT)
    row = documents.clean_templates(docs).first()
    assert (row.hotel_name, row.hotel_id, row.longitude, row.currency, row.review_count, row.chain_rating) == (
        "Inn", None, None, "USD", 7, None,
    )
    assert row.latitude == Decimal("1.5")


def test_snapshot_dedupe_comes_before_prices(spark, tmp_path):
    base = {"hotel_id": "1", "date": "2023-05-01"}
    docs = nested(spark, tmp_path, [
        {"_id": "a", "cash_value": {"amount": 10, "currency": "USD"}, "created_at": "2023-01-01T08:00:00", **base},
        {"_id": "b", "created_at": "2023-01-01T07:00:00", **base},
        {"_id": "c", "cash_value": {"amount": 30, "currency": "USD"}, "created_at": "2023-01-02T08:00:00", **base},
    ], CASH_DOCUMENT)
    assert values(documents.clean_cash(documents.snapshot_dedupe(docs)), "_id") == [("c",)]


# collections

def test_choosing_and_uniting_collections(spark):
    names = ["hotel_calendar_a", "hotel_calendar_cash_a", "archived_hotel_calendar_cash_b", "archived_hotel_calendar_b"]
    assert src.choose_collections(names, True, True) == ["archived_hotel_calendar_cash_b"]
    assert src.choose_collections(names, False, False) == ["hotel_calendar_a"]
    a = spark.createDataFrame([("1", "wrong")], "_id string, hotel_group string")
    b = spark.createDataFrame([("2", 5)], "_id string, points int")
    united = src.union_collections({"x_a": a, "x_b": b})
    assert values(united, "_id", "hotel_group", "points", "input_table") == [("1", "a", None, "x_a"), ("2", "b", 5, "x_b")]


def test_exclude_list_keeps_missing_keys(spark):
    docs = spark.createDataFrame([("g", "a"), ("g", "b"), ("g", None)], "hotel_group string, hotel_name_key string")
    listed = spark.createDataFrame([("g", "a")], "hotel_group string, hotel_name_key string")
    assert values(src.without_hotels(docs, listed), "hotel_name_key") == [("b",), (None,)]
    assert values(src.only_hotels(docs, listed), "hotel_name_key") == [("a",)]


def test_city_spelling_by_group(spark):
    docs = spark.createDataFrame([("x", "new-york"), ("x", "New York"), ("y", "new-york"), ("y", "New York")], "hotel_group string, city string")
    assert values(src.in_city(docs, "new-york", {"y": "New York"}), "hotel_group", "city") == [("x", "new-york"), ("y", "New York")]


# neighbours and estimates

def one_cell(spark, cash, booked="2023-01-10"):
    base = clean_rows(spark, "cash", [("h", "2023-05-01", booked, 1)]).drop("cash")
    quotes = clean_rows(spark, "cash", [("h", "2023-05-01", day, price) for day, price in cash])
    none = clean_rows(spark, "points", [("other", "2023-05-01", "2023-01-01", 1)])
    return asof.interpolate(asof.nearest_quotes(base, quotes, none)).first()


def test_a_quote_of_the_same_day_is_no_neighbour(spark):
    row = one_cell(spark, [("2023-01-10", 500), ("2023-01-09", 100), ("2023-01-11", 200)])
    assert (row.cash_prev, row.cp_gap, row.cash_next, row.cn_gap, row.cash_est) == (100, 1, 200, 1, 150)


@pytest.mark.parametrize("quotes, expected", [
    ([("2023-01-01", 100)], (100, 9, None, None, 100)),
    ([("2023-01-20", 70)], (None, None, 70, 10, 70)),
    ([("2023-01-10", 70)], (None, None, None, None, None)),
    ([("2023-01-09", 100), ("2023-01-12", 130), ("2023-01-01", 5), ("2023-02-01", 5)], (100, 1, 130, 2, 110)),
])
def test_sides_and_gaps(spark, quotes, expected):
    row = one_cell(spark, quotes)
    assert (row.cash_prev, row.cp_gap, row.cash_next, row.cn_gap, row.cash_est) == expected


def test_estimates_round_half_up_exactly(spark):
    assert one_cell(spark, [("2023-01-09", "1.00"), ("2023-01-11", "1.01")]).cash_est == Decimal("1.0100")
    assert one_cell(spark, [("2023-01-09", "2.67"), ("2023-01-11", "2.68")]).cash_est == Decimal("2.6800")


def test_sample_prefers_observed_and_marks_complete(spark):
    rows = [("h", "2023-05-01", "2023-01-01", 10, None, 11, 7), ("h", "2023-05-01", "2023-01-02", None, None, 11, None),
            ("x", "2023-05-01", "2023-01-02", 1, 1, 1, 1), ("h", "2023-05-01", "2024-01-02", 1, 1, 1, 1)]
    est = spark.createDataFrame(
        [("g", k, D(s), D(b), 1, *map(lambda v: None if v is None else Decimal(v), p)) for k, s, b, *p in rows],
        "hotel_group string, hotel_name_key string, date_stay date, date_booked date, booking_window int, "
        "cash decimal(18,4), points decimal(18,4), cash_est decimal(18,4), points_est decimal(18,4)",
    )
    exclude = spark.createDataFrame([("x",)], "hotel_name_key string")
    got = sample.final_sample(est, "2023-01-01", "2023-12-31", exclude)
    assert values(got, "date_booked", "cash", "points", "complete") == [
        (D("2023-01-01"), 10, 7, True), (D("2023-01-02"), 11, None, False),
    ]


def test_undated_template_counts_as_newest(spark):
    rows = spark.createDataFrame(
        [("g", "1", "old", TS("2023-01-01T00:00:00"), "a"), ("g", "1", "undated", None, "b"), ("g", "2", None, None, "c")],
        "hotel_group string, hotel_id string, hotel_name string, created_at timestamp_ntz, _id string",
    )
    assert values(sample.latest_templates(rows), "hotel_name") == [("undated",)]


# grid

def test_hotel_with_points_only_has_no_cells(spark):
    cash = clean_rows(spark, "cash", [("h", "2023-01-05", "2023-01-01", 10)])
    points = clean_rows(spark, "points", [("p", "2023-01-05", "2023-01-01", 10)])
    for cells in (grid.dense_grid(cash, points, "2023-01-01", "2023-01-02"), grid.sample_base(cash, points, "2023-01-01", "2023-01-02"),
                  grid.observed_cells(cash, points, "2023-01-01", "2023-01-02")):
        assert [r[0] for r in cells.select("hotel_name_key").distinct().collect()] == ["h"]
    # the sparse grid also holds every observed pair
    assert grid.sparse_grid(cash, points, "2023-01-01", "2023-01-02").filter("hotel_name_key = 'p'").count() == 1


def test_first_generation_grid_repeats_cells_of_shared_keys(spark):
    cash = clean_rows(spark, "cash", [("h", "2023-01-05", "2023-01-01", 10)]).withColumn("city", F.lit("c"))
    twin = cash.withColumn("hotel_group", F.lit("g2")).withColumn("cash", F.lit(20).cast(PRICE))
    points = clean_rows(spark, "points", [("h", "2023-01-05", "2023-01-01", 7)])
    cells = grid.dense_grid_v1(cash.union(twin), points, "2023-01-01", "2023-01-01")
    assert cells.count() == 2 * 365 + 2
    assert values(cells.filter("cash IS NOT NULL"), "hotel_group", "cash", "points") == [
        ("g", 10, 7), ("g", 20, 7), ("g2", 10, 7), ("g2", 20, 7),
    ]


# reports

def test_weekday_without_scrapes_is_null(spark):
    raw = raw_cash(spark, [("1", "h", "2023-05-01", "2023-01-02T08:00:00", 10), ("2", "h", "2023-05-01", "2023-01-03T08:00:00", 10)])
    row = quality.weekday_shares(raw).first()
    assert (row.n, row.tuesdays, row.pct_mon, row.pct_tues, row.pct_sun) == (2, 1, 0.5, 0.5, None)


def test_lead_time_counts_stays_equally(spark):
    stay_a = [(f"a{i}", "h", "2023-05-01", "2023-03-27T08:00:00", 100) for i in range(11)]  # Monday
    stay_b = [(f"b{i}", "h", "2023-05-02", "2023-03-27T08:00:00", 200) for i in range(21)]
    few = [("c", "h", "2023-05-03", "2023-03-27T08:00:00", 999)]
    early = [(f"d{i}", "h", "2023-05-04", "2023-01-01T08:00:00", 999) for i in range(11)]
    weekend = [("e", "h", "2023-05-01", "2023-03-26T08:00:00", 50)]  # Sunday
    row = quality.lead_time_price(raw_cash(spark, stay_a + stay_b + few + early + weekend)).first()
    assert (row.m_th_cash, row.f_su_cash, row.n) == (Decimal("150"), Decimal("50"), 33)


def test_redundancy_and_copies(spark):
    raw = raw_cash(spark, [
        ("1", "h", "2023-05-01", "2023-01-01T08:00:00", 10), ("2", "h", "2023-05-01", "2023-01-01T09:00:00", 10),
        ("3", "h", "2023-05-01", "2023-01-01T09:30:00", 10), ("4", "h", "2023-05-02", "2023-01-01T09:00:00", 10),
        ("5", "h", "2023-05-01", "2023-01-01T09:00:00", 10, {"award_category": "b"}),
        ("6", "h", "2023-05-01", "2023-01-01T09:00:00", 0.5),
    ])
    assert values(quality.redundancy(raw, "hotel_group"), "clean_count", "total_count", "pct_needed") == [(3, 5, 0.6)]
    assert values(quality.repeat_rows(raw, "h", "2023-05-01"), "_id", "rn") == [("1", 3), ("2", 2)]
    assert quality.repeat_rows(raw, "h", "2023-05-02").count() == 0


def test_average_outside_all_tiers_is_high(spark):
    cells = spark.createDataFrame(
        [("g", "h", Decimal(p), Decimal(100)) for p in (80, 95, 100, 125)], "hotel_group string, hotel_name_key string, cash decimal(18,4), points decimal(18,4)"
    )
    got = values(value.value_by_tier(cells), "demand_tier", "value_100_pts")
    assert got == [("high_demand", 125.0), ("low_demand", 80.0), ("mid_demand", 97.5)]


def test_cumulative_weeks_count_sunday_first(spark):
    cash = clean_rows(spark, "cash", [("h", "2023-05-01", "2023-01-02", 10), ("h", "2023-05-02", "2023-01-08", 10)])
    points = clean_rows(spark, "points", [("h", "2023-05-01", "2023-01-04", 10), ("h", "2023-05-02", "2023-01-08", 10), ("h", "2023-05-03", "2023-01-08", 10)])
    row = quality.cumulative_coverage(grid.observed_cells(cash, points, "2023-01-01", "2023-02-01")).collect()
    assert [tuple(r)[2:] for r in row] == [(D("2023-01-02"), 1, 1, 1, 2, 2, 2, 2)]


def test_points_raw_rows_make_points_quotes(spark):
    raw = raw_points(spark, [("1", "h", "2023-05-01", "2023-01-01T08:00:00", 1), ("2", "h", "2023-05-01", "2023-01-01T07:00:00", 2)])
    assert values(clean.points_quotes(raw), "_id") == [("2",)]


def test_ids_known_unique_give_the_same_snapshots(spark, tmp_path):
    docs = nested(spark, tmp_path, [
        {"_id": f"{i:02d}", "hotel_id": str(i % 2), "date": f"2023-05-0{i % 3 + 1}", "created_at": f"2023-01-01T0{i % 10}:00:00"} for i in range(30)
    ], CASH_DOCUMENT)
    kept = values(documents.snapshot_dedupe(docs), "_id")
    assert len(kept) == 6 and kept == values(documents.snapshot_dedupe(docs, ids_unique=True), "_id")
