"""Data quality: what was collected, how much of it is redundant, how far estimates go.

All of these are aggregations that combine within each task before they shuffle, so a
hotel or group that holds most rows costs no more than any other.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecal.functions.calendar import date_literal, week_of, weekday, whole_days_ahead
from ratecal.functions.frames import in_order, ratio, spread
from ratecal.functions.ranking import number_rows
from ratecal.operators.documents import holds_object, price_amount
from ratecal.operators.grid import hotels_of, observed_cells
from ratecal.schemas import HOTEL, PRICE

def _count() -> Column:
    return F.count(F.lit(1))


def _tally(condition: Column) -> Column:
    """Rows that meet a condition; NULL, not 0, if none does."""
    return F.sum(F.when(condition, F.lit(1)))


def weekday_shares(raw: DataFrame) -> DataFrame:
    """Per hotel, the share of rows scraped on each weekday (NULL if none) and the time span."""
    day = weekday("created_at")
    names = ("sun", "mon", "tues", "wed", "thu", "fri", "sat")
    return (
        raw.groupBy(*HOTEL)
        .agg(
            _count().alias("n"),
            _tally(day == 2).alias("tuesdays"),
            *[ratio(_tally(day == i), _count()).alias(f"pct_{name}") for i, name in enumerate(names)],
            F.min("created_at").alias("min_date"),
            F.max("created_at").alias("max_date"),
        )
        .orderBy("hotel_group", "n")
    )


def span_by(raw: DataFrame, *keys: str) -> DataFrame:
    """Rows and first and last scrape time per key (a group, or a hotel)."""
    return raw.groupBy(*keys).agg(
        _count().alias("n"), F.min("created_at").alias("min_dt"), F.max("created_at").alias("max_dt")
    )


def duplicate_ids(raw: DataFrame) -> DataFrame:
    return raw.groupBy("_id").agg(_count().alias("n")).filter("n > 1").orderBy(F.desc("n"), "_id")


def rows_of_hotel(raw: DataFrame, key: str, *order: str) -> DataFrame:
    return raw.filter(F.col("hotel_name_key") == key).orderBy(*order)


def price_by_stay(raw: DataFrame, key: str) -> DataFrame:
    """Average price and number of quotes per stay date of one hotel."""
    return (
        raw.filter(F.col("hotel_name_key") == key)
        .groupBy("date")
        .agg(ratio(F.sum("cash_value"), F.count("cash_value")).alias("cash_value"), _count().alias("n"))
        .orderBy("date")
    )


def lead_time_price(raw: DataFrame, first_day=30, last_day=60, at_least=10) -> DataFrame:
    """Average price per hotel of quotes 30 to 60 days ahead, scraped Monday to Thursday or not.

    Averages are taken per stay date first and rounded to cents; stays with more than
    `at_least` quotes then count equally. Weekdays are those of the scrape.
    """
    lead = whole_days_ahead("date", "created_at")
    midweek = weekday("created_at").between(1, 4)
    price = F.col("cash_value")
    stays = (
        raw.filter(lead.between(first_day, last_day) & (price > 0))
        .groupBy(*HOTEL, "date")
        .agg(
            _mean(F.when(midweek, price)).alias("m_th"),
            _mean(F.when(~midweek, price)).alias("f_su"),
            _count().alias("n"),
        )
        .filter(F.col("n") > at_least)
    )
    return (
        stays.groupBy(*HOTEL)
        .agg(_mean("m_th").alias("m_th_cash"), _mean("f_su").alias("f_su_cash"), F.sum("n").alias("n"))
        .orderBy(*HOTEL)
    )


def _mean(price) -> Column:
    """Average to cents from an exact sum."""
    return F.round(F.try_divide(F.sum(price), F.count(price)), 2).cast(PRICE)


def weekly_counts(raw: DataFrame, *keys: str) -> DataFrame:
    """Rows per week of scraping (named by its Monday), overall or per key."""
    return raw.groupBy(*keys, week_of("created_at").alias("created_week")).agg(_count().alias("n")).orderBy(*keys, "created_week")


def daily_counts(raw: DataFrame, group: str) -> DataFrame:
    rows = raw.filter(F.col("hotel_group") == group)
    return rows.groupBy(F.to_date("created_at").alias("created_date")).agg(_count().alias("n")).orderBy("created_date")


def _repeat_keys(raw: DataFrame) -> DataFrame:
    """Valid USD quotes with their scrape day; rows that agree on REPEATS are copies."""
    return raw.filter("currency = 'USD' AND cash_value > 1").withColumn("_day", F.to_date("created_at"))


_REPEATS = (*HOTEL, "award_category", "date", "_day")


def redundancy(raw: DataFrame, *keys: str) -> DataFrame:
    """Rows that remain after dropping copies against all rows, per group or hotel. Counted by
    aggregation: one row per set of copies remains, so no set has to be ranked."""
    copies = _repeat_keys(raw).groupBy(*_REPEATS).agg(_count().alias("copies"))
    return (
        copies.groupBy(*keys)
        .agg(
            _count().alias("clean_count"),
            F.sum("copies").alias("total_count"),
            ratio(_count(), F.sum("copies")).alias("pct_needed"),
        )
        .orderBy(*keys)
    )


def repeat_rows(raw: DataFrame, key: str | None = None, stay=None) -> DataFrame:
    """The copies: all quotes of a scrape day but the newest, numbered from 2. May be narrowed
    to one hotel and stay date."""
    rows = _repeat_keys(raw)
    if key is not None:
        rows = rows.filter(F.col("hotel_name_key") == key)
    if stay is not None:
        rows = rows.filter(F.col("date") == date_literal(stay))
    numbered = number_rows(rows, list(_REPEATS), F.col("created_at").desc(), F.col("_id").desc())
    return numbered.filter("rn > 1").drop("_day")


def fill_count(estimates: DataFrame) -> DataFrame:
    return estimates.agg(
        _count().alias("n"),
        _tally(F.col("cash").isNotNull()).alias("cash"),
        _tally(F.col("points").isNotNull()).alias("points"),
    )


def estimate_error(estimates: DataFrame, price: str, *keys) -> DataFrame:
    """How far the sum of estimates is off the sum of observed prices, where both exist."""
    rows = estimates.filter(F.col(price).isNotNull() & F.col(f"{price}_est").isNotNull())
    off = ratio(F.sum(f"{price}_est"), F.sum(price)) - 1
    return rows.groupBy(*keys).agg(_count().alias("n"), off.alias(f"{price}_err"))


def estimate_error_by_gap(estimates: DataFrame, price: str) -> DataFrame:
    """The same by the number of days between the quotes an estimate rests on."""
    gaps = {"cash": ("cp_gap", "cn_gap"), "points": ("pp_gap", "pn_gap")}[price]
    gap = sum(F.coalesce(F.col(g), F.lit(0)) for g in gaps)
    return estimate_error(estimates, price, gap.alias("gap")).orderBy("gap")


def coverage(estimates: DataFrame) -> DataFrame:
    """Per hotel, cells still without a price after estimation and the booking days they span."""
    no_cash = F.coalesce("cash", "cash_est").isNull()
    no_points = F.coalesce("points", "points_est").isNull()
    open_day = F.when(no_cash | no_points, F.col("date_booked"))
    return (
        estimates.groupBy(*HOTEL)
        .agg(
            _tally(no_cash).alias("cash_null"),
            _tally(no_points).alias("points_null"),
            _tally(~no_cash & ~no_points).alias("both_valid"),
            F.min(open_day).alias("min_date_booked_null"),
            F.max(open_day).alias("max_date_booked_null"),
            _count().alias("n"),
        )
        .orderBy(F.desc_nulls_first("both_valid"), *HOTEL)
    )


_WEEKDAYS = ("sun", "mon", "tue", "wed", "thu", "fri", "sat")


def week_weekday_fill(cash: DataFrame, points: DataFrame, start, end) -> DataFrame:
    """Filled grid cells per hotel and booking week, by weekday of booking; weeks of the spine
    without any are 0. Instead of the dense grid, one empty row per hotel and week is added to
    the observed cells."""
    weeks = F.sequence(week_of(date_literal(start)), week_of(date_literal(end)), F.expr("INTERVAL 7 DAYS"))
    none = F.lit(None).cast(PRICE)
    empty = hotels_of(cash).select(
        *HOTEL, F.explode(weeks).alias("week_booked"), F.lit(None).cast("date").alias("date_booked"), none.alias("cash"), none.alias("points")
    )
    filled = observed_cells(cash, points, start, end).select(
        *HOTEL, week_of("date_booked"), "date_booked", "cash", "points"
    )
    counts = [
        F.count(F.when(weekday("date_booked") == i, F.col(price))).alias(f"{name}_{price}")
        for price in ("cash", "points")
        for i, name in enumerate(_WEEKDAYS)
    ]
    # both steps keep the session's width: rows are many and small, and adaptive execution would merge tasks by their packed size
    rows = spread(empty.union(filled), *HOTEL, "week_booked").groupBy(*HOTEL, "week_booked").agg(*counts)
    return in_order(rows, "hotel_group", "week_booked", "hotel_name_key")


def cumulative_coverage(cells: DataFrame) -> DataFrame:
    """Per hotel and booking week, the stays that had both a cash and a points price by Sunday,
    by Monday, ... by Saturday of that week.

    A week starts on Monday but its Sunday counts first, as in the original report.
    """
    first = (
        cells.groupBy(*HOTEL, "date_stay", week_of("date_booked").alias("week_booked"))
        .agg(
            F.min(F.when(F.col("cash").isNotNull(), F.col("date_booked"))).alias("_cash"),
            F.min(F.when(F.col("points").isNotNull(), F.col("date_booked"))).alias("_points"),
        )
        .filter("_cash IS NOT NULL AND _points IS NOT NULL")
    )
    day = weekday(F.greatest("_cash", "_points"))
    counts = [F.count(F.when(day <= i, True)).alias(f"d{i + 1}_cp") for i in range(7)]
    return first.groupBy(*HOTEL, "week_booked").agg(*counts).orderBy(*HOTEL, "week_booked")


def collection_stats(docs: DataFrame) -> DataFrame:
    """Per collection: rows, distinct (key, scrape day, stay date) among documents with a
    scrape time and a price above 1, distinct keys and distinct cities.

    Most documents are copies, so they are first reduced to distinct combinations; only those
    reach the exact distinct counts.
    """
    priced = F.col("created_at").isNotNull() & (price_amount(docs) > 1)
    combos = docs.groupBy(
        "input_table", "hotel_name_key", "city", "date",
        F.to_date("created_at").alias("day"), F.coalesce(priced, F.lit(False)).alias("priced"),
    ).agg(_count().alias("rows"))
    # exact distinct counts keep every combination several times over, so these get tasks of the session's width
    combos = spread(combos, "input_table", "hotel_name_key", "day", "date")
    # NULL members make a combination too, and count_distinct skips NULLs only at top level
    combo = F.when(F.col("priced"), F.struct("hotel_name_key", "day", "date"))
    return combos.groupBy("input_table").agg(
        F.sum("rows").alias("row_count"),
        F.count_distinct(combo).alias("unique_rows"),
        F.count_distinct("hotel_name_key").alias("unique_hotel_name_keys"),
        F.count_distinct("city").alias("unique_cities"),
    )


def object_count(docs: DataFrame) -> DataFrame:
    """Documents, and how many of them hold a price object."""
    return docs.agg(_count().alias("n"), F.count_if(holds_object(docs)).alias("objects"))


def key_span(docs: DataFrame) -> DataFrame:
    """Newest and oldest scrape and number of documents per hotel key and city."""
    return docs.groupBy("hotel_name_key", "city").agg(
        F.max("created_at").alias("most_recent"), F.min("created_at").alias("oldest"), _count().alias("n")
    )


def rows_per_collection(docs: DataFrame) -> DataFrame:
    return docs.groupBy("input_table").agg(_count().alias("total_rows"))


def spot_check(docs: DataFrame, key: str, start, end) -> DataFrame:
    """One hotel's documents with any price, scraped from `start` to `end`, both included."""
    created = F.col("created_at")
    return docs.filter(
        (F.col("hotel_name_key") == key)
        & (F.col("cash_value").isNotNull() | F.col("points").isNotNull())
        & created.between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    )


def count_by_stay(docs: DataFrame) -> DataFrame:
    return docs.groupBy("date").agg(_count().alias("n"))


def monthly_price(raw: DataFrame) -> DataFrame:
    """Quotes and average price by year and month of stay and of scrape."""
    parts = {"date_year": F.year("date"), "date_month": F.month("date"),
             "created_year": F.year("created_at"), "created_month": F.month("created_at")}
    return raw.groupBy(*[part.alias(name) for name, part in parts.items()]).agg(
        _count().alias("n"), ratio(F.sum("cash_value"), F.count("cash_value")).alias("average_price")
    )


def first_seen(docs: DataFrame, key: str) -> DataFrame:
    return docs.filter(F.col("hotel_name_key") == key).agg(F.min("created_at").alias("first_seen"))
