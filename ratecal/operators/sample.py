"""The analysis sample and the hotel descriptions that go with it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecal.functions.calendar import date_literal
from ratecal.functions.frames import newest
from ratecal.schemas import CELL, HOTEL
from ratecal.sources.collections import only_keys, without_keys


def final_sample(estimates: DataFrame, first, last, exclude: DataFrame | None = None) -> DataFrame:
    """Observed prices, else estimated ones, for cells booked from `first` to `last`;
    `complete` where both prices are known. `exclude` lists hotel keys to leave out."""
    rows = estimates.filter(F.col("date_booked").between(date_literal(first), date_literal(last)))
    if exclude is not None:
        rows = without_keys(rows, exclude)
    rows = rows.withColumns({"cash": F.coalesce("cash", "cash_est"), "points": F.coalesce("points", "points_est")})
    complete = F.col("cash").isNotNull() & F.col("points").isNotNull()
    return rows.select(*CELL, "booking_window", "cash", "points", complete.alias("complete"))


def restricted_sample(sample: DataFrame, keys: DataFrame) -> DataFrame:
    """The sample of the listed hotel keys only."""
    return only_keys(sample, keys)


def latest_templates(templates: DataFrame) -> DataFrame:
    """The newest description per hotel; one without a date counts as newest."""
    named = templates.filter("hotel_group IS NOT NULL AND hotel_id IS NOT NULL AND hotel_name IS NOT NULL")
    return newest(named, ["hotel_group", "hotel_id"], F.col("created_at").desc_nulls_first(), F.col("_id").desc())


def latest_keys(cash: DataFrame) -> DataFrame:
    """The key each hotel (group, id) was last quoted under."""
    named = cash.filter("hotel_group IS NOT NULL AND hotel_id IS NOT NULL AND hotel_name_key IS NOT NULL")
    rows = named.select("hotel_group", "hotel_id", "hotel_name_key", "created_at", "_id")
    last = newest(rows, ["hotel_group", "hotel_id"], F.col("created_at").desc_nulls_first(), F.col("_id").desc())
    return last.select("hotel_group", "hotel_id", "hotel_name_key")


def sample_templates(templates: DataFrame, cash: DataFrame, sample: DataFrame) -> DataFrame:
    """The newest descriptions of the hotels in a sample, found by the key they were last quoted under."""
    ids = latest_keys(cash).join(sample.select(*HOTEL).distinct(), list(HOTEL)).distinct()
    columns = [c for c in templates.columns if c not in ("hotel_group", "hotel_id", "created_at", "_id", "run_id", "dt")]
    return (
        latest_templates(templates)
        .join(ids, ["hotel_group", "hotel_id"])
        .select("hotel_group", "hotel_id", "hotel_name_key", *columns)
    )
