"""Clean quote tables: one price per hotel, stay date and scrape day."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecal.functions.frames import newest
from ratecal.schemas import CELL


def sampled_hotels(templates: DataFrame, city: str) -> DataFrame:
    """The (group, id) pairs of one city's hotels. Whether they are broadcast is left to Spark, which
    knows their size once they are computed."""
    return templates.filter(F.col("slug_city") == city).select("hotel_group", "hotel_id").distinct()


def clean_quotes(
    raw: DataFrame,
    price: str,
    *,
    columns,
    keys=CELL,
    currency: str | None = None,
    hotels: DataFrame | None = None,
    future_only=True,
    require_key=True,
) -> DataFrame:
    """The newest valid quote per key.

    A quote is valid if its price exceeds 1, and, as the options say, if it is in the
    currency, belongs to one of `hotels` (group, id), was booked on or before its stay and
    names its hotel. Validity comes before the choice of the newest. `cash` is the raw
    table's `cash_value`.
    """
    rows = raw.withColumns({"date_stay": F.to_date("date"), "date_booked": F.to_date("created_at")})
    if price == "cash":
        rows = rows.withColumnRenamed("cash_value", "cash")
    rows = rows.filter(F.col(price) > 1)
    if currency:
        rows = rows.filter(F.col("currency") == currency)
    if future_only:
        rows = rows.filter("date_booked <= date_stay")
    if require_key:
        rows = rows.filter("hotel_name_key <> ''")
    if hotels is not None:
        rows = rows.join(hotels, ["hotel_group", "hotel_id"], "left_semi")
    wanted = list(dict.fromkeys([*columns, *keys, "created_at", "_id"]))
    kept = newest(rows.select(*wanted), list(keys), F.col("created_at").desc(), F.col("_id").desc())
    return kept.select(*columns)


def cash_quotes(raw: DataFrame, hotels: DataFrame | None = None) -> DataFrame:
    columns = [*_HOTEL_ID, *_DATES, "cash", "currency", "created_at", "_id"]
    return clean_quotes(raw, "cash", columns=columns, currency="USD", hotels=hotels)


def points_quotes(raw: DataFrame, hotels: DataFrame | None = None) -> DataFrame:
    columns = [*_HOTEL_ID, *_DATES, "points", "created_at", "_id"]
    return clean_quotes(raw, "points", columns=columns, hotels=hotels)


def cash_quotes_v1(raw: DataFrame) -> DataFrame:
    """First-generation rules: any city, and a blank hotel key is kept."""
    columns = ["hotel_group", "hotel_name_key", "city", *_DATES, "cash", "currency", "created_at", "_id"]
    return clean_quotes(raw, "cash", columns=columns, currency="USD", require_key=False)


def points_quotes_v1(raw: DataFrame) -> DataFrame:
    columns = ["hotel_group", "hotel_name_key", "city", *_DATES, "points", "created_at", "_id"]
    place = [c for c in ("state", "country") if c in raw.columns]
    columns[3:3] = place
    return clean_quotes(raw, "points", columns=columns, require_key=False)


def cash_quotes_by_category(raw: DataFrame) -> DataFrame:
    """The QA variant: one quote per award category as well, past stays kept."""
    columns = [
        "hotel_group", "hotel_name_key", "city", "date_stay", "cash", "currency",
        "created_at", "award_category", "_id",
    ]
    return clean_quotes(
        raw, "cash", columns=columns, keys=(*CELL, "award_category"), currency="USD",
        future_only=False, require_key=False,
    )


_HOTEL_ID = ("hotel_group", "hotel_name_key", "hotel_id")
_DATES = ("date_stay", "date_booked")
