"""From quote and template documents to the raw tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecal.functions.frames import blank_to_null, conform, newest
from ratecal.schemas import HOTEL_CASH, HOTEL_POINTS, HOTEL_TEMPLATE, PRICE


def snapshot_dedupe(docs: DataFrame, within=(), ids_unique=False) -> DataFrame:
    """The newest document per hotel, scrape day and stay date, by `_id`.

    Comes before prices are looked at: a newest document without a price removes its key.
    `within` lists columns to dedupe inside of, e.g. `input_table` for a union of collections.
    One document per `_id` is kept first, which is a shuffle of all documents by a key that
    seldom repeats; `ids_unique` leaves it out where the store already sees to that.
    """
    by_id = docs if ids_unique else newest(docs, [*within, "_id"], F.col("created_at").desc())
    dated = by_id.withColumn("_day", F.to_date("created_at"))
    return newest(dated, [*within, "hotel_id", "_day", "date"], F.col("_id").desc()).drop("_day")


def _is_struct(docs: DataFrame, field: str) -> bool:
    return isinstance(docs.schema[field].dataType, T.StructType)


def holds_object(docs: DataFrame, field="cash_value") -> Column:
    """Whether a polymorphic field holds an object rather than a scalar or nothing."""
    return F.col(field).isNotNull() if _is_struct(docs, field) else F.ltrim(F.col(field)).startswith("{")


def object_amount(docs: DataFrame, field="cash_value") -> Column:
    """The amount of a price object as a number; NULL if it is none or the field no object."""
    amount = F.col(f"{field}.amount") if _is_struct(docs, field) else F.get_json_object(field, "$.amount")
    return amount.try_cast(PRICE)


def price_amount(docs: DataFrame, field="cash_value") -> Column:
    """The price as a number, from an object's amount or a bare scalar; NULL if neither parses."""
    if _is_struct(docs, field):
        return object_amount(docs, field)
    return F.when(holds_object(docs, field), object_amount(docs, field)).otherwise(F.col(field).try_cast(PRICE))


def clean_cash(docs: DataFrame) -> DataFrame:
    """Cash documents as `hotel_cash` rows: only those with a price object and a stay date
    that parses. An amount that is not a number becomes NULL."""
    rows = docs.withColumn("date", F.col("date").try_cast("date"))
    rows = rows.filter(holds_object(docs) & F.col("date").isNotNull())
    if _is_struct(docs, "cash_value"):
        rows = rows.withColumns({"_amount": F.col("cash_value.amount"), "_currency": F.col("cash_value.currency")})
    else:  # both fields from one pass over the text
        rows = rows.select("*", F.json_tuple("cash_value", "amount", "currency").alias("_amount", "_currency"))
    return conform(rows.withColumns({"cash_value": F.col("_amount").try_cast(PRICE), "currency": F.col("_currency")}), HOTEL_CASH)


def clean_points(docs: DataFrame) -> DataFrame:
    """Points documents as `hotel_points` rows: only those with points and a stay date that parses."""
    rows = docs.filter("points IS NOT NULL").withColumn("date", F.col("date").try_cast("date"))
    return conform(rows.filter("date IS NOT NULL"), HOTEL_POINTS)


def clean_templates(docs: DataFrame) -> DataFrame:
    """Template documents as hotel rows: nested fields flattened, empty strings NULL."""
    flat = docs.withColumnRenamed("name", "hotel_name").withColumns(
        {
            "latitude": F.col("coordinates.latitude"),
            "longitude": F.col("coordinates.longitude"),
            "currency": F.col("cash_value.currency"),
        }
    )
    return conform(blank_to_null(flat), HOTEL_TEMPLATE)


def dated_amounts(docs: DataFrame) -> DataFrame:
    """A narrow projection: stay date by format, the price object's amount, scrape time, hotel."""
    return docs.select(
        F.try_to_date("date", "yyyy-MM-dd").alias("date"),
        F.when(holds_object(docs), object_amount(docs)).alias("cash_value_amount"),
        "created_at",
        "hotel_name_key",
    )


def scraped_on(docs: DataFrame, day: int) -> DataFrame:
    """Documents scraped on one weekday, 1 for Sunday to 7 for Saturday."""
    return docs.filter(F.dayofweek(F.to_date("created_at")) == day)
