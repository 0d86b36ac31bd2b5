"""Cleaning that accounts for every document: kept, or set aside with the reason.

A price may be an object, a scalar or nothing, so it is read as a VARIANT: what it is and what it holds is asked of
the value, not of its text. Documents without a usable price or stay date are set aside; a price object whose amount cannot be
used keeps its document with a NULL price, and that is reported too.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecal.functions.frames import conform
from ratecal.schemas import HOTEL_CASH, HOTEL_POINTS, PRICE

ISO = ("yyyy-MM-dd",)
NO_PRICE, NO_OBJECT, NO_POINTS, BAD_DATE = "no price", "price is no object", "no points", "stay date does not parse"
NO_AMOUNT, NO_NUMBER, TOO_LARGE = "no amount", "amount is no number", "amount out of range"
DROPPED = (NO_PRICE, NO_OBJECT, NO_POINTS, BAD_DATE)


def date_in(column, formats: Sequence[str] = ISO) -> Column:
    """A date in the first of the formats that fits; NULL if none does."""
    return F.coalesce(*[F.try_to_date(column, form) for form in formats])


def judge_cash(docs: DataFrame, formats: Sequence[str] = ISO) -> DataFrame:
    """Cash documents with `_price` (VARIANT), `_date`, `_amount`, `_currency` and `_reason`: the first thing
    that is wrong with the document, NULL if nothing is. Rows are neither dropped nor moved."""
    kind = docs.schema["cash_value"].dataType
    price = F.to_variant_object("cash_value") if isinstance(kind, T.StructType) else F.try_parse_json(F.col("cash_value"))
    rows = _once(docs, {"_price": price, "_date": date_in("date", formats)})
    rows = _once(rows, {"_is_object": F.schema_of_variant("_price").startswith("OBJECT")})
    is_object = F.col("_is_object")
    rows = _once(
        rows,
        {
            "_text": F.when(is_object, F.try_variant_get("_price", "$.amount", "string")),
            "_currency": F.when(is_object, F.try_variant_get("_price", "$.currency", "string")),
        },
    )
    amount = F.col("_text").try_cast(PRICE)
    reason = (
        F.when(F.col("cash_value").isNull(), NO_PRICE)
        .when(~F.coalesce(is_object, F.lit(False)), NO_OBJECT)
        .when(F.col("_date").isNull(), BAD_DATE)
        .when(F.col("_text").isNull(), NO_AMOUNT)
        .when(amount.isNull(), F.when(F.col("_text").try_cast("double").isNull(), NO_NUMBER).otherwise(TOO_LARGE))
    )
    return rows.withColumns({"_amount": amount, "_reason": reason}).drop("_text", "_is_object")


def _once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """`withColumns` for what costs much: made once for each row. A filter on a plain column is moved in front of the joins
    behind it, where the column's expression is repeated as often as it is named, for rows that are not wanted."""
    made = F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))
    return rows.select("*", F.inline(made).alias(*columns))


def judge_points(docs: DataFrame, formats: Sequence[str] = ISO) -> DataFrame:
    """Points documents with `_date` and `_reason`."""
    rows = docs.withColumn("_date", date_in("date", formats))
    return rows.withColumn("_reason", F.when(F.col("points").isNull(), NO_POINTS).when(F.col("_date").isNull(), BAD_DATE))


def _is_dropped() -> Column:
    return F.coalesce(F.col("_reason").isin(*DROPPED), F.lit(False))


def kept_cash(judged: DataFrame) -> DataFrame:
    """The `hotel_cash` rows of judged documents."""
    rows = judged.filter(~_is_dropped()).withColumns({"date": F.col("_date"), "cash_value": F.col("_amount"), "currency": F.col("_currency")})
    return conform(rows, HOTEL_CASH)


def kept_points(judged: DataFrame) -> DataFrame:
    """The `hotel_points` rows of judged documents."""
    return conform(judged.filter(~_is_dropped()).withColumn("date", F.col("_date")), HOTEL_POINTS)


def quarantine(judged: DataFrame) -> DataFrame:
    """One row for each document with a reason: which one, what it said, and whether it was dropped or only its
    amount. Written next to the raw table, it can be cleaned again when rules change."""
    said = F.to_json("_price") if "_price" in judged.columns else F.col("points").cast("string")
    value = F.coalesce(F.col("cash_value"), said) if dict(judged.dtypes).get("cash_value") == "string" else said
    table = F.col("input_table") if "input_table" in judged.columns else F.lit(None).cast("string").alias("input_table")
    return judged.filter("_reason IS NOT NULL").select(
        table, "_id", "hotel_group", "created_at", "date", value.alias("value"), F.col("_reason").alias("reason"), _is_dropped().alias("dropped")
    )


def ledger(judged: DataFrame, *by: str) -> DataFrame:
    """Documents by outcome within `by`: `kept`, or a reason and whether it dropped them. The counts of a group add up to
    all that were read. One aggregation; a large group sends one row a task and outcome."""
    outcome = F.coalesce("_reason", F.lit("kept")).alias("outcome")
    return judged.groupBy(*by, outcome, _is_dropped().alias("dropped")).agg(F.count(F.lit(1)).alias("n"))
