"""Clean quotes kept current: each chunk of new quotes is merged into a stored table, partitioned by booking day."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecal.functions.frames import conform, newest
from ratecal.operators.clean import cash_quotes, points_quotes
from ratecal.operators.documents import clean_cash, clean_points
from ratecal.schemas import CASH_DOCUMENT, CELL, POINTS_DOCUMENT, PRICE
from ratecal.sources.tables import exists

_COMMON = [("hotel_group", T.StringType()), ("hotel_name_key", T.StringType()), ("hotel_id", T.StringType()), ("date_stay", T.DateType())]
_SEEN = [("created_at", T.TimestampNTZType()), ("_id", T.StringType()), ("date_booked", T.DateType())]


def _schema(*own):
    return T.StructType([T.StructField(name, kind) for name, kind in (*_COMMON, *own, *_SEEN)])


CURRENT = {"cash": _schema(("cash", PRICE), ("currency", T.StringType())), "points": _schema(("points", PRICE))}
# kind -> document schema, and the steps from documents to clean quotes
_STEPS = {"cash": (CASH_DOCUMENT, clean_cash, cash_quotes), "points": (POINTS_DOCUMENT, clean_points, points_quotes)}


def read_current(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(CURRENT[kind]).parquet(path)


def merge_quotes(quotes: DataFrame, path: str, kind: str) -> None:
    """Adds clean quotes to the stored table: the newest of each cell stays, whether it comes early or late.

    Only booking days that the chunk holds are read and written again (dynamic partition overwrite); all
    others keep their files. A chunk that is repeated changes nothing, so a run may fail at any point and start over. A
    day's rows are dealt by size, so one with most of the quotes is written by many tasks.
    """
    spark = quotes.sparkSession
    rows = conform(quotes, CURRENT[kind])
    if exists(spark, path):
        days = rows.select("date_booked").distinct()
        rows = rows.unionByName(read_current(spark, path, kind).join(days, "date_booked", "left_semi"))
    merged = newest(rows, list(CELL), F.col("created_at").desc(), F.col("_id").desc())
    (
        merged.hint("rebalance", "date_booked").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("date_booked").parquet(path)
    )


def keep_current(spark: SparkSession, source: str, target: str, checkpoint: str, kind: str, format: str = "json", **options) -> None:
    """Merges the documents that have arrived since the last run, each chunk of the stream for itself. The checkpoint says
    where to resume; a chunk that is repeated after a failure is merged again, without effect."""
    schema, clean, quotes = _STEPS[kind]
    stream = spark.readStream.schema(schema).format(format).options(**options).load(source)
    query = (
        stream.writeStream.foreachBatch(lambda docs, _: merge_quotes(quotes(clean(docs)), target, kind))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
