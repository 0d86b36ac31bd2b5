"""A stored copy of a collection, of which one interval of scrape times is replaced at a time."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecal.sources.collections import created_between
from ratecal.sources.tables import exists

DAY = "scrape_day"


def read_copy(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema, T.StructField(DAY, T.DateType())])).parquet(path).select(*schema.names)


def replace_window(docs: DataFrame, path: str, start, end) -> None:
    """Makes the copy hold, of the half-open interval from `start` to `end`, what `docs` holds of it, and leaves the rest.

    The copy lies in folders by scrape day. Days of the interval are written again (dynamic partition overwrite), those at its
    ends together with their stored rows outside of it; days that `docs` has no longer are removed after that. All
    other days keep their files. Repeating it changes nothing, so a failed copy may start over.
    """
    spark, names = docs.sparkSession, docs.columns
    first, last = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    rows = created_between(docs, start, end).withColumn(DAY, F.to_date("created_at"))
    known = []
    if exists(spark, path):
        schema = T.StructType([*docs.schema, T.StructField(DAY, T.DateType())])
        low, high = F.to_date(first), F.to_date(last - F.expr("INTERVAL 1 MICROSECOND"))
        stored = spark.read.schema(schema).parquet(path).filter(F.col(DAY).between(low, high))
        at_ends = stored.filter(F.col(DAY).isin(low, high))
        outside = at_ends.filter((F.col("created_at") < first) | (F.col("created_at") >= last))
        rows = rows.unionByName(outside.select(*names, DAY))
        # days of the interval: as many as the calendar has
        left = stored.select(DAY).distinct().join(rows.select(DAY).distinct(), DAY, "left_anti")
        known = [r[0] for r in left.collect()]
    (
        rows.hint("rebalance", DAY).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)
    )
    _remove_days(spark, path, known)


def _remove_days(spark: SparkSession, path: str, days: list[date]) -> None:
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for day in days:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{DAY}={day.isoformat()}"), True)
