"""Batch resume for stores that Spark can read but not stream: each run takes the documents behind the last key.

Keys are handed out in ascending order, as a document store does. What a run adds lies in a folder named by the key that it
starts behind, next to a row of figures in a folder of the same name; the next run starts behind the largest key in
the figures. Figures are written last, so a run that failed half-way is repeated from the same key and replaces its folder.
"""

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecal.functions.frames import conform
from ratecal.operators.documents import snapshot_dedupe
from ratecal.sources.tables import exists, with_lineage
from ratecal.streaming.incremental import KINDS

FIGURES = T.StructType([
    T.StructField("input_table", T.StringType()), T.StructField("run_id", T.StringType()), T.StructField("after", T.StringType()),
    T.StructField("upto", T.StringType()), T.StructField("n_read", T.LongType()), T.StructField("n_kept", T.LongType()),
    T.StructField("n_dropped", T.LongType()),
])


def read_figures(spark: SparkSession, target: str) -> DataFrame:
    """One row per chunk: the keys it spans (`after` is not in it, NULL: from the first), documents read, rows kept, documents
    that cleaning or deduplication dropped. No chunks give no rows."""
    path = f"{target}/figures"
    return spark.read.schema(FIGURES).parquet(f"{path}/*/*") if exists(spark, path) else spark.createDataFrame([], FIGURES)


def read_resumed(spark: SparkSession, target: str, kind: str) -> DataFrame:
    """The raw rows of all chunks that were finished or are being written."""
    schema = KINDS[kind][2]
    return spark.read.schema(schema).parquet(f"{target}/rows/*/*").select(*schema.names)


def last_key(spark: SparkSession, target: str, input_table: str) -> str | None:
    return read_figures(spark, target).filter(F.col("input_table") == input_table).agg(F.max("upto")).first()[0]


def ingest_behind(spark: SparkSession, docs: DataFrame, target: str, kind: str, input_table: str, run_id, extract_dt, ids_unique=False) -> int:
    """Cleans and stores the documents of one collection behind the last key of earlier runs; returns how many were read.

    The key range is an ordinary filter, which Spark pushes to the source. Its upper end is fixed by a first pass over keys
    alone, so documents that arrive meanwhile are left for the next run. A run whose documents are all invalid still moves
    the key. Documents without a key are in no range; a copy under an old key is not read again.
    """
    _, clean, columns = KINDS[kind]
    after = last_key(spark, target, input_table)
    behind = docs if after is None else docs.filter(F.col("_id") > after)
    upto, read = behind.filter("_id IS NOT NULL").agg(F.max("_id"), F.count(F.lit(1))).first()
    if not read:
        return 0
    name = "first" if after is None else hashlib.sha256(after.encode()).hexdigest()
    place = f"source={input_table}/after={name}"
    tagged = behind.filter(F.col("_id") <= upto).withColumns(
        {"hotel_group": F.substring_index(F.lit(input_table), "_", -1), "input_table": F.lit(input_table)}
    )
    rows = with_lineage(clean(snapshot_dedupe(tagged, ids_unique=ids_unique)), run_id, input_table, 0, extract_dt)
    conform(rows, columns).write.mode("overwrite").parquet(f"{target}/rows/{place}")
    # counted in what was stored: figures that tasks report while they run would count a repeated task twice
    kept = spark.read.schema(columns).parquet(f"{target}/rows/{place}").count()
    figures = spark.createDataFrame([(input_table, str(run_id), after, upto, read, kept, read - kept)], FIGURES)
    figures.coalesce(1).write.mode("overwrite").parquet(f"{target}/figures/{place}")
    return read
