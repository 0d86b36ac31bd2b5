"""Incremental ingest of quote documents: each run takes the files that have arrived since the last.

A file stream with an `availableNow` trigger stands in for paging by key: the stream's
checkpoint, not a caller's last key, says where to resume.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecal.functions.frames import conform
from ratecal.operators.documents import clean_cash, clean_points, snapshot_dedupe
from ratecal.schemas import CASH_DOCUMENT, HOTEL_CASH, HOTEL_POINTS, POINTS_DOCUMENT
from ratecal.sources.tables import with_lineage

# kind -> document schema, cleaning step, raw table schema
KINDS = {
    "cash": (CASH_DOCUMENT, clean_cash, HOTEL_CASH),
    "points": (POINTS_DOCUMENT, clean_points, HOTEL_POINTS),
}


def ingest_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    kind: str,
    input_table: str,
    run_id,
    extract_dt,
    files_per_chunk: int | None = None,
    ids_unique=False,
    format: str = "json",
    **options,
) -> None:
    """Cleans the new documents of one collection and adds them to a raw table. `format` and
    `options` say how a stream of them is read.

    Every chunk is written to a folder of its own, named by the stream and its batch number. A
    stream is its checkpoint: with a new one, numbers start again, but under another name. A chunk
    that is repeated after a failure replaces its folder, whichever run repeats it, so none is
    stored twice and none is lost. Copies across chunks stay in the raw table; the clean tables
    settle them. (A watermark would drop them earlier, but also late documents with them.)
    """
    schema, clean, columns = KINDS[kind]
    reader = spark.readStream.schema(schema)
    if files_per_chunk:
        reader = reader.option("maxFilesPerTrigger", files_per_chunk)

    def store(docs: DataFrame, chunk: int) -> None:
        tagged = docs.withColumns(
            {"hotel_group": F.substring_index(F.lit(input_table), "_", -1), "input_table": F.lit(input_table)}
        )
        rows = with_lineage(clean(snapshot_dedupe(tagged, ids_unique=ids_unique)), run_id, input_table, chunk, extract_dt)
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        folder = f"{target}/source={input_table}/stream={stream}/chunk={chunk}"
        conform(rows, columns).write.mode("overwrite").parquet(folder)

    query = (
        reader.format(format).options(**options).load(source)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_raw(spark: SparkSession, target: str, schema: T.StructType, source: str | None = None) -> DataFrame:
    """All chunks of all collections ingested into a raw table, or of one of them: its folder is
    named by the collection, so only that is read."""
    rows = spark.read.schema(schema).parquet(target)
    if source is not None:
        rows = rows.filter(F.col("source") == source)
    return rows.select(*schema.names)
