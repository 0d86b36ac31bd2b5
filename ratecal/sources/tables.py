"""Tables written by the jobs: append, overwrite, export and the run manifest.

Targets are paths plus a Spark format and options, all from the caller: no connection
settings or credentials live here. Any installed source works, e.g. `format="jdbc"`
with `url`, `dbtable` and `batchsize`.
"""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecal.functions.frames import conform
from ratecal.schemas import RUN


def with_lineage(df: DataFrame, run_id, input_table=None, chunk_n=None, extract_dt=None) -> DataFrame:
    """Adds the run, source collection, chunk and time; a value left out keeps the column as it is."""
    given = {
        "run_id": F.lit(run_id).cast("string"),
        "input_table": None if input_table is None else F.lit(input_table),
        "chunk_n": None if chunk_n is None else F.lit(chunk_n).cast("int"),
        "extract_dt": None if extract_dt is None else F.lit(extract_dt).cast("timestamp_ntz"),
    }
    return df.withColumns({name: value for name, value in given.items() if value is not None})


def append(df: DataFrame, path: str | None, schema: T.StructType, format="parquet", partition_by=(), **options) -> None:
    """Appends rows in the declared schema, creating the table with the first ones."""
    conform(df, schema).write.format(format).mode("append").partitionBy(*partition_by).options(**options).save(path)


def write_run(df: DataFrame, path: str, schema: T.StructType, run_id) -> None:
    """Stores what one run adds to a table, in a folder of its own: a run that is repeated replaces
    its rows and touches no others."""
    conform(df, schema).write.mode("overwrite").parquet(f"{path}/run={run_id}")


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of runs, in its declared columns."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def overwrite(df: DataFrame, path: str | None, format="parquet", partition_by=(), **options) -> None:
    """Replaces a table by the rows of a query."""
    df.write.format(format).mode("overwrite").partitionBy(*partition_by).options(**options).save(path)


def create_table(df: DataFrame, name: str, partition_by=(), buckets: int | None = None, bucket_by=()) -> DataFrame:
    """Drops and recreates a catalog table from a query. Bucketed on the join keys, two
    tables meet later without a shuffle."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def start_run(spark: SparkSession, path: str, name: str, details: str = "", run_dt: datetime | None = None) -> int:
    """Appends a row to the run manifest and returns its number, one above the last. The
    manifest holds one row per run and has a single writer."""
    last = 0
    if exists(spark, path):
        last = spark.read.schema(RUN).parquet(path).agg(F.max("run_id")).first()[0] or 0
    row = (last + 1, name, details, run_dt or datetime.now(timezone.utc).replace(tzinfo=None))
    append(spark.createDataFrame([row], RUN), path, RUN)
    return last + 1


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)
