"""Exact row numbers for keys of any size."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecal.session import new_folder, shuffle_width


def number_rows(df: DataFrame, keys, *order: Column, name="rn") -> DataFrame:
    """`row_number()` per key, without bringing a key's rows into one task.

    Rows are range-partitioned by key and order, so a large key is cut into consecutive
    runs. Rows are numbered within their run; a run's numbers then continue after the rows of
    the key's earlier runs, of which there are at most as many as partitions. Rows and their
    runs are written to the session's work folder in between, for both steps must see the same
    cuts even if executors are lost. All further columns complete the order; a row id lets even
    identical rows be cut.
    """
    spark, folder = df.sparkSession, new_folder(df.sparkSession)
    order = [*order, *[F.col(f"`{c}`").desc() for c in df.columns if c not in keys]]
    (
        df.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(shuffle_width(spark), *keys, *order, "_row")
        .withColumn("_run", F.spark_partition_id())
        .drop("_row")
        .write.parquet(folder)
    )
    ranged = spark.read.parquet(folder)
    within = Window.partitionBy(*keys, "_run").orderBy(*order)
    earlier = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        ranged.groupBy(*keys, "_run")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    # A run can only go on with a key at its beginning, so there are at most as many of these rows as partitions.
    later = runs.filter("_before > 0")
    numbered = ranged.withColumn("_within", F.row_number().over(within)).alias("a")
    same_run = F.col("a._run") == F.col("b._run")
    for key in keys:
        same_run &= F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}"))
    before = F.coalesce("_before", F.lit(0))
    return numbered.join(F.broadcast(later).alias("b"), same_run, "left").select(
        *[F.col(f"a.`{c}`") for c in df.columns], (F.col("_within") + before).alias(name)
    )
