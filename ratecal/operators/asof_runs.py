"""Strict as-of neighbours by time stamp, for keys of any size: nothing needs a key's rows in one task."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecal.session import new_folder

SIDES = ("prev", "next")


def one_per_time(quotes: DataFrame, keys, time: str, value: str, order: str) -> DataFrame:
    """Of quotes at the same time of a key, the one that is largest by `order`; added up in each task before the shuffle.
    Quotes without a time or a value are none."""
    kept = quotes.filter(F.col(time).isNotNull() & F.col(value).isNotNull())
    return kept.groupBy(*keys, time).agg(F.max_by(value, F.struct(order, value)).alias(value))


def neighbours_of_any_size(rows: DataFrame, quotes: DataFrame, keys, time: str, value: str, order="_id") -> DataFrame:
    """Adds to every row the value and time of the quote of its key that is nearest before it and after it:
    `<value>_prev`, `<value>_prev_at`, `<value>_next`, `<value>_next_at`. A quote at the row's own time is
    neither. NULL keys are a key of their own; a row without a time has no neighbours.

    Rows and quotes are dealt by ranges of (key, time), so that a large key lies in many runs, one behind the other.
    Each run tells its first and last quote of each key; the nearest of these outside a run is put into
    it, and a window over (key, run) then sees all it needs. Runs are written once, which fixes where their cuts are.
    """
    spark = rows.sparkSession
    keys, names = list(keys), rows.columns
    ordered = one_per_time(quotes, keys, time, value, order)
    row = F.struct(*names)
    both = rows.select(*keys, F.col(time).alias("_at"), F.lit(None).cast(quotes.schema[value].dataType).alias("_quote"), row.alias("_row"))
    told = ordered.select(*keys, F.col(time).alias("_at"), F.col(value).alias("_quote"))
    where = new_folder(spark)
    dealt = both.unionByName(told, allowMissingColumns=True).repartitionByRange(*keys, "_at")
    dealt = dealt.withColumn("_run", F.spark_partition_id())
    dealt.write.parquet(where)
    runs = spark.read.schema(dealt.schema).parquet(where)

    quote = F.struct("_at", "_quote")
    ends = runs.groupBy(*keys, "_run").agg(
        F.max(F.when(F.col("_quote").isNotNull(), quote)).alias("last"), F.min(F.when(F.col("_quote").isNotNull(), quote)).alias("first")
    )
    # as many rows a key as it has runs
    order_of_runs = Window.partitionBy(*keys).orderBy("_run")
    before = F.last("last", ignorenulls=True).over(order_of_runs.rowsBetween(Window.unboundedPreceding, -1))
    after = F.last("first", ignorenulls=True).over(Window.partitionBy(*keys).orderBy(F.desc("_run")).rowsBetween(Window.unboundedPreceding, -1))
    carried = ends.withColumns({"_before": before, "_after": after})
    carried = carried.select(*keys, "_run", F.explode(F.array("_before", "_after")).alias("_x")).filter("_x IS NOT NULL")
    seen = runs.unionByName(carried.select(*keys, "_run", "_x.*"), allowMissingColumns=True)

    number = F.unix_micros(F.col("_at").cast("timestamp"))
    own = Window.partitionBy(*keys, "_run")
    found = {
        "prev": F.last(F.when(F.col("_quote").isNotNull(), quote), ignorenulls=True).over(own.orderBy(number).rangeBetween(Window.unboundedPreceding, -1)),
        "next": F.last(F.when(F.col("_quote").isNotNull(), quote), ignorenulls=True).over(own.orderBy(-number).rangeBetween(Window.unboundedPreceding, -1)),
    }
    seen = seen.withColumns({f"_{side}": column for side, column in found.items()}).filter("_row IS NOT NULL")
    timed = F.col("_at").isNotNull()
    return seen.select("_row.*", *[
        F.when(timed, F.col(f"_{side}.{part}")).alias(name)
        for side in SIDES for part, name in (("_quote", f"{value}_{side}"), ("_at", f"{value}_{side}_at"))
    ])
