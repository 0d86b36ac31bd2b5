"""Row-level helpers: newest row of a key, fixed schemas, spreading small inputs out."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecal.session import shuffle_width


def newest(df: DataFrame, keys, *order: Column) -> DataFrame:
    """One row per key, the first in `order`. NULL keys form a group of their own.

    All further columns complete the order, so the choice does not depend on where rows
    lie. Spark applies the limit of one row per key before the shuffle as well as after it
    (WindowGroupLimit), so a key with very many copies sends one row per task.
    """
    ties = [F.col(f"`{c}`").desc() for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def spread(df: DataFrame, *columns, width: int | None = None) -> DataFrame:
    """Hash-partition to a fixed width, by default the session's shuffle width, which adaptive
    execution leaves alone: it would merge partitions by their size before the rows in them
    are multiplied. Jobs on large tables set that width (`spark.sql.shuffle.partitions`) or pass one."""
    return df.repartition(width or shuffle_width(df.sparkSession), *columns)


def in_order(df: DataFrame, *columns) -> DataFrame:
    """Sorted as by `orderBy`, in as many ranges as the session's shuffle width, which adaptive execution leaves alone."""
    return df.repartitionByRange(shuffle_width(df.sparkSession), *columns).sortWithinPartitions(*columns)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of `schema`, in its order: absent ones as typed NULLs, others
    dropped, and values that do not fit the type NULL."""
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty strings become NULL in every text column."""
    return df.withColumns(
        {f.name: F.nullif(F.col(f"`{f.name}`"), F.lit("")) for f in df.schema if isinstance(f.dataType, T.StringType)}
    )


def ratio(numerator, denominator) -> Column:
    """Quotient of two exact sums as a double; NULL for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
