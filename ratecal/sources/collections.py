"""Collections: one source per hotel group, kind (cash or points) and age (live or archived).

A collection is any Spark source. Its name carries its meaning: `archived_` marks old
data, `_cash_` marks cash quotes, and the part after the last underscore is the hotel group.
"""

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecal.schemas import GROUP, HOTEL, KEY


def scan(spark: SparkSession, path, schema: T.StructType, format="json", **options) -> DataFrame:
    """All documents of a collection under a declared schema; nothing is inferred."""
    return spark.read.format(format).schema(schema).options(**options).load(path)


def top_rows(docs: DataFrame, n: int, *order: Column, where: Column | None = None) -> DataFrame:
    """The first `n` matching rows in `order` (Spark keeps only `n` rows per task while sorting)."""
    kept = docs if where is None else docs.filter(where)
    return kept.orderBy(*order).limit(n)


def smallest_id(docs: DataFrame) -> DataFrame:
    return docs.agg(F.min("_id").alias("min_id"))


def row_count(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).alias("row_count"))


def choose_collections(names: Iterable[str], archived: bool, cash: bool) -> list[str]:
    """The names on one side of both flags, in the order given."""
    return [n for n in names if ("archived_" in n) == archived and ("_cash_" in n) == cash]


def union_collections(collections: Mapping[str, DataFrame]) -> DataFrame:
    """All rows of several collections, with their origin. The group in the collection's name
    replaces the one in the document; columns a collection lacks become NULL."""
    tagged = [
        docs.withColumns({"input_table": F.lit(name), GROUP: F.substring_index(F.lit(name), "_", -1)})
        for name, docs in collections.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def in_city(docs: DataFrame, city: str, spelling: Mapping[str, str] | None = None) -> DataFrame:
    """Documents of one city, where single hotel groups may spell it differently."""
    wanted = F.lit(city)
    for group, name in (spelling or {}).items():
        wanted = F.when(F.col(GROUP) == group, name).otherwise(wanted)
    # the list of all spellings follows from it, and can be pushed to the scan
    return docs.filter(F.col("city").isin(city, *(spelling or {}).values()) & (F.col("city") == wanted))


def only_hotels(docs: DataFrame, hotels: DataFrame) -> DataFrame:
    """Rows whose (group, key) is listed. No join hint: Spark broadcasts the list if its size
    allows and otherwise shuffles, splitting a key that holds too many rows."""
    return docs.join(hotels.select(*HOTEL), list(HOTEL), "left_semi")


def without_hotels(docs: DataFrame, hotels: DataFrame) -> DataFrame:
    """Rows whose (group, key) is not listed, including rows without a key."""
    return docs.join(hotels.select(*HOTEL), list(HOTEL), "left_anti")


def only_keys(docs: DataFrame, keys: DataFrame) -> DataFrame:
    return docs.join(keys.select(KEY), KEY, "left_semi")


def without_keys(docs: DataFrame, keys: DataFrame) -> DataFrame:
    return docs.join(keys.select(KEY), KEY, "left_anti")


def created_between(docs: DataFrame, start, end) -> DataFrame:
    """Documents scraped in the half-open interval from `start` to `end`."""
    created = F.col("created_at")
    return docs.filter(
        (created >= F.lit(start).cast("timestamp_ntz")) & (created < F.lit(end).cast("timestamp_ntz"))
    )


def id_range(docs: DataFrame, start, end) -> DataFrame:
    """Documents in the key range that a time interval spans. The two bounds are scalar
    subqueries, so the range is an ordinary filter on the scan's key."""
    bounds = created_between(docs, start, end)
    low = bounds.agg(F.min("_id")).scalar()
    high = bounds.agg(F.max("_id")).scalar()
    return docs.filter((F.col("_id") >= low) & (F.col("_id") <= high))


def window_copy(docs: DataFrame, name: str, start, end) -> DataFrame:
    """What a copy of a collection holds: calendar collections are cut to the time interval,
    all others (templates) are copied whole."""
    return created_between(docs, start, end) if "hotel_calendar" in name else docs
