"""Which rows may be learned from, and bounded samples of labelled texts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remainder(key: str = "doc_id", parts: int = 4):
    return F.crc32(F.col(key).cast("string")) % parts


def held_out(key: str = "doc_id", parts: int = 4, part: int = 2):
    """Whether a row is kept from learning; rows without an id are not held out."""
    return F.coalesce(remainder(key, parts) == part, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, per_class: int):
    """(texts, weights): rows `text`, `y` of at most `per_class` documents of each label, chosen by
    a hash of their ids, and the weight that gives each label its share of all labelled rows.

    Held-out rows, NULL ids, texts and labels are left out. An id with several labels has the
    largest; one with several texts has the smallest of them. The chosen ids are bounded by `per_class`, so they may
    be broadcast.
    """
    known = (
        labels.select("doc_id", F.col(column).cast("int").alias("y"))
        .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (remainder() != 2))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    chosen = None
    for y in (0, 1):
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    total = sum(sizes.values())
    weights = {y: sizes[y] / total / min(sizes[y], per_class) for y in sizes}
    return texts.select("text", "y"), weights
