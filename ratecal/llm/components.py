"""Connected components of an edge list, distributed."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecal.session import work_folder


def forest(a, b):
    """Components of the edges (a[i], b[i]): the distinct ends, sorted, and the smallest number in the
    component of each. Minima are passed along edges and pointers halved, all in numpy."""
    ends, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = where[: len(a)], where[len(a) :]
    root = np.arange(len(ends))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == root).all():
            return ends, ends[root]
        root = new


def contract(edges: DataFrame) -> DataFrame:
    """Edges a > b of the same components: every partition replaces its own edges by stars, so at
    most one edge remains for each node that a partition has."""

    def run(batches):
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            a = np.concatenate([a, batch.column(0).to_numpy()])
            b = np.concatenate([b, batch.column(1).to_numpy()])
            a, b = forest(a, b)
            a, b = a[a != b], b[a != b]
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge `a`, `b` (longs, not NULL) to another; the
    component is its smallest node. No edges give no rows.

    Large-star and small-star steps: each node links its larger, then its smaller neighbours to
    the smallest it knows, until nothing changes; steps grow with the logarithm of the longest
    path. Each round is written to the checkpoint folder, which cuts its lineage. Only sums come
    to the driver.
    """
    work_folder(edges.sparkSession)
    # equal shares by the hash of an end, then stars within each share
    edges = contract(contract(edges.filter("a <> b")).repartition("b")).checkpoint()
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        smaller = large.filter("a > b").distinct()
        least = smaller.groupBy("a").agg(F.min("b").alias("m"))
        linked = smaller.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = linked.union(least.select("a", F.col("m").alias("b"))).distinct().checkpoint()
        state = edges.agg(F.count("*"), F.sum(F.col("b").cast("decimal(38,0)")), F.sum(F.col("a").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.union(found.select(F.col("component").alias("node"), "component").distinct())
