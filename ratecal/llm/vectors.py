"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosines.

Vectors are normalised, so the cosine fixes their distance. Each table hashes a vector by
quantised projections on normal directions; vectors of one bucket are compared by their exact
cosine. A pair that meets in several tables counts in the first only.
"""

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecal.llm import chars
from ratecal.llm.components import components, forest
from ratecal.session import new_folder


@dataclass(frozen=True)
class Settings:
    """`least`: cosine of a link; `tables` x `depth`: projections; `width`: of a quantisation step. A pair
    at cosine 0.9 meets in one table with probability 0.82 ** 12, so the 48 tables miss under 1 %
    of such pairs and hardly any of the closer ones. `block`: vectors compared at once, at most;
    larger buckets are split into blocks that are compared pair by pair in different tasks."""

    least: float = 0.9
    tables: int = 48
    depth: int = 12
    width: float = 2.0
    block: int = 1024
    seed: int = 5


@lru_cache(maxsize=8)
def _projections(dims, settings):
    random = np.random.default_rng([settings.seed, dims])
    directions = random.normal(size=(dims, settings.tables * settings.depth)) / settings.width
    shifts = random.uniform(size=settings.tables * settings.depth)
    factors = random.integers(1 << 63, size=(settings.tables, settings.depth), dtype=np.uint64) | np.uint64(1)
    return directions, shifts, factors


def keys_of(unit, settings):
    """The bucket of each vector in each table, as int64."""
    directions, shifts, factors = _projections(unit.shape[1], settings)
    steps = np.floor(unit @ directions + shifts).astype(np.int64).view(np.uint64)
    steps = steps.reshape(len(unit), settings.tables, settings.depth)
    table = chars.mix(np.arange(settings.tables, dtype=np.uint64) + np.uint64(1000 * unit.shape[1]))
    return chars.mix((steps * factors).sum(axis=2) + table).view(np.int64)


def normalised(vectors):
    """Unit vectors in double precision, or None for one that is NULL, zero or holds NULL or a
    non-finite number. Dividing by the largest component first keeps squares finite."""
    out = []
    for v in vectors:
        if v is None or not len(v) or any(x is None for x in v):
            out.append(None)
            continue
        v = np.asarray(v, dtype=np.float64)
        top = np.abs(v).max()
        if not np.isfinite(top) or top == 0:
            out.append(None)
            continue
        v = v / top
        out.append(v / np.sqrt(v @ v))
    return out


def prepare(embeddings: DataFrame) -> DataFrame:
    """vec_id, high and low (a hash of the unit vector), unit (its bytes); NULLs for those that link
    with nothing."""

    def run(batches):
        for batch in batches:
            units = normalised(batch.column(1).to_pylist())
            data = [None if u is None else u.tobytes() for u in units]
            marks = [None if d is None else np.frombuffer(hashlib.blake2b(d, digest_size=16).digest(), dtype=np.int64) for d in data]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([None if m is None else int(m[0]) for m in marks], type=pa.int64()),
                    pa.array([None if m is None else int(m[1]) for m in marks], type=pa.int64()), pa.array(data, type=pa.binary()),
                ],
                names=["vec_id", "high", "low", "unit"],
            )

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.mapInArrow(run, "vec_id long, high long, low long, unit binary")


def _bucketed(first: DataFrame, settings: Settings) -> DataFrame:
    """(key, vec_id) of each vector in each table."""

    def run(batches):
        for batch in batches:
            ids, data = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            lengths = np.array([len(d) for d in data])
            for size in np.unique(lengths):
                own = np.flatnonzero(lengths == size)
                unit = np.frombuffer(b"".join([data[i] for i in own])).reshape(len(own), -1)
                keys = keys_of(unit, settings)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(ids[own], settings.tables))], names=["key", "vec_id"]
                )

    return first.select("vec_id", "unit").mapInArrow(run, "key long, vec_id long")


class Links:
    """Sums of the sizes of linked vectors, and a spanning forest of the links, of one task."""

    def __init__(self):
        self.ids, self.sums, self.a, self.b = [], [], [], []

    def add(self, ids, sums, a, b):
        if len(a):
            a, b = np.maximum(a, b), np.minimum(a, b)
            ends, root = forest(a, b)
            self.a.append(ends[ends != root])
            self.b.append(root[ends != root])
        some = sums > 0
        self.ids.append(ids[some])
        self.sums.append(sums[some])

    def batch(self):
        ids, where = np.unique(np.concatenate([*self.ids, np.zeros(0, np.int64)]), return_inverse=True)
        sums = np.bincount(where, weights=np.concatenate([*self.sums, np.zeros(0)]), minlength=len(ids)).astype(np.int64)
        a, b = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (self.a, self.b))
        self.__init__()
        kind = np.repeat([True, False], [len(ids), len(a)])
        return pa.RecordBatch.from_arrays(
            [pa.array(kind), pa.array(np.concatenate([ids, a])), pa.array(np.concatenate([sums, b]))], names=["counted", "a", "b"]
        )


def _compare(key, x, y, same, settings, links):
    """Links between the vectors x (ids, sizes, units, keys of all tables) and y of a bucket; `same` if
    both are the same block. Pairs that met in an earlier table are left to that."""
    linked = x[2] @ y[2].T >= settings.least
    if same:
        linked &= np.tri(len(linked), k=-1, dtype=bool).T
    i, j = np.nonzero(linked)
    if not len(i):
        return
    table = int(np.flatnonzero(x[3][0] == key)[0])
    for start in range(0, len(i), 1 << 18):
        a, b = i[start : start + (1 << 18)], j[start : start + (1 << 18)]
        fresh = ~(x[3][a, :table] == y[3][b, :table]).any(axis=1) if table else np.ones(len(a), dtype=bool)
        a, b = a[fresh], b[fresh]
        links.add(
            np.concatenate([x[0], y[0]]),
            np.concatenate(
                [np.bincount(a, weights=y[1][b], minlength=len(x[0])), np.bincount(b, weights=x[1][a], minlength=len(y[0]))]
            ),
            x[0][a], y[0][b],
        )


def _linked(members: DataFrame, settings: Settings) -> DataFrame:
    """Rows (counted, a, b): for a counted row, b is a part of the number of vectors that a links
    with; else a and b are ends of a link of the spanning forest.

    `members` has key, i, j, block, vec_id, size, unit; the rows of one (key, i, j), blocks i and j of a
    bucket, lie together in a partition.
    """

    def run(batches):
        links, done = Links(), 0
        for t in chars.grouped(batches, ("key", "i", "j")):
            if t.num_rows < 2:
                continue
            key, i, j = (t[c][0].as_py() for c in range(3))
            ids, sizes, block = t["vec_id"].to_numpy(), t["size"].to_numpy(), t["block"].to_numpy()
            unit = np.frombuffer(b"".join(t["unit"].to_pylist())).reshape(len(ids), -1)
            if len(ids) > 64 or len(linked_rows(unit, settings)):
                rows = (ids, sizes, unit, keys_of(unit, settings))
                x, y = ([r[block == n] for r in rows] for n in (i, j))
                if len(x[0]) and len(y[0]):
                    _compare(key, x, y, i == j, settings, links)
            done += len(ids)
            if done > 200_000:
                yield links.batch()
                done = 0
        yield links.batch()

    return members.select("key", "i", "j", "block", "vec_id", "size", "unit").mapInArrow(run, "counted boolean, a long, b long")


def linked_rows(unit, settings):
    """Rows of a small group that link with another row of it."""
    linked = unit @ unit.T >= settings.least
    return np.flatnonzero(linked.sum(axis=1) > 1)


def groups(embeddings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of `embeddings` (vec_id, embedding).

    A vector that is NULL, empty, zero, or holds NULL or a non-finite number links with nothing, and
    vectors of different lengths never link. Equal directions are one class with its number of
    members, so a vector with thousands of copies is compared once. Of repeated rows of a vec_id
    each counts as a vector of its own; rows without an id are compared with nothing, have no
    component and are kept.
    """
    spark = embeddings.sparkSession
    where = new_folder(spark)
    prepare(embeddings).write.parquet(where)
    table = spark.read.parquet(where)
    valid = table.filter("unit IS NOT NULL AND vec_id IS NOT NULL")
    classes = valid.groupBy("high", "low").agg(F.min("vec_id").alias("class"), F.count("*").alias("size"))
    first = valid.join(classes, ["high", "low"]).filter("vec_id = class").dropDuplicates(["high", "low"]).select("vec_id", "size", "unit")
    first = first.checkpoint()

    keyed = _bucketed(first, settings)
    full = keyed.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    blocks = F.ceil(F.col("m") / settings.block).cast("long")
    placed = keyed.join(full, "key").withColumn("blocks", blocks)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("vec_id", "key"), F.col("blocks"))).select("key", "vec_id", "block", "blocks")
    # block n of a bucket meets itself and every other block once
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    placed = placed.withColumn("other", other).select(
        "key", "vec_id", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    members = placed.join(first, "vec_id").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    where = new_folder(spark)
    _linked(members, settings).write.parquet(where)
    found = spark.read.parquet(where)

    links = found.filter("counted").groupBy(F.col("a").alias("class")).agg(F.sum("b").alias("others"))
    parts = components(found.filter("NOT counted").select("a", "b")).withColumnRenamed("node", "class")
    known = classes.join(links, "class", "left").join(parts, "class", "left").select(
        "high", "low", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "class").alias("component_id")
    )
    # rows without a hash or id find no class, whatever they hold
    own = table.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("high")).alias("high"), "low")
    rows = own.join(known, ["high", "low"], "left")
    component = F.coalesce("component_id", "vec_id")
    return rows.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
