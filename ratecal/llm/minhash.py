"""Near-duplicate documents by MinHash bands, odd sketches and exact comparison.

A document's MinHash samples give band keys, and each sample flips one bit of its odd sketch. The
bits in which two sketches differ tell how many samples differ, so candidates of a band are
compared by XOR and a count of bits. A second odd sketch, of the shingles themselves, never
differs in more bits than the sets in elements: for sets that are not much larger than it, hardly
any pair passes that is not similar enough. Those that pass are compared on their full sets.
"""

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecal.llm import bits, chars
from ratecal.llm.components import components
from ratecal.session import new_folder


@dataclass(frozen=True)
class Settings:
    """`words`: of a shingle; `percent`: least similarity; `bands` x `rows`: MinHash samples for the keys;
    `samples`: all of them, for their sketch; `size` and `whole`: bits of the sketches of samples and
    shingles, multiples of 64; `slack`: by how much an estimate from samples may fall short of the
    least similarity and still be compared (over four standard errors of 0.02); `block`: documents
    of a bucket that are compared with as many others at a time."""

    words: int = 3
    percent: int = 85
    bands: int = 24
    rows: int = 5
    samples: int = 360
    size: int = 1024
    whole: int = 2048
    slack: float = 0.09
    block: int = 1024
    seed: int = 3

    @property
    def differing(self) -> int:
        """Most bits in which the sketches of candidates differ."""
        samples = 2 * self.samples * (1 - self.percent / 100 + self.slack)
        return math.ceil(self.size / 2 * (1 - (1 - 2 / self.size) ** samples))


def shingle_sets(texts, words):
    """The sorted distinct hashes of each text's shingles; a text of fewer words is one shingle."""
    codes = chars.Codes(texts)
    points = chars.ascii_lower(codes.points)
    start, end = chars.runs(~chars.ascii_space(points))
    word = chars.segment_hashes(points, start, end)
    cuts = np.searchsorted(start, np.concatenate([[0], codes.ends]))
    factors = chars.mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    whole = np.zeros(max(len(word) - words + 1, 0), dtype=np.uint64)
    for k in range(words):
        whole += word[k : k + len(whole)] * factors[k]
    whole = chars.mix(whole)
    for i in range(len(texts)):
        a, b = cuts[i], cuts[i + 1]
        if b - a >= words:
            yield np.unique(whole[a : b - words + 1])
        elif b > a:
            yield chars.mix((word[a:b] * factors[: b - a]).sum(keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, dtype=np.uint64)


def _samples(found, factor, shift):
    """The least hash of a set under each of the functions."""
    narrow = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factor), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(narrow), 2048):
        np.minimum(least, (narrow[at : at + 2048] * factor[:, None] + shift[:, None]).min(axis=1), out=least)
    return least


def _parities(hashes, size):
    """One bit for each number below `size`: whether an odd count of hashes falls there."""
    flips = np.bincount((hashes % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(flips.astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n (size of the set), high and low (a hash of the set), bands and both sketches, odd and
    whole, for each row."""
    random = np.random.default_rng(settings.seed)
    samples = settings.samples
    factor = random.integers(1 << 32, size=samples, dtype=np.uint32) | np.uint32(1)
    shift = random.integers(1 << 32, size=samples, dtype=np.uint32)
    row_factor = random.integers(1 << 63, size=(settings.bands, settings.rows), dtype=np.uint64) | np.uint64(1)
    which = np.arange(samples, dtype=np.uint64) << np.uint64(32)
    band = np.arange(settings.bands, dtype=np.uint64)

    def run(batches):
        for batch in batches:
            n, high, low, keys, odd, whole = [], [], [], [], [], []
            for _, _, texts in chars.parts(batch.column(1)):
                for found in shingle_sets(texts, settings.words):
                    n.append(len(found))
                    high.append(int(found.sum().view(np.int64)))
                    low.append(int(chars.mix(found).sum().view(np.int64)))
                    if not len(found):
                        keys.append(None)
                        odd.append(None)
                        whole.append(None)
                        continue
                    least = _samples(found, factor, shift)
                    rows = least[: settings.bands * settings.rows].reshape(settings.bands, -1)
                    rows = (rows.astype(np.uint64) * row_factor).sum(axis=1)
                    keys.append(chars.mix(rows + chars.mix(band)).view(np.int64))
                    odd.append(_parities(chars.mix(which + least), settings.size))
                    whole.append(_parities(found, settings.whole))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n, type=pa.int64()), pa.array(high, type=pa.int64()), pa.array(low, type=pa.int64()),
                    pa.array(keys, type=pa.list_(pa.int64())), pa.array(odd, type=pa.list_(pa.int64())),
                    pa.array(whole, type=pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "high", "low", "bands", "odd", "whole"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, high long, low long, bands array<long>, odd array<long>, whole array<long>")


def _full_sets(docs: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """doc_id and set of the documents in `wanted`, by one pass over all; a bitmap drops most others
    before they are read as words, an exact join the rest. A task tells repeated rows of a document once; where the
    texts of an id differ, each set counts."""
    shared = docs.sparkSession.sparkContext.broadcast(bits.bitmap(wanted.select(F.xxhash64("doc_id"))))

    def run(batches):
        told = set()
        for batch in batches:
            batch = batch.filter(pa.array(bits.member(shared.value, batch.column(1).to_numpy())))
            for a, b, texts in chars.parts(batch.column(2)):
                rows = []
                for doc, found in zip(batch.column(0).slice(a, b - a).to_pylist(), shingle_sets(texts, settings.words)):
                    if (mark := (doc, len(found), int(found.sum()))) not in told:
                        told.add(mark)
                        rows.append((doc, found.view(np.int64)))
                ids, sets = pa.array([d for d, _ in rows], type=pa.int64()), pa.array([s for _, s in rows], type=pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, sets], names=["doc_id", "set"])
        chars.release()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    rows = rows.select("doc_id", F.xxhash64("doc_id").alias("at"), "text")
    return rows.mapInArrow(run, "doc_id long, set array<long>").join(wanted, "doc_id", "left_semi")


def _confirm(docs, pairs, settings):
    """Those of the pairs a, b whose full sets are similar enough."""
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = _full_sets(docs, wanted, settings)
    where = new_folder(docs.sparkSession)
    sets.write.parquet(where)
    sets = docs.sparkSession.read.schema(sets.schema).parquet(where)
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("x")), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("set").alias("y")), "b"
    )
    shared = F.size(F.array_intersect("x", "y")).cast("long")
    union = F.size("x") + F.size("y") - shared
    return both.filter(shared * 100 >= union * settings.percent).select("a", "b")


def _alike(settings):
    """Condition on two candidates (columns n, odd, whole and n2, odd2, whole2): sizes and sketches allow
    the least similarity. Similar enough sets differ in at most (100 - percent) / (100 + percent) of the
    elements that both have together."""

    def differ(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)

    sizes = F.least("n", "n2") * 100 >= F.greatest("n", "n2") * settings.percent
    elements = differ("whole", "whole2") * (100 + settings.percent) <= (F.col("n") + F.col("n2")) * (100 - settings.percent)
    return sizes & elements & (differ("odd", "odd2") <= settings.differing)


def _blocks(members, look, parts, settings) -> DataFrame:
    """key, i, j, block, apart, doc_id, part, n, odd, whole: the members of blocks i and j of a bucket lie
    together, for every two blocks that hold different components. `apart`: not in the bucket's largest.

    A component of at least `block` members has blocks of its own, which never meet each other;
    smaller ones share blocks. So a large component beside a few other documents is copied once for
    each block of these, whatever its ids.
    """
    label = parts.select(F.col("node").alias("doc_id"), F.col("component").alias("part"))
    placed = members.select("key", "doc_id").join(label, "doc_id", "left").withColumn("part", F.coalesce("part", "doc_id"))
    count = lambda c: F.ceil(c / settings.block).cast("long")
    sizes = placed.groupBy("key", "part").agg(F.count("*").alias("c"))
    large = F.col("c") >= settings.block
    buckets = sizes.groupBy("key").agg(
        F.count("*").alias("parts"), F.max(F.struct("c", "part"))["part"].alias("largest"),
        count(F.coalesce(F.sum(F.when(~large, F.col("c"))), F.lit(0))).alias("shared"),
        F.coalesce(F.sum(F.when(large, count(F.col("c")))), F.lit(0)).alias("own"),
    ).filter("parts > 1")
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    own = sizes.filter(large).withColumn("blocks", count(F.col("c")))
    own = own.withColumn("first", F.coalesce(F.sum("blocks").over(before), F.lit(0))).select("key", "part", "blocks", "first")
    spots = sizes.select("key", "part").join(buckets, "key").join(own, ["key", "part"], "left")
    first = F.col("shared") + F.col("first")
    spots = spots.select("key", "part", "largest", "shared", "blocks", first.alias("first"), (F.col("shared") + F.col("own")).alias("all"))
    mine = F.when(F.col("blocks").isNull(), F.pmod(F.xxhash64("part", "key"), F.col("shared"))).otherwise(
        F.col("first") + F.pmod(F.xxhash64("doc_id", "key"), F.col("blocks"))
    )
    meets = F.filter(
        F.sequence(F.lit(0).cast("long"), F.col("all") - 1),
        lambda k: F.col("blocks").isNull() | (k < F.col("first")) | (k >= F.col("first") + F.col("blocks")),
    )
    rows = placed.join(spots, ["key", "part"]).select(
        "key", "doc_id", "part", (F.col("part") != F.col("largest")).alias("apart"), mine.alias("block"), meets.alias("meets")
    )
    rows = rows.join(look, "doc_id").withColumn("other", F.explode("meets"))
    i, j = F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    return rows.select("key", i, j, "block", "apart", "doc_id", "part", "n", "odd", "whole")


def _across(members, look, parts, settings, closest) -> DataFrame:
    """Pairs a, b of a bucket's documents in different components that sizes and sketches allow to be
    linked: of each document that is not in its bucket's largest component, all of them or the
    `closest` one. Buckets within one component have none.

    Each two blocks of a bucket meet in a task of their own; the sketches are compared there, in
    numpy, and only pairs leave it.
    """

    def pairs(t):
        block, apart, ids, part, n = (t[c].to_numpy() for c in ("block", "apart", "doc_id", "part", "n"))
        key, i, j = (t[c][0].as_py() for c in ("key", "i", "j"))
        odd, whole = (t[c].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(ids), -1) for c in ("odd", "whole"))
        x, y = np.flatnonzero(block == i), np.flatnonzero(block == j)
        step = max(1, (1 << 22) // max(1, len(y) * (odd.shape[1] + whole.shape[1])))
        for at in range(0, len(x), step):
            u = x[at : at + step]
            differ, elements = (np.bitwise_count(s[u][:, None, :] ^ s[y]).sum(axis=2, dtype=np.int64) for s in (odd, whole))
            small, large = np.minimum.outer(n[u], n[y]), np.maximum.outer(n[u], n[y])
            may = (part[u][:, None] != part[y]) & (small * 100 >= large * settings.percent) & (differ <= settings.differing)
            may &= elements * (100 + settings.percent) <= np.add.outer(n[u], n[y]) * (100 - settings.percent)
            if not may.any():
                continue
            if closest:
                far = np.where(may, differ, 1 << 30)
                for own, others, d in ((u, y, far), (y, u, far.T))[: 1 + (i != j)]:
                    best = d.argmin(axis=1)
                    least = d[np.arange(len(own)), best]
                    a = np.flatnonzero(apart[own] & (least < 1 << 30))
                    yield key, ids[own[a]], ids[others[best[a]]], least[a]
            else:
                a, b = np.nonzero(may)
                yield key, np.maximum(ids[u[a]], ids[y[b]]), np.minimum(ids[u[a]], ids[y[b]]), differ[a, b]

    def run(batches):
        for t in chars.grouped(batches, ("key", "i", "j")):
            for key, a, b, differ in pairs(t):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(a), key)), pa.array(a), pa.array(b), pa.array(differ)], names=["key", "a", "b", "differ"]
                )

    rows = _blocks(members, look, parts, settings).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    found = rows.mapInArrow(run, "key long, a long, b long, differ long")
    if closest:
        found = found.groupBy("key", "a").agg(F.min(F.struct("differ", "b"))["b"].alias("b"))
    return found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def groups(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs`.

    Words are split at ASCII white space after lower-casing A-Z. A document without words (empty or
    NULL text) links with nothing. A row without an id links with nothing, has no component and is
    kept. Repeated rows of an id share its component; where their texts differ, each row has the
    component of its own text.

    Equal sets are one class, so thousands of copies cost as much as one. In each bucket of a band
    every class is compared with the smallest one. Those that this leaves in other components are
    compared with the class that their sketch is closest to, and whoever is left then, with all that
    sketches allow. So a bucket of near copies takes about as many full comparisons as it has
    classes, and no link between components is missed.
    """
    spark = docs.sparkSession
    where = new_folder(spark)
    sketches(docs, settings).write.parquet(where)
    table = spark.read.parquet(where)

    filled = table.filter("n > 0 AND doc_id IS NOT NULL")
    classes = filled.groupBy("high", "low", "n").agg(F.min("doc_id").alias("class"))
    first = filled.select("doc_id", "n", "high", "low", "bands", "odd", "whole").join(
        classes.select(F.col("class").alias("doc_id"), "high", "low", "n"), ["doc_id", "high", "low", "n"], "left_semi"
    )
    # a repeated row of the smallest id has the same set and is dropped with it
    first = first.dropDuplicates(["doc_id", "high", "low", "n"]).select("doc_id", "n", "odd", "whole", "bands").checkpoint()
    look = first.select("doc_id", "n", "odd", "whole")

    keyed = first.select("doc_id", F.explode("bands").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("doc_id").alias("hub"), F.count("*").alias("m")).filter("m > 1").drop("m")
    members = keyed.join(hubs, "key").checkpoint()

    pairs = members.filter("doc_id <> hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    pairs = pairs.join(look.withColumnRenamed("doc_id", "a"), "a").join(
        look.select(F.col("doc_id").alias("b"), F.col("n").alias("n2"), F.col("odd").alias("odd2"), F.col("whole").alias("whole2")), "b"
    )
    pairs = pairs.filter(_alike(settings)).select("a", "b").checkpoint()
    links = _confirm(docs, pairs, settings).checkpoint()
    parts = components(links)

    for closest in (True, False):
        more = _across(members, look, parts, settings, closest).distinct().checkpoint()
        more = _confirm(docs, more, settings).checkpoint()
        stars = parts.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        parts = components(stars.union(more))

    own = table.select("doc_id", F.col("n").alias("n_shingles"), "high", "low").join(
        classes.withColumnRenamed("n", "n_shingles"), ["high", "low", "n_shingles"], "left"
    )
    own = own.join(parts.withColumnRenamed("node", "class"), "class", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class", "doc_id"))
    return own.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of `docs`, all columns as they are, of one document of each group: that of the
    smallest id. Repeated rows of an id stay or go together: they go if the text of one of them is a
    copy. Rows without an id stay."""
    name = chars.free_name(docs, "_copy")
    copies = groups(docs, settings).filter("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(copies, F.col("doc_id").cast("long") == F.col(name), "left_anti")
