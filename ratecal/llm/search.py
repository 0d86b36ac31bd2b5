"""Ranked lexical search: the best documents for each query text, by hybrid TAAT-DAAT.

Documents are indexed in shards: a row holds the posting lists of some thousand documents, so no list is
ever shuffled and a shard is searched by itself. In a shard, a query's short lists are summed term by
term into accumulators. These then count as one more iterator with a bound of its own, next to the
long lists, which are read document by document: ranges whose bounds cannot reach the least score of the
best so far are skipped, and lists that cannot lift a new document there are only looked up.

A term's score in a document is w * ((10**9 * tf) div (1000 * tf + 20 * m)), with w from the number of
documents that hold it and m from the document's length; all sums are 64-bit integers.
"""

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecal.llm import bits, chars
from ratecal.session import new_folder


@dataclass(frozen=True)
class Settings:
    """`top`: documents for each item; `postings`: entries of a shard's lists, about; `width`: documents of
    a range with bounds of its own; `short`: a list is short with fewer than a `short`-th of the shard's
    documents; `block`: terms of the items that are searched for at a time (whole items)."""

    top: int = 50
    postings: int = 1 << 20
    width: int = 512
    short: int = 8
    block: int = 1 << 18


def _is_term(points):
    """Digits, ASCII letters, and all that is not ASCII."""
    return (points >= 128) | ((points >= 48) & (points <= 57)) | ((points >= 65) & (points <= 90)) | ((points >= 97) & (points <= 122))


def _terms(texts):
    """Hash of each term (A-Z lower-cased) and the text that it is from."""
    codes = chars.Codes(texts)
    start, end = chars.runs(_is_term(codes.points))
    return chars.segment_hashes(chars.ascii_lower(codes.points), start, end), codes.owner(start)


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and term (a hash) of all distinct terms of each item; rows of one id count as one item."""

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chars.chunks(texts):
                hashes, owner = _terms(texts[a:b])
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(owner + a)), pa.array(hashes.view(np.int64))], names=["item_id", "term"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return rows.mapInArrow(run, "item_id long, term long").distinct()


def index(docs: DataFrame, terms: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Shards of `docs`: `ids` and lengths `n` (all terms, with repeats) of the documents with a term, and,
    for the terms in the only column of `terms` (others may be among them, by chance), `terms`, `df`
    (entries of each list), and the lists one after another as `docs` (numbers in the shard) and `tf`."""
    shared = docs.sparkSession.sparkContext.broadcast(bits.bitmap(terms))

    def row(parts):
        ids = pa.chunked_array([p[0] for p in parts], type=pa.int64()).combine_chunks()
        n, hashes, where, tf = (np.concatenate([p[k] for p in parts]) for k in range(1, 5))
        order = np.argsort(hashes, kind="stable")  # documents of a term stay in order
        found, df = np.unique(hashes, return_counts=True)
        columns = [n.astype(np.int32), found, df.astype(np.int32), where[order].astype(np.int32), tf[order].astype(np.int32)]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], type=pa.int32()), pa.array(c)) for c in (ids, *columns)]
        return pa.RecordBatch.from_arrays(lists, names=["ids", "n", "terms", "df", "docs", "tf"])

    def run(batches):
        words, parts, size, filled = shared.value, [], 0, 0
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chars.chunks(texts):
                hashes, owner = _terms(texts[a:b])
                n = np.bincount(owner, minlength=b - a)
                held = np.flatnonzero(n)
                keep = bits.member(words, hashes)
                distinct, which = np.unique(hashes[keep].view(np.int64), return_inverse=True)
                pairs, tf = np.unique((which.astype(np.int64) << 32) | owner[keep], return_counts=True)
                place = np.cumsum(n > 0) - 1 + filled
                parts.append((batch.column(0).slice(a, b - a).take(pa.array(held)), n[held], distinct[pairs >> 32], place[pairs & 0xFFFFFFFF], tf))
                size, filled = size + len(tf), filled + len(held)
                if size + filled >= settings.postings:
                    yield row(parts)
                    parts, size, filled = [], 0, 0
        if filled:
            yield row(parts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "ids array<long>, n array<int>, terms array<long>, df array<int>, docs array<int>, tf array<int>"
    return rows.mapInArrow(run, schema)


def weights(wanted: DataFrame, shards: DataFrame) -> tuple[DataFrame, int, int]:
    """item_id, term, w of the items' terms that some document holds, the number of documents with a
    term, and all terms of these."""
    docs, total = shards.agg(F.sum(F.size("ids").cast("long")), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda s, x: s + x))).first()
    pair = F.explode(F.arrays_zip("terms", "df")).alias("p")
    counted = shards.select(pair).groupBy(F.col("p.terms").alias("term")).agg(F.sum(F.col("p.df").cast("long")).alias("df"))
    w = F.floor(1000 * F.log(F.lit(2.0 * (docs or 0) + 2) / (2 * F.col("df").cast("double") + 1))).cast("long")
    return wanted.join(counted, "term").select("item_id", "term", w.alias("w")), docs or 0, total or 0


class Best:
    """The best documents of one item so far: highest score, then smallest id, those without id last."""

    def __init__(self, top):
        self.top, self.least = top, 1  # scores below `least` cannot enter
        self.score, self.id, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score, ids, null):
        score, ids, null = (np.concatenate(x) for x in ((self.score, score), (self.id, ids), (self.null, null)))
        if len(score) > self.top:
            cut = np.partition(score, len(score) - self.top)[len(score) - self.top]
            held = np.flatnonzero(score >= cut)
            held = held[np.lexsort((ids[held], null[held], -score[held]))[: self.top]]
            score, ids, null, self.least = score[held], ids[held], null[held], max(1, int(cut))
        elif len(score) == self.top:
            self.least = max(1, int(score.min()))
        self.score, self.id, self.null = score, ids, null


class Shard:
    def __init__(self, columns, docs, total, settings):
        ids, n, self.terms, df, self.docs, tf = columns
        self.null = np.asarray(ids.is_null())
        self.ids = ids.fill_null(0).to_numpy()
        self.size, self.width = len(self.ids), settings.width
        self.short = -(-self.size // settings.short)
        self.cuts = np.concatenate([[0], np.cumsum(df, dtype=np.int64)])
        m = 100 - 50 + (50 * n.astype(np.int64) * docs) // total
        tf = tf.astype(np.int64)
        self.impact = (10**9 * tf) // (1000 * tf + 20 * m[self.docs])
        self.edges = np.arange(0, self.size + self.width, self.width)
        self.known = {}

    def _bounds(self, docs, values):
        """Where each range starts in a list, and its largest value there."""
        at = np.searchsorted(docs, self.edges)
        most = np.zeros(len(self.edges) - 1, dtype=np.int64)
        full = np.flatnonzero(np.diff(at))
        if len(full):
            most[full] = np.maximum.reduceat(values, at[full])
        return at, most

    def _list(self, t):
        if t not in self.known:
            part = slice(self.cuts[t], self.cuts[t + 1])
            self.known[t] = (self.docs[part], self.impact[part], *self._bounds(self.docs[part], self.impact[part]))
        return self.known[t]

    def search(self, terms, w, best):
        """Adds this shard's documents to `best`; `terms` are places in the shard's terms."""
        lengths = self.cuts[terms + 1] - self.cuts[terms]
        short = lengths < self.short
        lists = []
        if short.any():  # term at a time
            sums = np.zeros(self.size, dtype=np.int64)
            for t, x in zip(terms[short].tolist(), w[short].tolist()):
                part = slice(self.cuts[t], self.cuts[t + 1])
                sums[self.docs[part]] += x * self.impact[part]
            held = np.flatnonzero(sums)
            lists.append((held, sums[held], 1, *self._bounds(held, sums[held])))
        for t, x in zip(terms[~short].tolist(), w[~short].tolist()):
            docs, values, at, most = self._list(t)
            lists.append((docs, values, x, at, most))
        bounds = np.array([x * most for _, _, x, _, most in lists])
        whole = bounds.sum(axis=0)
        for r in range(len(self.edges) - 1):  # document at a time, a range together
            if whole[r] >= best.least:
                self._range(r, lists, bounds[:, r], best)

    def _range(self, r, lists, bounds, best):
        base = self.edges[r]
        part = np.zeros(min(self.width, self.size - base), dtype=np.int64)
        order = np.argsort(bounds, kind="stable")
        reach = np.cumsum(bounds[order])  # what a list and all of lower bound can give
        alone = int(np.searchsorted(reach, best.least))  # a document must be in a list from here on
        for k in order[alone:]:
            docs, values, x, at, _ = lists[k]
            part[docs[at[r] : at[r + 1]] - base] += x * values[at[r] : at[r + 1]]
        alive = np.flatnonzero(part)
        for k in reversed(range(alone)):
            alive = alive[part[alive] + reach[k] >= best.least]
            if not len(alive):
                return
            docs, values, x, at, _ = lists[order[k]]
            docs, values = docs[at[r] : at[r + 1]], values[at[r] : at[r + 1]]
            if len(docs):
                spot = np.minimum(np.searchsorted(docs, alive + base), len(docs) - 1)
                part[alive] += np.where(docs[spot] == alive + base, x * values[spot], 0)
        alive = alive[part[alive] >= best.least]
        if len(alive):
            best.add(part[alive], self.ids[alive + base], self.null[alive + base])


def _search(shards, queries, docs, total, settings):
    """item_id, doc_id, score: the best documents of each item among those of a task."""
    queries = queries.sort_by([("item_id", "ascending")])
    null = np.asarray(queries["item_id"].combine_chunks().is_null())
    items = queries["item_id"].combine_chunks().fill_null(0).to_numpy()
    first = np.flatnonzero(np.concatenate([[True], (np.diff(items) != 0) | (np.diff(null.view(np.int8)) != 0)])[: len(items)])
    names = queries["item_id"].combine_chunks().take(pa.array(first))
    cuts, terms, w = np.append(first, len(items)), queries["term"].to_numpy(), queries["w"].to_numpy()
    shared = shards.sparkSession.sparkContext.broadcast((names, cuts, terms, w))

    def run(batches):
        names, cuts, terms, w = shared.value
        found = [Best(settings.top) for _ in range(len(names))]
        distinct, which = np.unique(terms, return_inverse=True)
        for batch in batches:
            for i in range(batch.num_rows):
                row = [c[i].values for c in batch.columns]
                shard = Shard([row[0], *[c.to_numpy() for c in row[1:]]], docs, total, settings)
                at = np.minimum(np.searchsorted(shard.terms, distinct), len(shard.terms) - 1)
                place = np.where(shard.terms[at] == distinct, at, -1)[which] if len(shard.terms) else np.full(len(terms), -1)
                for k, best in enumerate(found):
                    own = place[cuts[k] : cuts[k + 1]]
                    held = own >= 0
                    if held.any():
                        shard.search(own[held], w[cuts[k] : cuts[k + 1]][held], best)
        for k, best in enumerate(found):
            if len(best.score):
                ids = pa.array(best.id, mask=best.null)
                yield pa.RecordBatch.from_arrays([names.take(pa.array(np.full(len(ids), k))), ids, pa.array(best.score)], names=["item_id", "doc_id", "score"])

    return shards.mapInArrow(run, "item_id long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """item_id, rank, doc_id, score: for each item the `top` documents with a score above 0, highest first,
    equal scores by ascending doc_id.

    Every row of `docs` counts as a document and is ranked as one, also a repeated one; rows without an
    id come last among equal scores. Rows of `items` with one id (NULL as well) are one item with the terms of all
    of them. An empty or NULL text has no terms. Items are searched for in blocks of whole items, so what is
    broadcast does not grow with their number; a task keeps `top` documents an item.
    """
    spark = docs.sparkSession
    wanted = item_terms(items).checkpoint()
    where, out = new_folder(spark), new_folder(spark)
    index(docs, wanted.select("term"), settings).write.parquet(where)
    shards = spark.read.parquet(where)
    queries, n, total = weights(wanted, shards)
    queries = queries.checkpoint()
    blocks = max(1, math.ceil(queries.count() / settings.block))
    schema = "item_id long, doc_id long, score long"
    spark.createDataFrame([], schema).write.parquet(out)
    for block in range(blocks):
        own = queries.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toArrow()
        if own.num_rows:
            _search(shards, own, n, total, settings).write.mode("append").parquet(out)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = spark.read.schema(schema).parquet(out).withColumn("rank", F.row_number().over(best))
    return found.filter(F.col("rank") <= settings.top).select("item_id", "rank", "doc_id", "score")
