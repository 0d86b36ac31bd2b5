"""Toxicity by a factorization machine over hashed terms.

A term is a lower-cased run of letters, hashed to 2**24 numbers; a document's input is 1 for each
term it holds. The machine adds to the linear weights the products of learned vectors of every
pair of terms, so that two terms together may weigh more than both alone. Terms enter it that depend on the
label, by themselves or in a pair.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecal.llm import chars, folds

BITS = 24


@dataclass(frozen=True)
class Settings:
    """`per_class`: documents of each label used for training, at most; `terms`: terms of the model that depend
    on the label by themselves, at most; `pairs`: pairs of terms that do, at most; `least`: documents that must hold a term;
    `single`, `pair`: least chi square of a term and of a pair (of some ten million pairs, hardly any reaches it by chance);
    `paired`: documents of each label in which pairs are counted, at most; `often`: least share of them with a term and
    with both of a pair."""

    per_class: int = 5000
    terms: int = 4096
    pairs: int = 1024
    least: int = 3
    single: float = 10.8
    pair: float = 60.0
    paired: int = 1500
    often: float = 0.02
    dims: int = 6
    epochs: int = 30
    rate: float = 0.1
    decay: float = 1e-4
    seed: int = 11


@dataclass(frozen=True)
class Model:
    """Sorted hashes of its terms, their weights and vectors, and the constant."""

    keys: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray
    bias: float


def _terms(texts):
    """Hash of each term and the text that it is from."""
    letter, lower = chars.letter_table()
    codes = chars.Codes(texts)
    start, end = chars.runs(letter[codes.points])
    hashes = chars.segment_hashes(lower[codes.points], start, end) >> np.uint64(64 - BITS)
    return hashes.astype(np.int64), codes.owner(start)


def _chi(a, b, n1, n0):
    """Chi square of label and presence: in `a` of n1 documents of label 1 and `b` of n0 of label 0."""
    c, d = n1 - a, n0 - b
    return (a * d - b * c) ** 2 * (n1 + n0) / (np.maximum(a + b, 1) * np.maximum(c + d, 1) * n1 * n0)


def _counted(terms, doc, y):
    """The distinct terms of the documents, and in how many of label 1 and 0 each is."""
    keys, which = np.unique(terms, return_inverse=True)
    ones = y[doc] == 1
    return keys, which, np.bincount(which[ones], minlength=len(keys)).astype(float), np.bincount(which[~ones], minlength=len(keys)).astype(float)


def single(terms, doc, y, settings):
    """The terms that depend most on the label by themselves."""
    keys, _, a, b = _counted(terms, doc, y)
    chi = np.where(a + b >= settings.least, _chi(a, b, (y == 1).sum(), (y == 0).sum()), 0)
    best = np.lexsort((keys, -chi))[: settings.terms]
    return keys[best[chi[best] > settings.single]]


def together(terms, doc, y, settings):
    """The terms of the pairs that depend on the label, and much more than each of both: such a term may be neutral
    alone. Pairs of all terms that enough documents hold are counted, by products of blocks of the matrix of documents
    and terms, so memory is bounded by the documents and the size of a block."""
    held = np.flatnonzero(np.bincount(doc, minlength=len(y)))
    chosen = np.concatenate([held[y[held] == k][: settings.paired] for k in (1, 0)])  # in the order of a hash
    place = np.full(len(y), -1)
    place[chosen] = np.arange(len(chosen))
    own = place[doc] >= 0
    terms, doc, y = terms[own], place[doc[own]], y[chosen]
    keys, which, a, b = _counted(terms, doc, y)
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    if not n1 or not n0:
        return keys[:0]
    least = max(settings.least, settings.often * min(n1, n0))
    often = np.flatnonzero(a + b >= least)
    at = np.full(len(keys), -1)
    at[often] = np.arange(len(often))
    keep = at[which] >= 0
    column, row = at[which[keep]], doc[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    chi = _chi(a[often], b[often], n1, n0)

    def block(start, stop):
        part = slice(*np.searchsorted(column, [start, stop]))
        out = np.zeros((len(y), stop - start), dtype=np.float32)
        out[row[part], column[part] - start] = 1
        return out

    best, width = [np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)], 512
    for i in range(0, len(often), width):
        left = block(i, min(i + width, len(often)))
        for j in range(i, len(often), width):
            right = left if i == j else block(j, min(j + width, len(often)))
            both1, both0 = ((left[y == k].T @ right[y == k]).astype(float) for k in (1, 0))
            pair = np.where(both1 + both0 >= least, _chi(both1, both0, n1, n0), 0)
            more = pair - np.maximum(chi[i : i + left.shape[1], None], chi[j : j + right.shape[1]])
            x, z = np.nonzero((pair > settings.pair) & (more > settings.pair / 2))
            x, z = x[x + i < z + j], z[x + i < z + j]
            best = [np.concatenate(both) for both in zip(best, (pair[x, z], x + i, z + j))]
            first = np.lexsort((best[2], best[1], -best[0]))[: settings.pairs]
            best = [part[first] for part in best]
    return keys[often[np.unique(np.concatenate(best[1:]))]]


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", settings: Settings = Settings()) -> Model:
    """Learns from a bounded sample of labelled rows, of which the distinct terms come to the driver. The model has the terms
    that depend on the label alone or in a pair. Without two classes it has none."""
    texts, weights = folds.labelled_sample(docs, labels, column, settings.per_class)

    def run(batches):
        for batch in batches:
            for start, stop, rows in chars.parts(batch.column(0)):
                key, owner = _terms(rows)
                pairs = np.unique((owner << BITS) | key)
                cuts = np.searchsorted(pairs, np.arange(len(rows) + 1) << BITS).astype(np.int32)
                terms = pa.ListArray.from_arrays(pa.array(cuts), pa.array((pairs & ((1 << BITS) - 1)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([terms, batch.column(1).slice(start, stop - start)], names=["terms", "y"])
        chars.release()

    if len(weights) < 2:
        return Model(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, settings.dims)), 0.0)
    rows = texts.mapInArrow(run, "terms array<int>, y int").toArrow().combine_chunks()
    lists, y = rows["terms"].combine_chunks(), rows["y"].to_numpy()
    cuts, terms = lists.offsets.to_numpy(), lists.values.to_numpy()
    # rows come in any order; by what they hold, it is always the same
    sums = np.concatenate([[0], np.cumsum(chars.mix(terms.astype(np.uint64)))]).astype(np.uint64)
    sums = sums[cuts[1:]] - sums[cuts[:-1]]
    order = np.lexsort((y, sums))
    sizes = np.diff(cuts)[order]
    first = np.diff(sums[order], prepend=sums[order][:1] + np.uint64(1)) != 0  # of documents with the same terms
    terms = np.concatenate([terms[cuts[i] : cuts[i + 1]] for i in order]) if len(order) else terms
    doc, y = np.repeat(np.arange(len(order)), sizes), y[order]
    if not (y == 1).any() or not (y == 0).any():
        return Model(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, settings.dims)), 0.0)
    keys = np.union1d(single(terms, doc, y, settings), together(terms[first[doc]], doc[first[doc]], y, settings)).astype(np.int64)
    at = np.minimum(np.searchsorted(keys, terms), max(len(keys) - 1, 0))
    keep = keys[at] == terms if len(keys) else np.zeros(len(terms), dtype=bool)
    ends = np.searchsorted(doc[keep], np.arange(len(y) + 1))
    own = at[keep]
    bags = [own[i:j] for i, j in zip(ends[:-1], ends[1:])]
    return descend(keys, bags, y, weights, settings)


def descend(keys, bags, ys, weights, settings) -> Model:
    """AdaGrad on the logistic loss, one document a step; `bags` are the places of its terms in `keys`."""
    random = np.random.default_rng(settings.seed)
    w, v, bias = np.zeros(len(keys)), random.normal(0, 0.02, (len(keys), settings.dims)), 0.0
    gw, gv, gb = np.full(len(keys), 1e-2), np.full((len(keys), settings.dims), 1e-2), 1e-2
    scale = sum(weights[y] for y in ys) / max(len(bags), 1)
    for _ in range(settings.epochs):
        for i in random.permutation(len(bags)):
            f, y = bags[i], ys[i]
            vf = v[f]
            total = vf.sum(0)
            raw = bias + w[f].sum() + 0.5 * (total @ total - (vf * vf).sum())
            g = (1 / (1 + np.exp(-raw)) - y) * weights[y] / scale
            gb += g * g
            bias -= settings.rate * g / np.sqrt(gb)
            dw = g + settings.decay * w[f]
            gw[f] += dw * dw
            w[f] -= settings.rate * dw / np.sqrt(gw[f])
            dv = g * (total - vf) + settings.decay * vf
            gv[f] += dv * dv
            v[f] -= settings.rate * dv / np.sqrt(gv[f])
    return Model(keys, w, v, bias)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """`docs` with the probability of label 1; an empty or NULL text, and one without known terms, has
    that of the constant. The model is bounded by `terms`, so it travels with the tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts):
        model = shared.value
        n = len(texts)
        raw = np.full(n, model.bias)
        key, owner = _terms(texts)
        if len(model.keys) and len(key):
            at = np.minimum(np.searchsorted(model.keys, key), len(model.keys) - 1)
            hit = model.keys[at] == key
            pairs = np.unique(owner[hit] * len(model.keys) + at[hit])
            owner, at = pairs // len(model.keys), pairs % len(model.keys)
            raw += np.bincount(owner, weights=model.weights[at], minlength=n)
            for k in range(model.vectors.shape[1]):
                x = model.vectors[at, k]
                raw += 0.5 * (np.bincount(owner, weights=x, minlength=n) ** 2 - np.bincount(owner, weights=x * x, minlength=n))
        return [1 / (1 + np.exp(-np.clip(raw, -500, 500)))]

    return chars.add_columns(docs, "text", [T.StructField(name, T.DoubleType())], run)


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of `docs`; repeated rows stay repeated."""
    rows = docs.select("doc_id", "text")
    return score(rows, fit(docs, labels, "toxic", settings)).select(
        "doc_id",
        folds.held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, settings: Settings = Settings()) -> DataFrame:
    """The rows of `docs`, all columns as they are, whose text is not toxic; all of them where labels teach nothing, as
    without documents of both labels or terms that tell them apart."""
    model = fit(docs, labels, "toxic", settings)
    if not len(model.keys):
        return docs
    name = chars.free_name(docs, "_toxic")
    kept = score(docs, model, name).filter(F.col(name) < threshold)
    return kept.select(*[f"`{c}`" for c in docs.columns])
