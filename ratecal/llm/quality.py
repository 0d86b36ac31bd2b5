"""Quality of a text by supervised subword embeddings.

Every word and every character n-gram of a word is hashed to a learned vector; the vectors
are averaged over the document and a softmax over two classes reads the average. Training is
stochastic gradient descent in numpy on a bounded sample of labelled documents. As the model
is linear after the average, scoring needs one number per hashed feature only: the product of
its vector with the output layer.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecal.llm import chars, folds

GRAMS = (2, 3, 4)


@dataclass(frozen=True)
class Settings:
    """`per_class`: labelled documents of each class used for training, at most, with all their features."""

    buckets: int = 1 << 17
    dims: int = 8
    epochs: int = 10
    rate: float = 0.5
    per_class: int = 2500
    seed: int = 7


def _features(texts, buckets):
    """Hashed features of all words and n-grams, each with the text that it is from; the last
    bucket stands for the end of a text, which every text has once."""
    codes = chars.Codes(texts)
    points, inside = codes.points, ~chars.ascii_space(codes.points)
    start, end = chars.runs(inside)
    word = (chars.segment_hashes(points, start, end) % np.uint64(buckets - 1)).astype(np.int64)
    yield word, codes.owner(start)
    left = np.zeros(len(points), dtype=np.int64)
    at = np.flatnonzero(inside)
    left[at] = np.repeat(end, end - start) - at
    owner = np.repeat(np.arange(codes.n), np.diff(codes.ends, prepend=0))
    for n in GRAMS:
        grams = chars.gram_hashes(points, n)
        fits = np.flatnonzero(left[: len(grams)] >= n)
        yield (grams[fits] % np.uint32(buckets - 1)).astype(np.int64), owner[fits]
    yield np.full(codes.n, buckets - 1), np.arange(codes.n)


def _bags(texts, settings):
    """For each text its distinct features and their shares of all its features."""
    for a, b in chars.chunks(texts):
        parts = list(_features(texts[a:b], settings.buckets))
        keys = np.concatenate([o * settings.buckets + f for f, o in parts])
        keys, counts = np.unique(keys, return_counts=True)
        cuts = np.searchsorted(keys, np.arange(b - a + 1) * settings.buckets)
        for i in range(b - a):
            feature, count = keys[cuts[i] : cuts[i + 1]] - i * settings.buckets, counts[cuts[i] : cuts[i + 1]]
            yield feature.astype(np.int32), (count / count.sum()).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", settings: Settings = Settings()) -> np.ndarray:
    """The learned score of each feature (log odds of label 1 in the average).

    Only the bounded sample's features come to the driver: at most 2 x `per_class` documents of at most
    `buckets` numbers. Without two classes to learn from, all scores are 0.
    """
    texts, weights = folds.labelled_sample(docs, labels, column, settings.per_class)

    def run(batches):
        for batch in batches:
            bags = list(_bags(batch.column(0).to_pylist(), settings))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f for f, _ in bags], type=pa.list_(pa.int32())),
                    pa.array([s for _, s in bags], type=pa.list_(pa.float32())),
                    batch.column(1),
                ],
                names=["feature", "share", "y"],
            )

    rows = texts.mapInArrow(run, "feature array<int>, share array<float>, y int").toArrow().combine_chunks()
    if len(weights) < 2 or rows.num_rows == 0:
        return np.zeros(settings.buckets, dtype=np.float32)
    y = rows["y"].to_numpy()
    feature, share = [rows[k].combine_chunks() for k in ("feature", "share")]
    cuts, feature, share = feature.offsets.to_numpy(), feature.values.to_numpy(), share.values.to_numpy()
    weight = np.array([weights[k] for k in y])
    return descend(cuts, feature, share, y, weight / weight.mean(), settings)


def descend(cuts, feature, share, y, weight, settings) -> np.ndarray:
    """Stochastic gradient descent, one document a step, the rate falling to 0."""
    # the order of rows that come from a cluster is not fixed; that of their contents is
    sums = np.add.reduceat(feature.astype(np.int64) * 2654435761 % 4294967291, cuts[:-1])
    order = np.lexsort((sums, np.diff(cuts)))
    random = np.random.default_rng(settings.seed)
    vectors = random.uniform(-1, 1, (settings.buckets, settings.dims)).astype(np.float32) / settings.dims
    output = np.zeros((2, settings.dims), dtype=np.float32)
    steps, step = settings.epochs * len(y), 0
    for _ in range(settings.epochs):
        for i in random.permutation(order):
            f, s = feature[cuts[i] : cuts[i + 1]], share[cuts[i] : cuts[i + 1]]
            hidden = s @ vectors[f]
            logits = output @ hidden
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y[i]] -= 1
            rate = settings.rate * (1 - step / steps) * min(weight[i], 4.0)
            grad = output.T @ p
            output -= rate * np.outer(p, hidden)
            vectors[f] -= (rate * s)[:, None] * grad
            step += 1
    return vectors @ (output[1] - output[0])


def score(docs: DataFrame, model: np.ndarray, name: str = "score") -> DataFrame:
    """`docs` with the probability of label 1; an empty or NULL text has the score of a text's end
    alone. The model has a fixed size (`buckets` numbers), so it travels with the tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts):
        model = shared.value
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for feature, owner in _features(texts, len(model)):
            total += np.bincount(owner, weights=model[feature], minlength=len(texts))
            count += np.bincount(owner, minlength=len(texts))
        return [1 / (1 + np.exp(-total / count))]

    return chars.add_columns(docs, "text", [T.StructField(name, T.DoubleType())], run)


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of `docs`; repeated rows stay repeated."""
    rows = docs.select("doc_id", "text")
    return score(rows, fit(docs, labels, "quality", settings)).select(
        "doc_id",
        folds.held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
