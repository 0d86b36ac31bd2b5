"""Language of a text by rank-order n-gram profiles.

A profile lists the most frequent character n-grams (n = 1 to 4, lower case, words padded with
one blank) by rank. A document's profile is compared with each language's by the sum of
out-of-place distances; an n-gram that the language's profile lacks counts as far out of
place as can be.
"""

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecal.llm import chars, folds

GRAMS = (1, 2, 3, 4)


@dataclass(frozen=True)
class Settings:
    """`size`: n-grams of a profile; `per_language`: documents that a language's profile is learned
    from, about (a share by hash of the id); `near`: share of the usual score of the language's own texts of about the
    same length that a text must have to count as one of the language."""

    size: int = 300
    per_language: int = 3000
    near: float = 0.5


@dataclass(frozen=True)
class Profiles:
    """Languages in alphabetical order, the sorted n-grams of all profiles, and the rank of each
    in each language (`size` where the language lacks it). `usual`: the median score of each language's
    own texts, by the power of two of their number of distinct n-grams."""

    languages: tuple
    keys: np.ndarray
    ranks: np.ndarray
    size: int
    usual: np.ndarray = None


def _counts(texts):
    """For each text its distinct n-grams, sorted by hash, and their counts."""
    letter, lower = chars.letter_table()
    codes = chars.Codes(texts)
    is_letter = letter[codes.points]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first of each run of other characters stands for all of them
    at = np.flatnonzero(keep)
    is_letter = is_letter[at]
    points = np.concatenate([[np.uint32(32)], np.where(is_letter, lower[codes.points[at]], np.uint32(32))])
    is_letter = np.concatenate([[False], is_letter])
    last_at = np.concatenate([[0], codes.ends])
    parts = []
    for n in GRAMS:
        grams = chars.gram_hashes(points, n)
        whole = np.ones(len(grams), dtype=bool)
        for k in range(n) if n == 1 else range(1, n - 1):
            whole &= is_letter[k : k + len(grams)]
        if n == 2:
            whole &= is_letter[:-1] | is_letter[1:]
        start = np.flatnonzero(whole)
        place = np.concatenate([[-1], at])[start + n - 1]  # of its last character; a leading blank may be the text's before
        parts.append((grams[start], np.searchsorted(place, last_at)))
    for i in range(codes.n):
        grams = np.sort(np.concatenate([g[cuts[i] : cuts[i + 1]] for g, cuts in parts]))
        first = np.flatnonzero(np.diff(grams, prepend=~grams[:1]))
        yield grams[first], np.diff(first, append=len(grams))


def _top(grams, counts, size):
    """The `size` most frequent, by rank; ties by hash."""
    order = (counts.astype(np.uint64) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - grams.astype(np.uint64))
    if len(order) > size:
        order = np.partition(order, len(order) - size)[-size:]
    order = np.sort(order)[::-1]
    return (np.uint64(0xFFFFFFFF) - (order & np.uint64(0xFFFFFFFF))).astype(np.uint32)


SHORT = 1 << 18  # characters at a time: each takes some hundred bytes


def _sample(docs, settings):
    """text and lang of a share of each language's documents that are not held out."""
    known = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (folds.remainder() != 2)
    )
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    sizes = known.groupBy("lang").agg((F.lit(1_000_000.0 * settings.per_language) / F.count("*")).alias("_upto"))
    # one row a language, of which the profiles' n-grams come to the driver anyway; the texts stay where they are
    return known.join(F.broadcast(sizes), "lang").filter(spot < F.col("_upto")).select("text", "lang")


def fit(docs: DataFrame, settings: Settings = Settings()) -> Profiles:
    """Profiles of all languages, counted over a share of each language's documents that are not
    held out. At most `size` rows a language come to the driver. Without any there are no profiles."""
    sample = _sample(docs, settings)

    def run(batches):
        for batch in batches:
            every = np.array(batch.column(1).to_pylist(), dtype=object)
            for a, b, texts in chars.parts(batch.column(0), SHORT):
                bags, langs = list(_counts(texts)), every[a:b]
                for lang in set(langs):
                    own = [bag for bag, x in zip(bags, langs) if x == lang]
                    grams, where = np.unique(np.concatenate([g for g, _ in own]), return_inverse=True)
                    n = np.bincount(where, weights=np.concatenate([c for _, c in own]), minlength=len(grams))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams), type=pa.string()), pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))],
                        names=["lang", "gram", "n"],
                    )
        chars.release()

    counted = sample.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counted.withColumn("rank", rank).filter(F.col("rank") <= settings.size).select("lang", "gram", "rank").toPandas()
    if not len(top):
        return Profiles((), np.zeros(0, np.uint32), np.zeros((0, 0), np.int32), settings.size, np.zeros((0, BINS)))
    languages = tuple(sorted(top["lang"].unique()))
    keys = np.unique(top["gram"].to_numpy()).astype(np.uint32)
    ranks = np.full((len(languages), len(keys)), settings.size, dtype=np.int32)
    for k, lang in enumerate(languages):
        own = top[top["lang"] == lang]
        ranks[k, np.searchsorted(keys, own["gram"].to_numpy().astype(np.uint32))] = own["rank"].to_numpy() - 1
    profiles = Profiles(languages, keys, ranks, settings.size, np.zeros((len(languages), BINS)))
    return replace(profiles, usual=_usual(sample, profiles))


BINS = 24


def _usual(sample, profiles):
    """The median score of the sample's texts in their own language, for each number of bits of their number of n-grams; where
    there are none, that of the nearest number, of shorter texts first."""
    shared = sample.sparkSession.sparkContext.broadcast(profiles)

    def run(texts):
        found = [_nearest(grams, counts, shared.value) for grams, counts in _counts(texts)]
        return [[lang for lang, _, _ in found], [x for _, x, _ in found], [n for _, _, n in found]]

    fields = [T.StructField("_found", T.StringType()), T.StructField("_score", T.DoubleType()), T.StructField("_bits", T.IntegerType())]
    scores = chars.add_columns(sample, "text", fields, run, SHORT).filter(F.col("_found") == F.col("lang"))
    out = np.full((len(profiles.languages), BINS), np.nan)
    for r in scores.groupBy("lang", "_bits").agg(F.percentile_approx("_score", 0.5, F.lit(1000)).alias("usual")).collect():
        out[profiles.languages.index(r["lang"]), r["_bits"]] = r["usual"]
    for row in out:
        known = np.flatnonzero(~np.isnan(row))
        for k in np.flatnonzero(np.isnan(row)):
            row[k] = row[known[np.abs(known - k).argmin()]] if len(known) else 0.0
    return out


def _nearest(grams, counts, p):
    """(language, score, bits of the number of distinct n-grams) of one text; `und` without letters or profiles."""
    if not len(grams) or not p.languages:
        return "und", 0.0, 0
    top = _top(grams, counts, p.size)
    at = np.minimum(np.searchsorted(p.keys, top), len(p.keys) - 1)
    theirs = np.where(p.keys[at] == top, p.ranks[:, at], p.size)
    out = np.abs(theirs - np.arange(len(top)))
    out[theirs == p.size] = p.size
    distance = out.sum(axis=1)
    best = int(distance.argmin())
    return p.languages[best], 1 - distance[best] / (p.size * len(top)), min(len(grams).bit_length(), BINS - 1)


def predict(docs: DataFrame, profiles: Profiles, lang: str = "lang_pred", score: str = "score", near=None) -> DataFrame:
    """`docs` with the language of the nearest profile (ties: the first by alphabet) and 1 minus its
    distance as a share of the largest possible one. A text without a letter, a NULL one, or any
    text when nothing was learned is `und` with score 0. With `near`, a text that has less than this share of the language's
    usual score is `und` as well. Profiles hold `size` n-grams a language."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(texts):
        p = shared.value
        found = [_nearest(grams, counts, p) for grams, counts in _counts(texts)]
        if near is not None:
            place = {x: k for k, x in enumerate(p.languages)}
            found = [(x if x in place and s >= near * p.usual[place[x], n] else "und", s, n) for x, s, n in found]
        return [[x for x, _, _ in found], [s for _, s, _ in found]]

    fields = [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]
    return chars.add_columns(docs, "text", fields, run, SHORT)


def predicted(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of `docs`; repeated rows stay repeated."""
    return predict(docs.select("doc_id", "text"), fit(docs, settings)).select(
        "doc_id", folds.held_out().alias("held_out"), "lang_pred", "score"
    )


def accepted(docs: DataFrame, languages=None, settings: Settings = Settings()) -> DataFrame:
    """The rows of `docs`, all columns as they are, whose text is in a language that was learned (one of `languages`, if
    they are given): its distance to the nearest profile is not much larger than that of the language's own texts. If
    nothing can be learned, as without any `lang`, nothing can be far either: all texts with a letter stay."""
    profiles = fit(docs, settings)
    if not profiles.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    lang, score = chars.free_name(docs, "_lang"), chars.free_name(docs, "_score")
    found = predict(docs, profiles, lang, score, settings.near).filter(F.col(lang) != "und")
    if languages is not None:
        found = found.filter(F.col(lang).isin(list(languages)))
    return found.select(*[f"`{c}`" for c in docs.columns])
