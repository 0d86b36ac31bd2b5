"""Collocations against brute force."""

import collections
import random
import re
from pathlib import Path

import numpy as np
import pytest

from ratecal.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow(rows, least, longest, top, percent):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, count in f.items():
        often = {g: c for g, c in count.items() if c >= least and len(g) > 1}
        longer = collections.Counter()
        for g, c in often.items():
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    longer[g[i : i + m]] = max(longer[g[i : i + m]], c)
        rows = []
        for g, a in often.items():
            if not longer[g] or 100 * longer[g] < percent * a:
                score, k = min((1000 * a * n[lang] // (count[g[:k]] * count[g[k:]]), k) for k in range(1, len(g)))
                rows.append((-score, -a, " ".join(g).encode(), count[g[:k]], count[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def corpus(n):
    random.seed(9)
    fixed = ["new york city hall", "as soon as possible", "the the the the the the", "in vivo", "ÀB cd Ef", "x\ty  z", "日本 語 文"]
    words = [f"w{i}" for i in range(60)]
    rows = []
    for _ in range(n):
        text = " ".join(random.choice(fixed) if random.random() < 0.2 else random.choice(words) for _ in range(random.choice([0, 1, 5, 60])))
        text = re.sub(" ", lambda _: random.choice([" "] * 12 + [". ", ", ", "\n", "!", "; ", "  "]), text)
        rows.append((random.choice(["en", "de", "und", None]), text.upper() if random.random() < 0.1 else text))
    return rows + [("en", None), (None, ""), ("fr", " .,;\t"), ("en", "new york " * 3000), ("en", rows[0][1])] + [("it", "a b c a b c")] * 30


@pytest.mark.parametrize("settings", [
    phrases.Settings(least=20), phrases.Settings(least=8, block=40, gathered=500, top=9), phrases.Settings(least=5, longest=3, percent=80, buckets=64, block=100),
])
def test_as_brute_force(spark, settings):
    rows = corpus(400)
    frame = spark.createDataFrame([(lang, text, 1) for lang, text in rows], "lang string, text string, score long").repartition(4)
    got = phrases.mined(frame, settings)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = [tuple(r) for r in got.collect()]
    assert set(found) == slow(rows, settings.least, settings.longest, settings.top, settings.percent) and len(found) == len(set(found))


def test_nothing_frequent(spark):
    frame = spark.createDataFrame([("en", "a b c"), (None, None)], "lang string, text string")
    assert phrases.mined(frame).collect() == [] and phrases.mined(frame.limit(0)).collect() == []


def test_large_counts_are_exact(spark):
    frame = spark.createDataFrame([("en", "a b " * 40000 + "c")], "lang string, text string")
    rows = {tuple(r) for r in phrases.mined(frame).collect()}
    assert rows == slow([("en", "a b " * 40000 + "c")], 100, 5, 2000, 100) and rows


def test_trie_counts_all_positions():
    random.seed(2)
    for depth, letters, n in ((2, 30, 200), (3, 6, 150), (5, 3, 90), (2, 500, 5000), (4, 40, 2000)):
        alphabet = np.unique(np.random.default_rng(depth).integers(1, 1 << 63, letters, dtype=np.uint64))
        words = np.unique(alphabet[np.random.default_rng(n).integers(0, len(alphabet), (n, depth))], axis=0)
        trie = phrases.Trie(words)
        text = np.concatenate([alphabet[np.random.default_rng(7).integers(0, len(alphabet), 4000)], np.zeros(2, np.uint64), words.ravel()[:900]])
        expected = collections.Counter(tuple(text[i : i + depth]) for i in range(len(text) - depth + 1))
        assert trie.count(text).tolist() == [expected[tuple(w)] for w in words]
        used = trie.check[1:] >= 0
        assert used.sum() == len({tuple(w[: j + 1]) for w in words.tolist() for j in range(depth)})


def test_what_tasks_send_is_small(spark):
    """Rare words are counted without their letters, and candidates of one first word share it."""
    rows = [("en", " ".join(f"{'rare' * 5}{i}x{j}" for j in range(200))) for i in range(50)] + [("en", "often said " * 200), (None, "often")]
    frame = spark.createDataFrame(rows, "lang string, text string")
    counted = phrases.word_counts(frame)
    assert counted.columns == ["code", "f", "lang", "n"] and sorted(r["f"] for r in counted.filter("code IS NOT NULL").collect()) == [200, 200]
    sizes = {r["lang"]: r["n"] for r in counted.filter("code IS NULL").groupBy("lang").agg({"n": "sum"}).toDF("lang", "n").collect()}
    assert sizes == {"en": 10_400, "und": 1}
    random = np.random.default_rng(1)
    first = random.integers(1, 1 << 63, 20, dtype=np.uint64)[random.integers(0, 20, 30_000)]
    second = random.integers(1, 1 << 63, 30_000, dtype=np.uint64)
    part = (first >> np.uint64(57)).astype(np.int64)
    table = phrases._ranged(part, first, second)
    assert sum(len(x) for c in ("c0", "c1") for x in table[c].to_pylist()) < 9 * 30_000
    got = [np.concatenate(phrases._opened(table, c, np.uint64)) for c in ("c0", "c1")]
    assert sorted(zip(*map(np.ndarray.tolist, got))) == sorted(zip(first.tolist(), second.tolist()))


def test_tasks_that_tell_candidates_do_not_grow_with_files(spark, monkeypatch):
    seen, inner = [], phrases.candidates
    monkeypatch.setattr(phrases, "candidates", lambda texts, *a: seen.append(texts.rdd.getNumPartitions()) or inner(texts, *a))
    files = 5 * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        frame = spark.createDataFrame([("en", f"{'a b ' * 300}c{i}") for i in range(files)], "lang string, text string").repartition(files)
        phrases.frequent(frame)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen and max(seen) <= 2 * spark.sparkContext.defaultParallelism


def test_words_told_do_not_grow_with_files(spark, monkeypatch):
    """A task tells each frequent word once, so there are not as many tasks as files."""
    files = 5 * spark.sparkContext.defaultParallelism
    seen, inner = [], phrases._stored
    monkeypatch.setattr(phrases, "_stored", lambda rows: seen.append(inner(rows)) or seen[-1])
    frame = spark.createDataFrame([("en", "a b " * 100) for _ in range(files)], "lang string, text string").repartition(files)
    words, _, _ = phrases.frequent(frame)
    assert {(r["word"], r["f"]) for r in words.collect()} == {("a", 100 * files), ("b", 100 * files)}
    (texts,) = [rows for rows in seen if "codes" in rows.columns]
    assert 2 <= texts.filter("code IS NOT NULL").count() <= 4 * spark.sparkContext.defaultParallelism


def test_rare_phrases_of_frequent_ones_are_no_candidates(spark, monkeypatch):
    """All pairs of 30 words are frequent, hardly any three of them; and of many pairs that occur once few share one of the buckets."""
    tried, inner = collections.Counter(), phrases.Trie.__init__
    monkeypatch.setattr(phrases.Trie, "__init__", lambda self, words: tried.update({words.shape[1]: len(words)}) or inner(self, words))
    letters = np.random.default_rng(3).integers(0, 30, (40, 1000))
    rows = [("en", " ".join(f"w{i}" for i in line)) for line in letters.tolist()]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    settings = phrases.Settings(least=20)
    assert {tuple(r) for r in phrases.mined(frame, settings).collect()} == slow(rows, 20, 5, 2000, 100)
    assert tried[2] == 900 and tried[3] < 100
    tried.clear()
    rows = [("en", " ".join(f"w{i}" for i in line)) for line in np.random.default_rng(4).integers(0, 300, (40, 500)).tolist()]
    frame = spark.createDataFrame(rows + [("en", "often said " * 30)], "lang string, text string").repartition(4)
    _, found, _ = phrases.frequent(frame, phrases.Settings(least=20, buckets=64))
    assert found.filter("size(words) = 2").count() == 2 and tried[2] < 4000


def test_what_was_sent_to_tasks_leaves_the_disk(spark, monkeypatch):
    sent, inner = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(inner(self, value)) or sent[-1])
    phrases.frequent(spark.createDataFrame([("en", "a b c " * 200)], "lang string, text string"))
    assert len(sent) > 3 and not any(Path(s._path).exists() for s in sent)
