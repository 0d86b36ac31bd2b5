"""Ranked search against brute force."""

import collections
import math
import random
import re

import pytest

from ratecal.llm import search

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def slow(docs, items, top):
    bags = [(i, t) for i, t in ((i, terms(t)) for i, t in docs) if t]
    n, total = len(bags), sum(len(t) for _, t in bags)
    df = collections.Counter(x for _, t in bags for x in set(t))
    wanted = collections.defaultdict(set)
    for i, text in items:
        wanted[i] |= set(terms(text))
    out = set()
    for item, own in wanted.items():
        found = []
        for i, t in bags:
            m, tf = 100 - 50 + (50 * len(t) * n) // total, collections.Counter(t)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((10**9 * tf[x]) // (1000 * tf[x] + 20 * m)) for x in own if tf[x]
            )
            if score > 0:
                found.append((-score, i is None, i))
        for rank, (score, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1):
            out.add((item, rank, i, -score))
    return out


def corpus(n, seed=5):
    random.seed(seed)
    words = [f"w{k}" for k in range(400)] + ["Éa", "straße", "日本", "x1"]
    common = ["the", "of", "in", "on"]
    docs = []
    for i in range(n):
        size = random.choice([1, 3, 10, 40, 120])
        docs.append((i * 3, " ".join(random.choice(common if random.random() < 0.5 else words) for _ in range(size))))
    docs += [(1, docs[4][1]), (1, docs[4][1]), (2, docs[4][1].upper()), (None, docs[4][1]), (5, None), (7, ""), (8, " .,;-_~\x7f "), (9, "the " * 5000)]
    items = [(k, " ".join(random.sample(words, 6) + random.sample(common, 2))) for k in range(12)]
    items += [(3, "w1 w2"), (None, "the w3"), (None, "w9"), (50, None), (51, "unseen"), (52, docs[4][1]), (53, "The THE the")]
    return docs, items


@pytest.mark.parametrize("settings", [search.Settings(), search.Settings(top=7, postings=300, width=8, short=2, block=20), search.Settings(top=3, postings=1000, width=16, short=100)])
def test_ranks_as_brute_force(spark, settings):
    docs, items = corpus(600)
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, score string").repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    got = search.ranked(frame, asked, settings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    rows = [tuple(r) for r in got.collect()]
    expected = slow(docs, items, settings.top)
    assert set(rows) == expected and len(rows) == len(expected)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search.ranked(docs.limit(0), items).collect() == []
    assert search.ranked(docs, items.limit(0)).collect() == []
    assert search.ranked(docs.filter("doc_id = 2"), items).collect() == []
    assert [tuple(r)[:3] for r in search.ranked(docs, items).collect()] == [(1, 1, 1)]
