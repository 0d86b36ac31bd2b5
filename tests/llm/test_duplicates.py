"""Near-duplicates and decontamination against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecal.llm import bits, minhash, queries, templates, vectors
from ratecal.llm.components import components, forest

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def union_find(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    random.seed(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(60)] + [(random.randrange(200, 400), random.randrange(200, 400)) for _ in range(150)]
    edges += [(7, 7), (500, 501), (501, 500), (500, 501)]
    expected = union_find({x for e in edges for x in e}, edges)
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(frame.repartition(5)).collect()}
    assert all(got[n] == c for n, c in expected.items() if n in got) and set(expected) - set(got) <= {n for n in expected if expected[n] == n}
    assert components(frame.limit(0)).collect() == []
    ends, root = forest(*map(np.array, zip(*edges)))
    assert dict(zip(ends.tolist(), root.tolist())) == expected


def test_bitmap_has_all_members(spark):
    ids = spark.range(-3000, 3000, 7).select(F.xxhash64("id").alias("h"))
    words = bits.bitmap(ids, 1 << 14)
    assert bits.member(words, np.array([r.h for r in ids.collect()]), 1 << 14).all()
    assert not bits.bitmap(ids.limit(0), 1 << 10).any()


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) > 2 else {tuple(words)} if words else set()


def slow_groups(rows, percent=85):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[:k]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return sets, union_find(ids, links)


def check_groups(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit("clash"), "high": F.lit(1), "bands": F.lit(2)})
    sets, expected = slow_groups(rows)
    got = minhash.groups(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), expected[r.doc_id], expected[r.doc_id] == r.doc_id)
    return expected


def test_groups_of_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check_groups(spark, docs)


def test_groups_of_odd_and_chained_documents(spark):
    random.seed(5)
    words = [f"w{i}" for i in range(500)]
    text = [random.choice(words) for _ in range(120)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one two"), (4, "One  TWO"), (5, "one"), (6, "a b c"), (7, "a b c"), (None, "a b c"), (8, "É b c"), (9, "é b c")]
    # a chain in which each is close to the next, but the ends are not
    for k in range(30):
        text = list(text)
        text[(k * 13) % 120 : (k * 13) % 120 + 3] = [f"n{k}", f"m{k}", f"o{k}"]
        rows.append((100 + k, " ".join(text)))
    rows += [(200 + k, " ".join(text)) for k in range(25)]
    rows += [(300, "word " * 60_000), (301, "word " * 50_000), (300, "word " * 60_000)]
    expected = check_groups(spark, rows)
    assert expected[129] == 100 and expected[200] == 100 and expected[301] == 300
    assert minhash.groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_a_bucket_with_several_components(spark):
    """A hot group of near copies of one text, with others in between."""
    random.seed(6)
    base = [f"w{random.randrange(400)}" for _ in range(150)]
    rows = []
    for k in range(150):
        text = list(base)
        for _ in range(random.choice([1, 2, 6, 12])):
            text[random.randrange(150)] = f"x{random.randrange(10_000)}"
        rows.append((k, " ".join(text)))
    check_groups(spark, rows)


def test_a_hot_component_beside_an_outlier(spark, monkeypatch):
    """The bucket's smallest id is linked to none of the others, which are one component: they are
    compared with it, in groups of bounded size, and not with each other."""
    random.seed(12)
    base = [f"w{k}" for k in range(150)]
    rows = [(0, " ".join(base[:118] + [f"y{k}" for k in range(32)]))]
    for k in range(1, 161):
        text = list(base)
        text[149] = f"x{k}"
        rows.append((k, " ".join(text)))
    groups, kind, plain = [], type(spark.range(1)), type(spark.range(1)).mapInArrow

    def counted(frame, *given, **named):
        if "key" in frame.columns:
            by = ["key", "i", "j"] if "i" in frame.columns else ["key", "block"]
            groups.append([r["count"] for r in frame.groupBy(by).count().collect()])
        return plain(frame, *given, **named)

    monkeypatch.setattr(kind, "mapInArrow", counted)
    settings = minhash.Settings(block=16)
    found = {r.doc_id: r.component_id for r in minhash.groups(spark.createDataFrame(rows, "doc_id long, text string"), settings).collect()}
    assert found == slow_groups(rows)[1] and set(found.values()) == {0, 1}
    assert groups and any(groups)
    for sizes in groups:
        assert all(n <= 4 * settings.block for n in sizes) and sum(sizes) <= 2 * len(rows) * settings.bands


def test_deduplicated_keeps_columns(spark):
    rows = spark.createDataFrame([(1, "a b c d", "x"), (2, "a b c d", "y"), (3, None, "z"), (None, "a b c d", "w")], "doc_id long, text string, n string")
    kept = minhash.deduplicated(rows)
    assert kept.columns == rows.columns and sorted(r.n for r in kept.collect()) == ["w", "x", "z"]


# --- vectors -----------------------------------------------------------------------------------


def check_vectors(spark, rows, settings=vectors.Settings()):
    found = vectors.groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>, unit string"), settings).collect()
    units = {r[0]: u for r, u in zip(rows, vectors.normalised([r[1] for r in rows]))}
    ids = sorted(i for i in units if i is not None)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[:k]
        if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.9
    ]
    expected, n = union_find(ids, links), {i: 0 for i in ids}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert len(found) == len(rows)
    for r in found:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (n[r.vec_id], expected[r.vec_id], expected[r.vec_id] == r.vec_id)


def test_vectors(spark):
    random = np.random.default_rng(3)
    centres = random.normal(size=(30, 24))
    rows, i = [], 0
    for c in centres:
        for _ in range(6):
            v = c + random.normal(size=24) * random.choice([0.05, 0.2])
            rows.append((i, v.tolist(), "u"))
            i += 1
    rows += [(1000 + k, [1.0, 0.0, 2.0], "u") for k in range(40)] + [(1100, [2.0, 0.0, 4.0], "u"), (1101, [1e300, 0.0, 2e300], "u")]
    rows += [(2000, None, "u"), (2001, [], "u"), (2002, [0.0, 0.0], "u"), (2003, [1.0, None], "u"), (2004, [1.0, float("nan")], "u"), (2005, [1.0, float("inf")], "u")]
    rows += [(None, [1.0, 0.0, 2.0], "u")]
    check_vectors(spark, rows)


def test_large_buckets_are_split(spark):
    random = np.random.default_rng(8)
    centre = random.normal(size=16)
    rows = [(k, (centre + random.normal(size=16) * 0.15).tolist(), "u") for k in range(120)]
    check_vectors(spark, rows, vectors.Settings(block=16))


def test_recall_at_the_limit(spark):
    """Pairs at a cosine just over 0.9, which the tables see least."""
    random = np.random.default_rng(9)
    rows = []
    for k in range(300):
        a = random.normal(size=64)
        a /= np.linalg.norm(a)
        b = random.normal(size=64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * k, a.tolist()), (2 * k + 1, (0.905 * a + np.sqrt(1 - 0.905**2) * b).tolist())]
    found = vectors.groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert found.filter("n_links = 1").count() >= 0.98 * len(rows)


def test_no_vectors(spark):
    assert vectors.groups(spark.createDataFrame([], "vec_id long, embedding array<double>")).collect() == []


# --- templates ---------------------------------------------------------------------------------

ITEMS = [
    (1, "A train leaves Berlin at 7 and travels 300 miles to Vienna in 5 hours at full speed without any stop on the way"),
    (2, "Which of the following words is not a colour and why do people often think that it is one"),
    (3, "too short"), (4, None), (None, "nothing to see here at all in this one"), (2, "Which of the following words is not a colour and why do people often think that it is one"),
]
CASES = [
    (1, "Note this. A train leaves Madrid at 11 and travels 80 km to Lisbon in 2 days at full speed without any stop on the way, ok", [1]),
    (2, "so: which of the FOLLOWING words is not a colour and why do people often think that it is one?", [2]),
    (3, "which of the following words is not a verb", []),
    (4, "a train leaves berlin at 7 and travels 300 miles to vienna in 5 hours at full speed without any stop on the way", [1]),
    (5, None, []), (6, "", []), (7, "too short", []), (None, ITEMS[1][1], []), (8, "word " * 100_000 + ITEMS[1][1], [2]),
]


def test_shared_openings_pair_nothing(spark):
    """Items that begin alike: the opening's windows are not required, so only a document's own item meets it."""
    random.seed(11)
    words = ["w" + "".join(random.choice("bcdfglmnr") + random.choice("aeiou") for _ in range(4)) for _ in range(3000)]
    opening = " ".join(words[:10])
    items = [(i, f"{opening} " + " ".join(random.choices(words[10:], k=random.choice([4, 12, 20])))) for i in range(60)]
    items += [(60, opening), (61, items[0][1]), (61, items[0][1])]
    docs = [(i, "zz yy " + text + " xx") for i, text in items[:40]] + [(100 + i, f"{opening} " + " ".join(random.choices(words, k=30))) for i in range(40)]
    bench, frame = (spark.createDataFrame(x, "{} long, text string".format(n)) for x, n in ((items, "item_id"), (docs, "doc_id")))
    settings = templates.Settings()
    windows = templates._found(bench, "item_id", settings)
    least = {r.item_id: r.tokens * settings.coverage for r in windows.collect()}
    need, places, opened = {}, {}, {r.window for r in windows.filter("item_id = 60").collect()}
    for r in templates.required(windows, settings).collect():
        need.setdefault(r.item_id, set()).add(r.window)
    for r in windows.collect():
        places.setdefault(r.item_id, []).append((r.window, r.place))
    for item, held in places.items():
        rest = {q + k for w, q in held if w not in need[item] for k in range(settings.window)}
        assert len(rest) < least[item]
    assert not any(need[i] & opened for i, text in items[:60] if len(text.split()) > 14)
    # against coverage counted for every document and item
    own = {}
    for r in templates._found(frame, "doc_id", settings).collect():
        own.setdefault(r.doc_id, set()).add(r.window)
    expected = set()
    for doc, held in own.items():
        for item, w in places.items():
            if len({q + k for x, q in w if x in held for k in range(settings.window)}) >= least[item]:
                expected.add((doc, item))
    found = {(r.doc_id, r.item_id) for r in templates.matches(frame, bench).collect()}
    assert found == expected and {(i, i) for i in range(40)} | {(0, 61), (100, 60)} <= found


def test_templates(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in CASES], "doc_id long, text string, window int")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = templates.matches(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == sorted((i, n) for i, _, items in CASES if i is not None for n in items)
    kept = templates.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _, items in CASES if i is None or not items)
    assert templates.matches(docs, bench.limit(0)).collect() == [] and templates.matches(docs.limit(0), bench).collect() == []


def test_slots_must_agree(spark):
    """The item's one value in two places stands for two values here."""
    item = "Take 5 red stones from the bag then add 5 blue stones to it and then count every stone"
    same = item.replace("5", "8")
    other = "Take 8 red stones from the bag then add 9 blue stones to it and then count every stone"
    docs = spark.createDataFrame([(1, same), (2, other)], "doc_id long, text string")
    found = {r.doc_id: r.covered for r in templates.matches(docs, spark.createDataFrame([(1, item)], "item_id long, text string"), templates.Settings(coverage=0.1)).collect()}
    assert found[1] == 19 and found[2] < 19


def test_a_copy_beside_variants(spark):
    """An item's values are taken from one occurrence, not from several mixed."""
    item, variant, third = (
        "Add {} red and {} blue then {} green or {} white plus {} old and {} new ones in {} large bags".format(*values)
        for values in ((3, 14, 8, 25, 6, 90, 7), (5, 11, 9, 31, 2, 80, 4), (7, 12, 4, 38, 1, 70, 5))
    )
    longer = item.replace("8 green", "8 very green")
    docs = [
        (1, f"{item}. {variant}."), (2, f"{variant}. {item}."), (3, f"{variant}. {third}. {variant}. {third}."), (4, f"{third} {longer} {variant}"),
        (5, " ".join(f"{n}) {t}" for n, t in enumerate([variant, third, item] * 300))),
        (6, variant), (6, third),
    ]
    found = templates.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    covered = {r.doc_id: r.covered for r in found}
    assert covered == {k: 23 for k in (1, 2, 3, 5, 6)} | {4: covered.get(4)} and covered[4] >= 19


def test_items_of_few_literal_tokens(spark):
    items = ["What is the mean of 4 8 15 16 23 42", "What is 3 + 4 + 5 + 6 + 7 + 8", "Compute 12 * 7 - 3 + 45 / 9", "3 + 4 + 9 + 8 + 7 equals which number"]
    docs = [f"Now some text. {t}. More of it." for t in items] + items
    docs += ["What is the mean of 5 9 17 18 24 43", "so what is 9 + 8 + 7 + 6 + 5 + 4 then", "1 + 2 + 3 + 4 + 5 equals which number"]
    others = ["Compute 11 * 6 - 2 + 44 / 8", "1 2 3 4 5 6 7 8 9 10 11 12", "What is 3 + 4 then", "the mean of 4 8 is 6"]
    frame = spark.createDataFrame(list(enumerate(docs + others)), "doc_id long, text string")
    found = templates.matches(frame, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    expected = {(i, i % 4) for i in range(8)} | {(8, 0), (9, 1), (10, 3)}
    assert {(r.doc_id, r.item_id) for r in found} == expected and all(r.coverage == 1 for r in found)


def test_benchmark_passages_in_documents(spark):
    """All items of which a document has nearly all plain windows are found, and no others."""
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def windows(text):
        words = re.findall(r"\w+", text.lower())
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    items = {i: windows(t) for i, t in bench}
    expected = set()
    for d, text in docs:
        own = windows(text)
        expected |= {(d, i) for i, w in items.items() if len(w & own) >= 0.9 * len(w)}
    found = queries.LLM_QUERIES["op8_template_decontamination"](spark, SF).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected and expected


def test_repeated_rows_are_told_once(spark):
    text = " ".join(f"w{i}" for i in range(400))
    docs = spark.createDataFrame([(1, text)] * 60 + [(2, text + " end")] * 60, "doc_id long, text string").repartition(2)
    sets = minhash._full_sets(docs, spark.createDataFrame([(1,), (2,)], "doc_id long"), minhash.Settings())
    assert sets.count() <= 4
    assert {(r.doc_id, r.component_id) for r in minhash.groups(docs).collect()} == {(1, 1), (2, 1)}
