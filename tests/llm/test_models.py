"""Quality, toxicity, language and language-model scores: held-out accuracy, brute force, odd input."""

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecal.llm import chars, folds, language, lm, quality, queries, toxicity

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "123 !!"), (5, "Hello world"), (5, "Hello world"), (None, "no id here"),
    (6, "é" * 30_000), (7, "the and of " * 20_000), (8, "\x00\x1c  x"), (9, "🙂 ǅ İ"),
]


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels")]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with further columns whose names clash with results and with inner names."""
    rows = [(i, t, "en", "s", 0.5, "x", 1) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, _toxic double, held_out string, y int")


def held(i, parts=4, part=2):
    return i is not None and zlib.crc32(str(i).encode()) % parts == part


def test_hashes_do_not_depend_on_neighbours():
    alone = chars.segment_hashes(chars.Codes(["word"]).points, np.array([0]), np.array([4]))
    codes = chars.Codes(["a word", "sword"])
    both = chars.segment_hashes(codes.points, np.array([2, 8]), np.array([6, 12]))
    assert both.tolist() == [alone[0], alone[0]]
    assert chars.gram_hashes(codes.points, 3)[3] == chars.gram_hashes(codes.points, 3)[9]
    assert chars.gram_hashes(codes.points[:2], 3).size == 0


def test_chunks_cover_everything_and_never_cut_a_text():
    texts = ["a" * n for n in (3, 50, 0, 7, 200, 1)]
    assert [x for a, b in chars.chunks(texts, 60) for x in texts[a:b]] == texts
    assert list(chars.chunks([])) == []


@pytest.mark.parametrize("name,column,least", [("op1_quality_classifier", "quality", 0.93), ("op5_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, tables, name, column, least):
    found = queries.LLM_QUERIES[name](spark, SF).toPandas()
    assert len(found) == tables[0].count() and found["score"].between(0, 1).all()
    assert all(held(i) == h for i, h in zip(found["doc_id"], found["held_out"]))
    both = found[found["held_out"]].merge(tables[1].toPandas(), on="doc_id")
    assert (both["predicted"] == both[column]).mean() >= least


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_texts_and_no_labels(spark, odd, tables, module):
    docs, labels = tables
    rows = module.scored(odd.unionByName(docs.select("doc_id", "text"), allowMissingColumns=True), labels).collect()
    assert len(rows) == docs.count() + len(ODD)
    assert all(0 <= r.score <= 1 for r in rows)
    same = [r.score for r in module.scored(odd, labels.limit(0)).collect()]
    assert len(same) == len(ODD) and len(set(same)) == 1  # nothing learned
    assert module.scored(odd.limit(0), labels.limit(0)).collect() == []


def test_factorization_machine_learns_a_pair(spark):
    """Label 1 if and only if two words meet: no linear weights can say so."""
    import random

    random.seed(2)
    rows, labels = [], []
    for i in range(1200):
        words = [random.choice(["red", "blue", "green", "pink", "grey"]) for _ in range(3)]
        a, b = random.random() < 0.5, random.random() < 0.5
        rows.append((i, " ".join(words + ["bad"] * a + ["group"] * b)))
        labels.append((i, int(a and b)))
    found = toxicity.scored(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in found.collect()}
    assert all(got[i].predicted == y for i, y in labels if got[i].held_out)


def test_terms_that_are_neutral_alone(spark):
    """An insult with a group mention is toxic, either alone is as frequent in clean texts."""
    import random

    random.seed(5)
    filler = ["word" + a + b for a in "abcdefghij" for b in "abcdefghij"]
    kinds = (["insult", "group"], ["slur"], ["insult"], ["group"])
    rows = []
    for i in range(1600):
        kind = random.randrange(4)
        words = [random.choice(filler) for _ in range(12)] + kinds[kind]
        random.shuffle(words)
        rows.append((i, " ".join(words), int(kind < 2), kind))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int, kind int")
    found = toxicity.scored(frame, frame).join(frame.select("doc_id", "kind"), "doc_id").filter("held_out")
    right = {r.kind: r.share for r in found.groupBy("kind").agg(F.avg("predicted").alias("share")).collect()}
    assert min(right[0], right[1]) > 0.95 and max(right[2], right[3]) < 0.05


def test_factorization_machine_scores_by_its_formula(spark, odd):
    random = np.random.default_rng(4)
    words = ["hello", "world", "the", "and", "of", "é" * 30_000]
    key = [int(toxicity._terms([w])[0][0]) for w in words]
    order = np.argsort(key)
    model = toxicity.Model(np.array(key)[order], random.normal(size=6), random.normal(size=(6, 3)), -0.3)
    weight = {words[k]: (model.weights[n], model.vectors[n]) for n, k in enumerate(order)}
    for r in toxicity.score(odd, model, "p").collect():
        held = [weight[w] for w in set(re.findall(r"[^\W\d_]+", (r.text or "").lower())) if w in weight]
        raw = model.bias + sum(w for w, _ in held) + sum(a @ b for i, (_, a) in enumerate(held) for _, b in held[:i])
        assert math.isclose(r.p, 1 / (1 + math.exp(-raw)), rel_tol=1e-9)


def test_accepted_keeps_columns(spark, odd, tables):
    clash = odd.withColumns({"_toxic": F.lit("mine"), "_lang": F.lit("mine"), "_score": F.lit(7.5)})
    docs = tables[0].select("doc_id", "text", "lang").filter("doc_id > 9")
    rows = clash.unionByName(docs, allowMissingColumns=True)
    for kept in (toxicity.accepted(rows, tables[1]), language.accepted(rows)):
        own = kept.filter("doc_id < 10 OR doc_id IS NULL").collect()
        assert kept.columns == rows.columns and own and {(r._toxic, r._lang, r._score) for r in own} == {("mine", "mine", 7.5)}
    assert toxicity.accepted(rows, tables[1].limit(0)).count() == rows.count()  # nothing learned


def test_language_rejects_by_distance(spark, tables):
    import random

    random.seed(1)
    docs = tables[0].select("doc_id", "text", "lang")
    noise = [(10**9 + i, "".join(random.choice("bcdfghjklmnpqrstvwxz     ") for _ in range(n)), "en") for i, n in enumerate([30, 100, 300, 1000, 5000])]
    rows = docs.union(spark.createDataFrame(noise, docs.schema))
    kept = {r.doc_id for r in language.accepted(rows).select("doc_id").collect()}
    letters = {r.doc_id for r in docs.filter(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()}
    assert not any(i >= 10**9 for i in kept) and len(letters - kept) <= 0.002 * len(letters) and kept <= letters
    nothing = rows.withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id for r in language.accepted(nothing).collect()} == letters | {10**9 + i for i in range(5)}


def test_language_of_profiles_by_hand(spark, tables):
    """Distance, choice and score in plain Python."""
    profiles = language.fit(tables[0].select("doc_id", "text", "lang"))
    rank = {lang: {int(k): int(r) for k, r in zip(profiles.keys, ranks) if r < profiles.size} for lang, ranks in zip(profiles.languages, profiles.ranks)}
    rows = tables[0].select("doc_id", "text").limit(40).collect()
    got = {r.doc_id: r for r in language.predict(spark.createDataFrame(rows, "doc_id long, text string"), profiles).collect()}
    for r in rows:
        grams, counts = next(language._counts([r.text or ""]))
        top = [int(g) for _, g in sorted(zip((-counts).tolist(), grams.tolist()))][: profiles.size]
        if not top:
            assert got[r.doc_id].lang_pred == "und"
            continue
        far = {lang: sum(abs(own[g] - k) if g in own else profiles.size for k, g in enumerate(top)) for lang, own in rank.items()}
        best = min(sorted(far), key=far.get)
        assert got[r.doc_id].lang_pred == best and math.isclose(got[r.doc_id].score, 1 - far[best] / (profiles.size * len(top)))


def test_language_against_brute_force(spark, tables):
    """Counts of n-grams in plain Python, and held-out accuracy."""
    texts = ["The cat's  hat, ÉTÉ!", "", "a", "12"]
    for text, (grams, counts) in zip(texts, language._counts(texts)):
        words = "".join(c.lower() if c.isalpha() else " " for c in text).split()
        slow = {}
        for w in words:
            for n in language.GRAMS:
                for k in range(len(w) + 3 - n):
                    g = f" {w} "[k : k + n]
                    if g != " ":
                        slow[g] = slow.get(g, 0) + 1
        assert sorted(slow.values()) == sorted(counts.tolist())
        assert {int(chars.gram_hashes(np.array([ord(c) for c in g], dtype=np.uint32), len(g))[0]) for g in slow} == set(grams.tolist())
    docs = tables[0]
    found = language.predicted(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    own = found[found["held_out"]]
    assert (own["lang_pred"] == own["lang"]).mean() > 0.98 and found["score"].between(0, 1).all()


def test_language_of_odd_texts(spark, odd, tables):
    docs = tables[0].select("doc_id", "text", "lang").limit(300)
    got = language.predict(odd.drop("score"), language.fit(docs)).collect()
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {1, 2, 3, 4}
    assert {r.lang_pred for r in language.predict(odd, language.fit(docs.limit(0))).collect()} == {"und"}


# --- language model ----------------------------------------------------------------------------


def brute_force(rows):
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [None]) for i, t in rows]
    count = {}
    for i, words in docs:
        if i is not None and not held(i, 10, 0):
            for w in words:
                count[w] = count.get(w, 0) + 1
    total = sum(count.values())
    out = []
    for i, words in docs:
        base = sum(math.log10((count.get(w, 0) + 0.1) / (total + 0.1 * (len(count) + 1))) for w in words)
        out.append((i, held(i, 10, 0), len(words), sum(w in count for w in words), total, round(base, 6)))
    return out


def key(r):
    return (r[0] is None, *r)


def test_counts_and_base_score(spark, odd, tables):
    docs = tables[0].select("doc_id", "text").limit(200).union(odd.select("doc_id", "text"))
    got = lm.scores(docs, lm.Settings(tokens=20_000)).collect()
    found = [(*r[:5], round(r.base_score, 6)) for r in got]
    assert sorted(found, key=key) == sorted(brute_force([tuple(r) for r in docs.collect()]), key=key)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_better_than_single_words_and_repeatable(spark, tables):
    docs = tables[0].select("doc_id", "text")
    one, two = (lm.scores(docs).toPandas().sort_values("doc_id") for _ in range(2))
    own = one[one["held_out"]]
    assert own["score"].sum() > own["base_score"].sum()
    # chunks differ by how rows are dealt, probabilities do not
    assert np.allclose(one["score"], two["score"], rtol=1e-9)


def test_no_training_texts(spark, odd):
    got = lm.scores(odd.filter("doc_id IS NULL")).collect()
    assert [(r.held_out, r.n_known, r.train_tokens) for r in got] == [(False, 0, 0)]
    assert lm.scores(odd.limit(0)).collect() == []


def test_probabilities_of_one_context_sum_to_one(spark):
    """All words of a small alphabet up to some length, with the mass of longer ones left over."""
    words = ["ab", "ba", "aab", "b", "ab", "ab", "bb"] * 30
    settings = lm.Settings()
    spelling = lm.Spelling(words, settings)
    model = lm.character_model(spelling.customers(np.ones(len(words), dtype=np.int64)), settings, 1)
    every = [""]
    total = 0.0
    for _ in range(12):
        every = [w + c for w in every for c in "ab"][:4096]
        total += np.exp(lm.Spelling(every, settings).log_probability(model)).sum()
    assert 0.9 < total <= 1.0


def test_seating_follows_the_process():
    """Numbers of tables against seating customer by customer."""
    random = np.random.default_rng(1)
    for c, a, d in ((1, 2.0, 0.5), (40, 0.3, 0.5), (200, 5.0, 0.8), (1000, 50.0, 0.1)):
        fast = lm.seat(np.full(3000, c), np.full(3000, a), d, random).mean()
        slow = []
        for _ in range(400):
            t = 1
            for n in range(1, c):
                t += random.random() < a / (a + n - d * t)
            slow.append(t)
        assert abs(fast - np.mean(slow)) < 0.08 * np.mean(slow) + 4 * np.std(slow) / 20


def test_common_words_are_counted_in_all_training_documents(spark):
    # forty words are nearly equally frequent in 30,000 documents, which a sample would not put in order
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 40).alias("text"))
    words, _ = lm.common_words(docs, lm.Settings(common=1))
    counts = docs.filter(folds.remainder("doc_id", 10) != 0).groupBy("text").count().collect()
    first, second = sorted(counts, key=lambda r: -r["count"])[:2]
    assert first["count"] > second["count"] and list(words) == list(lm._words([first["text"]])[0])


def test_seating_of_common_words_in_few_draws():
    """Tables of a dish with very many customers: as many as one by one, by draws that do not follow their number."""

    class Counted:
        def __init__(self, random):
            self.random_, self.draws = random, 0

        def __getattr__(self, name):
            self.draws += 1
            return getattr(self.random_, name)

    random, tables = np.random.default_rng(3), []
    for _ in range(40):
        t, chances = 1, random.random(20_000)
        for n in range(1, 20_000):
            t += chances[n] < 900 / (900 + n - 0.6 * t)
        tables.append(t)
    counted = Counted(np.random.default_rng(4))
    fast = lm.seat(np.full(400, 20_000), np.full(400, 900.0), 0.6, counted)
    error = np.sqrt(np.var(tables) / 40 + fast.var() / 400)
    assert abs(fast.mean() - np.mean(tables)) < 4 * error and 0.6 < fast.std() / np.std(tables) < 1.6
    assert counted.draws < 500 < fast.min()
    counted = Counted(np.random.default_rng(5))
    lm.seat(np.array([50_000_000]), np.array([20_000.0]), 0.7, counted)
    assert counted.draws < 1000


def test_packed_arrays_come_back():
    for values in (np.arange(-5, 70_000), np.zeros(0, np.int64), np.array([1.5, -np.inf, 1e-300]), np.array([3, 1 << 30], np.int32)):
        assert np.array_equal(chars.unpacked(chars.packed(values), values.dtype), values)
    words = ["a", "\0", "ß日", "x" * 3000]
    assert lm._unpacked_words(lm._packed_words(words)).to_pylist() == words
    tokens = np.random.default_rng(1).zipf(1.3, 200_000).clip(max=60_000).astype(np.int32)
    assert len(chars.packed(tokens)) < tokens.nbytes / 2


def test_every_word_is_a_context(spark):
    """1,200 words, of which few are common: what follows each is learned from the texts."""
    number = F.col("id") % 600
    swapped = F.when(folds.held_out("id", 10, 0) & (F.col("id") % 7 < 3), 1).otherwise(0)
    docs = spark.range(12_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("a"), number, F.lit(" b"), (number + swapped) % 600).alias("text"), swapped.alias("swapped")
    )
    got = lm.scores(docs, lm.Settings(hall=1 << 15)).join(docs, "doc_id").filter("held_out").groupBy("swapped").agg(F.avg("score"), F.avg("base_score"))
    (right, right_base), (wrong, wrong_base) = (r[1:] for r in sorted(got.collect()))
    assert abs(right_base - wrong_base) < 0.1 and right > wrong + 2


def test_pairs_of_words_meet_in_halls(spark, odd, tables):
    docs = tables[0].select("doc_id", "text").limit(100).union(odd.select("doc_id", "text"))
    settings, none = lm.Settings(tokens=5_000, common=0), (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    chunks = lm._chunks(docs, none, settings).localCheckpoint()
    halls = lm._halls(chunks, none, 8).localCheckpoint()
    found = [chars.unpacked(r["counts"], np.int64) for r in halls.collect()]
    count, starts = {}, {}
    for i, t in docs.collect():
        words = [None, *re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), 0]
        for pair in zip(words, words[1:]):
            learned = i is not None and not held(i, 10, 0)
            count[pair] = count.get(pair, 0) + learned
            starts[pair] = pair[0] is None
    assert len(found) == 8 and sorted(np.concatenate(found).tolist()) == sorted(count.values())
    (contexts, customers, seated), discount = lm._hall_totals(halls)
    assert contexts.tolist() == [int(lm.START_HASH)]
    assert customers[0] == sum(n for p, n in count.items() if starts[p])
    assert seated[0] == sum(n > 0 for p, n in count.items() if starts[p])
    asks = lm._asks(halls, settings).collect()
    assert sum(chars.unpacked(r["counts"], np.int64).sum() for r in asks) == sum(n > 0 for n in count.values())
