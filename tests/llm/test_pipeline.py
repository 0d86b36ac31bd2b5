"""The pipeline: what each stage keeps, against its operator's own table and brute force."""

import hashlib
import re
import struct

import pytest
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from ratecal.llm import bpe, language, templates, toxicity

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def five_words(docs):
    """One document of each group of near copies, by all pairs of sets of five words."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for r in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(lower))
        sets[r.doc_id] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}
    order, parts = sorted(sets), {i: i for i in sets}

    def root(i):
        while parts[i] != i:
            i = parts[i]
        return i

    for k, i in enumerate(order):
        for j in order[:k]:
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parts[b] = a
    return {i for i in order if root(i) == i}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output, written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        where = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(where)
        kept = spark.read.parquet(where)
        out.append((name, docs, kept))
        docs = kept
    return out


def test_stages_keep_columns_and_rows(spark, stages):
    assert [name for name, _, _ in stages] == ["toxicity", "language", "near copies", "benchmark", "tokens"]
    for _, given, kept in stages[:-1]:
        assert kept.schema == given.schema and kept.exceptAll(given).count() == 0
    for (_, _, kept), (_, given, _) in zip(stages, stages[1:]):
        assert ids(kept) == ids(given)


def test_decisions_take_effect(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    given, kept = stages[0][1:]
    toxic = toxicity.scored(given, labels).filter("predicted = 1")
    assert sorted(ids(kept) + ids(toxic)) == ids(given) and toxic.count() > 0
    given, kept = stages[1][1:]
    profiles = language.fit(given)
    assert ids(kept) == ids(language.predict(given, profiles, near=0.5).filter("lang_pred <> 'und'"))
    given, kept = stages[2][1:]
    assert set(ids(kept)) == five_words(given) and kept.count() < given.count()
    given, kept = stages[3][1:]
    found = templates.matches(given, spark.read.parquet(f"{SF}/benchmark.parquet")).select("doc_id").distinct()
    assert sorted(ids(kept) + ids(found)) == ids(given)
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    texts = {r.doc_id: r.text for r in stages[4][1].collect()}
    for r in stages[4][2].collect():
        coded = bpe.encode_texts([texts[r.doc_id]], path, pattern)[0]
        assert (r.n_tokens, r.ids_sha256) == (len(coded), hashlib.sha256(struct.pack(f"<{len(coded)}I", *coded)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_is_the_stages_in_turn(spark, stages):
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    assert got == sorted(map(tuple, stages[-1][2].collect()))


def test_odd_rows_pass_through(spark):
    """Also with columns of the names that the stages use inside, and repeated rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(None, "the a of b", None, None, None), (-1, None, None, None, None), (-2, "", "x", "y", 0)], docs.schema)
    docs = docs.union(odd).union(docs.limit(3))
    mine = {"_toxic": 1, "_lang": 2, "_score": 3, "_copy": 4, "_flagged": 5, "kept": 6, "item_id": 7}
    docs = docs.withColumns({name: F.lit(value) for name, value in mine.items()})
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "tokens":
            assert {tuple(r) for r in docs.select(*mine).distinct().collect()} == {(1, 2, 3, 4, 5, 6, 7)}
    rows = docs.filter("doc_id IS NULL OR doc_id < 0").collect()
    assert not [r for r in rows if r.doc_id is not None]  # those have no letter, so no language
    nothing = spark.read.parquet(f"{SF}/documents.parquet").limit(0).withColumn("lang", F.lit("en"))
    for _, stage in corpus_pipeline.STAGES:
        nothing = stage(spark, nothing, SF)
    assert nothing.collect() == []
