"""A corpus in five stages: no toxic text, a known language, one of each group of near copies, no
benchmark questions, and tokens. Every stage reads what its predecessor kept."""

from pyspark.sql import DataFrame, SparkSession

from ratecal.llm import bpe, language, minhash, templates, toxicity
from ratecal.llm.ship import ship
from ratecal.session import new_folder


# near copies share four fifths of their runs of five words
NEAR = minhash.Settings(words=5, percent=80)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs, NEAR)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return templates.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def _shipped(stage):
    def run_stage(spark, docs, sf_dir):
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    (name, _shipped(stage))
    for name, stage in (
        ("toxicity", not_toxic), ("language", known_language), ("near copies", near_copies),
        ("benchmark", no_benchmark), ("tokens", tokens),
    )
]

# Learned models decide in it; the stages are tested against brute force and held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage's result is written to the work folder and read again,
    so a later one never repeats an earlier one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        written = new_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(written)
        docs = spark.read.parquet(written)
    return STAGES[-1][1](spark, docs, sf_dir)
