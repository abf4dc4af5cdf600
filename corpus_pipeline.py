"""A corpus from raw documents: unwanted, repeated and leaked documents go, personal data is masked, sources are mixed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plantroom.llm import decontaminate, jaccard, mixing, pii, toxicity
from plantroom.llm.shared import stored


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; learned from the labels."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def not_repeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: shingles of five words, similarity of at least 0.8."""
    return jaccard.one_of_each(docs, size=5, percent=80)


def not_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows."""
    return pii.mask(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents to use, with the number of whole epochs and the tokens of one more."""
    return mixing.selected(docs)


STAGES = [
    ("toxicity", not_toxic),
    ("near_duplicates", not_repeated),
    ("decontamination", not_leaked),
    ("personal_data", masked),
    ("mixing", mixed),
]

#: Trained models decide in several stages, which SQL cannot express; tests compare each with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
