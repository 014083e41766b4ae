"""Documents through the stages of a training-text pipeline, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, decontamination, near_duplicates, pii, quality_rules
from tidemark.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie within the thresholds of their language and source."""
    return quality_rules.keep_good(docs)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by five-word overlaps of 0.8 or more, the one with the lowest id."""
    return near_duplicates.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row with a benchmark item."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and what reveals it replaced; n_chars follows the text."""
    clean = pii.sanitise(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document that is left, and the digests of ids and of the decoded text."""
    return byte_bpe.round_trip(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near-duplicates", near_duplicate),
    ("benchmark", benchmark),
    ("personal-data", personal_data),
    ("encode", encode),
]

# Quantile fences, near-duplicate classes and BPE merges can't all be said in SQL: the tests compare each stage with
# brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
