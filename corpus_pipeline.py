"""Clean and mix a corpus: five stages, each written to the shared folder and reread by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm import decontaminate, mixing, near_dedup, quality_classifier, secrets
from tabloom.llm.common import table
from tabloom.storage import materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return near_dedup.keep_one(docs, size=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets and linked credentials replaced by their kind."""
    return secrets.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of sources takes."""
    return mixing.taken(docs)


STAGES = [
    ("quality", good_quality),
    ("near_dedup", near_deduplicated),
    ("decontaminate", decontaminated),
    ("secrets", without_secrets),
    ("mix", mixed),
]

#: The classifier, sketches and draws are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
