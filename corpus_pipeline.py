"""Cleaning and packing of the ``documents`` table, stage by stage.

Every stage takes the documents its predecessor kept and returns them with the
columns of ``documents``; the last returns packed pieces. Stages filter or
rewrite rows where they lie. Only near-dedup moves texts, and only those of
likely duplicates.

Cases: null ids are never near-duplicates and stay; null texts have no words
and go with the first stage; repeated rows leave one; further columns are kept
up to the last stage; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelflow.llm import decontamination, near_dup, packing, pii, quality_rules
from parcelflow.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality rules reject."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return near_dup.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontamination.without_items(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; ``n_chars`` follows the new text."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenises every document and packs the pieces into sequences of 2048."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("best_fit_packing", packing_stage),
]

# The similarity join, the trained spans and the tokeniser are beyond SQL; the tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents`` in order, each on what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
