"""From raw documents to packed sequences: the stages of a training-data pipeline, in order.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns
of `documents`. What a stage rejects is gone for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskmart.llm import cpsj, debruijn, packing, quality, spaced, store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules, and the verdict on their host, keep."""
    return quality.kept_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near copies."""
    store.workers(spark)
    return cpsj.kept_rows(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that a document with a smaller doc_id has; a text that is empty then goes."""
    store.workers(spark)
    return debruijn.kept_rows(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return spaced.clean(docs, store.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequence and place in it."""
    store.workers(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

ORACLE_SQL = None  # token ids and the packing plan are beyond SQL; tests/llm compares each stage with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the result of each is stored as Parquet before the next reads it."""
    docs = store.table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store.stage(docs, name)
    return docs
