"""Corpus pipeline: reject toxic documents, drop exact and near copies, drop benchmark leaks, pack.

Each stage takes (spark, docs, sf_dir). ``docs`` is what the stage before kept, read back
from Parquet; all stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataward.llm.common import prepare, store, table
from strataward.llm.contamination import drop_leaks
from strataward.llm.exact_dedup import drop_copies
from strataward.llm.minhash import STAGE_PERCENT, drop_near_copies
from strataward.llm.packing import pack_documents
from strataward.llm.toxicity import document_labels, drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    prepare(spark)
    return drop_toxic(docs, document_labels(spark, sf_dir))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of equal texts."""
    prepare(spark)
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (0.8 of similarity or more)."""
    prepare(spark)
    return drop_near_copies(docs, STAGE_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    prepare(spark)
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents and their places in sequences of 4096 tokens."""
    prepare(spark)
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]
ORACLE_SQL = None  # a trained classifier, MinHash and a tokenizer are beyond SQL; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read back."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
