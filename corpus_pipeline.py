"""The corpus pipeline: five operators, each working on what the one before kept.

Toxic documents go; of near duplicates one stays; spans that repeat across
documents are cut from all but their first place; documents contaminated by the
benchmark go; what is left is packed into training sequences. Every stage but
the last returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import table, written
from quire.llm.decontaminate import decontaminate
from quire.llm.jaccard import keep_one
from quire.llm.packing import pack
from quire.llm.substrings import dedup_substrings
from quire.llm.toxicity import drop_toxic, train_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents scored toxic by a model learned on these."""
    return drop_toxic(docs, train_toxicity(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each similarity class."""
    return keep_one(docs)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows of 20 words that start earlier elsewhere."""
    return dedup_substrings(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents contaminated by the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), mode="documents")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: one row per piece."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_spans", repeated_spans),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A learned model and a tokenizer are no SQL; tests hold each stage against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
