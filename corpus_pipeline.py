"""The corpus pipeline: each stage calls one operator of ``eventloom.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of ``documents``. Each operator's docstring says what it
does with nulls, empty and long texts, repeated rows and empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventloom.llm import bagminhash, bpe, decontam, pii, queries, toxicity
from eventloom.llm.common import materialise, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the segment scorer, fitted on the labels, doesn't call toxic."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return bagminhash.clean(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind in angle brackets."""
    return pii.mask(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count of each document, with the digests of its ids and of the decoded text."""
    return bpe.round_trip(docs, queries.tokenizer_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("bpe", bpe_stage),
]

#: SQL can't express fitted scores or byte-pair merges; tests/llm has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
