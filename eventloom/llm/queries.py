"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventloom.llm import bagminhash, bpe, covertree, decontam, forest, license, lm, phrases, pii, quality, toxicity, warc, wrapper
from eventloom.llm.common import table

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.report(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op4_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.neighbours(table(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.report(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.report(table(spark, sf_dir, "documents"))


def op11_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.mine(table(spark, sf_dir, "embeddings"))


def op12_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapper.extract(table(spark, sf_dir, "pages"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_lm": op2_lm,
    "op3_pii": op3_pii,
    "op4_forest": op4_forest,
    "op5_quality": op5_quality,
    "op6_license": op6_license,
    "op7_toxicity": op7_toxicity,
    "op8_decontam": op8_decontam,
    "op9_bpe": op9_bpe,
    "op10_bagminhash": op10_bagminhash,
    "op11_covertree": op11_covertree,
    "op12_wrapper": op12_wrapper,
    "op13_phrases": op13_phrases,
}

#: DuckDB SQL where it can express the operator's result.
ORACLES: dict[str, str] = {
    "op1_warc": warc.REPORT_SQL,
    "op8_decontam": decontam.report_sql(),
    "op11_covertree": covertree.REPORT_SQL,
    "op13_phrases": phrases.REPORT_SQL,
}
