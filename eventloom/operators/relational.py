"""Projections and filters. All narrow; Catalyst pushes the filters into the
parquet scan where the predicate is on a stored column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def select_star(spark: SparkSession, df: DataFrame, view: str) -> DataFrame:
    """Name ``df`` as a view and read it back through SQL."""
    df.createOrReplaceTempView(view)
    return spark.sql(f"SELECT * FROM `{view}`")


def rename(df: DataFrame, mapping: Mapping[str, str], keep_rest: bool = False) -> DataFrame:
    """Project ``mapping`` (old → new name); other columns only if ``keep_rest``."""
    cols = [F.col(o).alias(n) for o, n in mapping.items()]
    if keep_rest:
        cols += [F.col(c) for c in df.columns if c not in mapping]
    return df.select(*cols)


def sanitize(df: DataFrame, personal: Sequence[str]) -> DataFrame:
    """Drop personal fields before a record leaves the system."""
    return df.drop(*personal)


def at_least(df: DataFrame, column: str, threshold) -> DataFrame:
    return df.filter(F.col(column) >= F.lit(threshold))


def above_and_like(df: DataFrame, column: str, threshold, text_col: str, pattern: str) -> DataFrame:
    """Strict threshold AND a SQL LIKE pattern."""
    return df.filter((F.col(column) > F.lit(threshold)) & F.col(text_col).like(pattern))


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cond = None
    for c in columns:
        t = F.col(c).isNotNull()
        cond = t if cond is None else cond & t
    return df.filter(cond)


def containing(df: DataFrame, column: str, text: str, negate: bool = False) -> DataFrame:
    c = F.col(column).contains(text)
    return df.filter(~c if negate else c)


def tag_containing(df: DataFrame, column: str, text: str, alias: str) -> DataFrame:
    """Both sides of :func:`containing` in one pass, as a flag (null for null)."""
    return df.withColumn(alias, F.col(column).contains(text))
