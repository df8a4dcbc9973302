"""Incremental loads by an increasing column (the JDBC-connector pattern).

Each load appends the rows above the last high-water mark to a target folder
and then records the new mark; marks live in a small table next to it, so a
rerun after a failure reloads at most the one batch it had not committed
(rows of an uncommitted load number are overwritten, not duplicated).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.session import path_exists


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
              partitions: int, properties: dict | None = None) -> DataFrame:
    """A database table as the source of a load, read in ``partitions`` ranges
    of ``column``. Needs the database's JDBC driver on the cluster (untested
    here: no driver and no database)."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties or {})


def last_mark(spark: SparkSession, state_path: str):
    """(last load number, its high-water mark); (0, None) before the first load."""
    if not path_exists(spark, state_path):
        return 0, None
    marks = spark.read.parquet(state_path)
    row = marks.agg(F.max("load_no").alias("n"),
                    F.max_by("mark", "load_no").alias("m")).first()
    return (row["n"] or 0), row["m"]


def load_increment(spark: SparkSession, source: DataFrame, column: str,
                   target_path: str, state_path: str) -> int:
    """Append rows of ``source`` with ``column`` above the mark; returns the
    load number used."""
    n, mark = last_mark(spark, state_path)
    load_no = n + 1
    new = source if mark is None else source.filter(F.col(column) > F.lit(mark))
    new.write.mode("overwrite").parquet(f"{target_path}/load_no={load_no}")
    written = spark.read.parquet(f"{target_path}/load_no={load_no}")
    new_mark = written.agg(F.max(column)).first()[0]
    if new_mark is None:
        new_mark = mark
    if new_mark is not None:
        (spark.createDataFrame([(load_no, new_mark)], f"load_no int, mark {dict(written.dtypes)[column]}")
         .write.mode("append").parquet(state_path))
    return load_no


def read_loaded(spark: SparkSession, target_path: str) -> DataFrame:
    return spark.read.parquet(target_path)
