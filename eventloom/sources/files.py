"""Text and CSV sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_text(spark: SparkSession, path: str, cache: bool = False) -> DataFrame:
    """One row per line, column ``value``."""
    df = spark.read.text(path)
    return df.cache() if cache else df


def read_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Follow a folder of text files; each new file's lines become rows.
    (Lines appended to a file that was already read are not seen.)"""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


CORRUPT = "_corrupt"


def read_csv_flagged(spark: SparkSession, path: str, schema: StructType, key: Sequence[str] = ()) -> DataFrame:
    """Headed CSV with a declared schema; every row with a ``reason`` that is
    null or says why it can't be a row of the table: a value (or the number of
    values) that doesn't fit the schema, a null in a NOT NULL column, a key that
    other good rows have too.

    One scan, and with ``key`` a second one that counts the good rows' keys
    (partial aggregation, so no key's rows meet in one task; all columns are
    parsed in both, so that both see the same rows as bad)."""
    of = StructType([*[StructField(f.name, f.dataType) for f in schema.fields], StructField(CORRUPT, StringType())])
    df = (spark.read.schema(of).option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    reason = F.when(F.col(CORRUPT).isNotNull(), F.concat(F.lit("doesn't fit: "), F.col(CORRUPT)))
    for f in schema.fields:
        if not f.nullable:
            reason = reason.when(F.col(f"`{f.name}`").isNull(), F.lit(f"{f.name} is null"))
    # never true, but it names every column: so all are parsed, and a row is bad whatever columns a query reads
    every = F.concat_ws("", *[F.col(f"`{f.name}`").cast("string") for f in schema.fields])
    rows = df.withColumn("reason", reason.when(every == "\u0000", F.lit("empty"))).drop(CORRUPT)
    if not key:
        return rows
    dups = rows.filter("reason is null").groupBy(*key).count().filter("count > 1").select(*[F.col(k).alias(f"_{k}") for k in key])
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    repeated = F.col("reason").isNull() & F.col("_repeated")
    return (rows.join(dups.withColumn("_repeated", F.lit(True)), same, "left")
            .withColumn("reason", F.when(F.coalesce(repeated, F.lit(False)), F.lit("repeated key")).otherwise(F.col("reason")))
            .select(*schema.names, "reason"))


def read_csv_table(spark: SparkSession, path: str, schema: StructType,
                   key: Sequence[str] = (), order_by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """:func:`read_csv_flagged` as two tables, (rows, rejects). Each is a read of its own."""
    flagged = read_csv_flagged(spark, path, schema, key)
    good, rejects = flagged.filter("reason is null").drop("reason"), flagged.filter("reason is not null").drop("reason")
    return (good.orderBy(*order_by) if order_by else good), rejects
