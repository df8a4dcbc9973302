"""Keyed aggregations. Every one of them aggregates partially on the map side
before the shuffle, so a key holding a large share of the rows ships one
partial row per map task, not its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(keys) -> list:
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def sum_by_key(df: DataFrame, keys, value: str, alias: str = "total",
               round_to: int | None = None) -> DataFrame:
    s = F.sum(value)
    if round_to is not None:
        s = F.round(s, round_to)
    return df.groupBy(*_keys(keys)).agg(s.alias(alias))


def basic_stats(df: DataFrame, keys, value: str, round_to: int | None = None) -> DataFrame:
    """MAX / MIN / SUM / COUNT of ``value`` per key."""
    s = F.sum(value)
    if round_to is not None:
        s = F.round(s, round_to)
    return df.groupBy(*_keys(keys)).agg(
        F.max(value).alias("max_value"), F.min(value).alias("min_value"),
        s.alias("sum_value"), F.count(value).alias("n"))


def count_by(df: DataFrame, keys, alias: str = "count") -> DataFrame:
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(alias))


def histogram(df: DataFrame, keys, value: str, alias: str = "occurrences") -> DataFrame:
    """Per key, how often each value occurs: one row per (key, value).

    Counting on (key, value) first keeps every group small; the map form
    (:func:`histogram_map`) is built from these counts, so its size is the
    number of distinct values per key, never the number of rows."""
    return df.groupBy(*_keys(keys), value).agg(F.count(F.lit(1)).alias(alias))


def histogram_map(df: DataFrame, keys, value: str, alias: str = "histogram") -> DataFrame:
    counts = histogram(df, keys, value, "_n")
    return counts.groupBy(*_keys(keys)).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(value), F.col("_n")))).alias(alias))


def top_k(df: DataFrame, keys, value: str, k: int, tie_break: Sequence[str] = (),
          pos_alias: str = "pos", value_alias: str | None = None) -> DataFrame:
    """The ``k`` largest values per key, duplicates kept, as exploded rows
    (key…, pos 1..k, value).

    ``row_number() <= k`` is planned as a partial WindowGroupLimit in each map
    task, then a final one after the shuffle: at most k rows per key and map
    task cross the network, whatever the size of the key."""
    w = Window.partitionBy(*_keys(keys)).orderBy(F.col(value).desc_nulls_last(),
                                                 *[F.col(t) for t in tie_break])
    ranked = df.filter(F.col(value).isNotNull()).withColumn(pos_alias, F.row_number().over(w))
    out = ranked.filter(F.col(pos_alias) <= k)
    return out.select(*_keys(keys), F.col(pos_alias).cast("int").alias(pos_alias),
                      F.col(value).alias(value_alias or value))


def top_k_array(df: DataFrame, keys, value: str, k: int, alias: str = "topk") -> DataFrame:
    """Top-k as one array per key (the TOPK aggregate shape), built from the
    bounded :func:`top_k` rows."""
    rows = top_k(df, keys, value, k, pos_alias="_pos")
    return rows.groupBy(*_keys(keys)).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", F.col(value)))),
                    lambda e: e.getField(value)).alias(alias))


def histogram_with_total(df: DataFrame, key: str, value: str, amount: str, round_to: int = 2) -> DataFrame:
    """Per key: how often each ``value`` occurs (one row per entry) next to the
    key's total ``amount``. Totals are summed from the entries and joined back,
    one row per key, so a key's entries never have to meet in one window."""
    parts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("occurrences"), F.sum(amount).alias("_s"))
    totals = parts.groupBy(key).agg(F.round(F.sum("_s"), round_to).alias("total")).withColumnRenamed(key, "_of")
    return (parts.join(totals, F.col(key).eqNullSafe(F.col("_of")))
            .select(key, value, "occurrences", "total"))


def histogram_stream(df: DataFrame, ts: str, key: str, value: str, amount: str, size: str, round_to: int = 2) -> DataFrame:
    """Per key and window of a watermarked stream: how often each ``value``
    occurs (one row per entry) next to the key's total ``amount``. Two chained
    aggregations: (window, key, value) first, so that a key's rows are summed
    apart and in parallel, then (window, key) over one row per value. Append mode."""
    parts = (df.groupBy(F.window(F.col(ts), size).alias("_p"), key, value)
             .agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_s")))
    whole = (parts.groupBy(F.window(F.col("_p"), size).alias("_w"), key)
             .agg(F.collect_list(F.struct(value, "_n")).alias("_h"), F.round(F.sum("_s"), round_to).alias("total")))
    return (whole.select(F.col("_w.start").cast("timestamp_ntz").alias("window_start"), key, "total", F.explode("_h").alias("_e"))
            .select("window_start", key, F.col(f"_e.{value}").alias(value), F.col("_e._n").alias("occurrences"), "total"))
