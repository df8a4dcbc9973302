"""Custom stateful streaming operators (``applyInPandasWithState``).

Only two operators need them: a running top-k whose state is bounded by k
per key (a ``collect_list`` aggregate would keep every value of a key), and
the per-event running value of a window, which Spark's window functions
cannot produce on a stream. State keeps times as long microseconds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType,
                               StructField, StructType)


def top_k_stream(df: DataFrame, key: str, value: str, k: int, ts: str | None = None,
                 window_seconds: int | None = None, watermark: str = "0 seconds") -> DataFrame:
    """Running top-k per key (or per key and tumbling window): after each
    micro-batch, every group that received values emits its current top k as
    rows (key[, window_start], version, pos, value), where ``version`` is the
    number of values seen; readers keep the highest version per group. State
    per group is at most k values plus a counter; windowed groups are dropped
    by an event-time timeout once the watermark passes the window end."""
    windowed = window_seconds is not None
    src = df
    group = [key]
    if windowed:
        if dict(df.dtypes)[ts] == "timestamp_ntz":
            src = src.withColumn(ts, F.col(ts).cast("timestamp"))
        size_us = window_seconds * 1_000_000
        src = (src.withWatermark(ts, watermark)
               .withColumn("_t_us", F.unix_micros(F.col(ts)))
               .withColumn("_w_us", F.col("_t_us") - F.pmod(F.col("_t_us"), F.lit(size_us))))
        group = [key, "_w_us"]
    key_type = dict((f.name, f.dataType) for f in df.schema.fields)[key]
    out_fields = [StructField(key, key_type)]
    if windowed:
        out_fields.append(StructField("window_start_us", LongType()))
    out_schema = StructType(out_fields + [StructField("version", LongType()),
                                          StructField("pos", IntegerType()), StructField(value, DoubleType())])
    state_schema = StructType([StructField("vals", ArrayType(DoubleType())),
                               StructField("seen", LongType())])

    def step(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        vals = np.array(state.get[0] if state.exists else [], dtype="float64")
        seen = int(state.get[1]) if state.exists else 0
        for pdf in batches:
            v = pdf[value].dropna().to_numpy(dtype="float64")
            seen += len(v)
            both = np.concatenate([vals, v])
            # keep the k largest (a partial selection, not a full sort)
            if len(both) > k:
                both = both[np.argpartition(-both, k - 1)[:k]]
            vals = both
        vals = np.sort(vals)[::-1]
        state.update((vals.tolist(), seen))
        if windowed:
            state.setTimeoutTimestamp(int((keys[1] + window_seconds * 1_000_000) // 1000) + 1)
        out = {key: [keys[0]] * len(vals)}
        if windowed:
            out["window_start_us"] = [keys[1]] * len(vals)
        out.update({"version": [seen] * len(vals),
                    "pos": np.arange(1, len(vals) + 1, dtype="int32"), value: vals})
        yield pd.DataFrame(out)

    cols = [*group, F.col(value).cast("double").alias(value)] + ([ts] if windowed else [])
    timeout = GroupStateTimeout.EventTimeTimeout if windowed else GroupStateTimeout.NoTimeout
    res = (src.select(*cols).groupBy(*group)
           .applyInPandasWithState(step, out_schema, state_schema, "update", timeout))
    if windowed:
        res = res.select(key, F.timestamp_micros("window_start_us").cast("timestamp_ntz").alias("window_start"),
                         "version", "pos", value)
    return res


def running_in_window_stream(df: DataFrame, ts: str, key: str, value: str, size_seconds: int,
                             tie_break: Sequence[str], watermark: str = "0 seconds",
                             slide_seconds: int | None = None) -> DataFrame:
    """Per event, the running sum of its key's tumbling window so far (with
    ``slide_seconds``: of each hopping window the event falls in).

    Groups are (key, window start); the state is one running sum, dropped by
    an event-time timeout when the watermark passes the window end. Within a
    micro-batch, events are applied in (ts, tie-break) order, which needs one
    group's rows of that micro-batch in memory at once: bound them with the
    source's per-trigger limit (``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``)."""
    tie = list(tie_break)
    size_us = size_seconds * 1_000_000
    t = df
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        t = t.withColumn(ts, F.col(ts).cast("timestamp"))
    t = t.withWatermark(ts, watermark)
    t = t.withColumn("_t_us", F.unix_micros(F.col(ts)))
    if slide_seconds is None:
        t = t.withColumn("_w_us", F.col("_t_us") - F.pmod(F.col("_t_us"), F.lit(size_us)))
    else:
        # hopping: one row per window the event falls in
        slide_us = slide_seconds * 1_000_000
        last = F.col("_t_us") - F.pmod(F.col("_t_us"), F.lit(slide_us))
        starts = F.transform(F.sequence(F.lit(0), F.lit(size_seconds // slide_seconds - 1)),
                             lambda k: last - k.cast("long") * slide_us)
        t = t.withColumn("_w_us", F.explode(starts))
    fields = [StructField(key, df.schema[key].dataType), StructField("window_start_us", LongType()),
              *[StructField(c, df.schema[c].dataType) for c in tie],
              StructField("event_us", LongType()), StructField("current", DoubleType())]
    out_schema = StructType(fields)
    state_schema = StructType([StructField("total", DoubleType())])

    def step(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        total = float(state.get[0]) if state.exists else 0.0
        pdf = pd.concat(list(batches), ignore_index=True)
        pdf = pdf.sort_values(["_t_us", *tie], kind="mergesort")
        cum = total + pdf[value].fillna(0.0).cumsum().to_numpy()
        state.update((float(cum[-1]),))
        state.setTimeoutTimestamp(int((keys[1] + size_us) // 1000) + 1)
        out = pd.DataFrame({key: pdf[key].to_numpy(), "window_start_us": pdf["_w_us"].to_numpy()})
        for c in tie:
            out[c] = pdf[c].to_numpy()
        out["event_us"] = pdf["_t_us"].to_numpy()
        out["current"] = cum
        yield out

    cols = [key, "_w_us", "_t_us", value, *tie, ts]
    res = (t.select(*cols).groupBy(key, "_w_us")
           .applyInPandasWithState(step, out_schema, state_schema, "append",
                                   GroupStateTimeout.EventTimeTimeout))
    return res.select(
        key, F.timestamp_micros("window_start_us").cast("timestamp_ntz").alias("window_start"),
        *tie, F.timestamp_micros("event_us").cast("timestamp_ntz").alias(ts),
        F.round("current", 2).alias("current"))
