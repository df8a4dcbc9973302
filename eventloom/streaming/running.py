"""Per-event running values on streams whose events come out of order.

A running sum after each event is only right once no earlier event can come,
so events wait until the watermark has passed them. Groups are (key, window).
Their state: a value (the sum so far) and a list (the events that wait). A
timer a ``granule`` of event time apart wakes a group as the watermark moves;
it applies the events that are now in order, emits them and goes back to
sleep; the last timer, at the window's end, removes the group. So the result
doesn't depend on how events fall into micro-batches, and state is bounded by
the events within the watermark's delay and granule, and by open windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

#: transformWithState keeps its state in RocksDB only.
SETTINGS = {"spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class _Running(StatefulProcessor):
    def __init__(self, size_us: int, granule_us: int):
        self.size, self.granule = size_us, granule_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "sum double, seen long, upto long")
        self.waiting = handle.getListState("waiting", "at long, tie long, value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        end = key[1] + self.size
        known = set(self.handle.listTimers())
        for pdf in rows:
            values = pdf["run_value"].astype(object).where(pdf["run_value"].notna(), None)
            self.waiting.appendList(list(zip(pdf["run_at"].tolist(), pdf["run_tie"].tolist(), values.tolist())))
            granules = ((pdf["run_at"] - key[1]) // self.granule + 1) * self.granule + key[1]
            for at in {min(int(g), end) for g in granules.unique()} | {end}:
                ms = -(-at // 1000)
                if ms not in known:
                    known.add(ms)
                    self.handle.registerTimer(ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due, end = expiredTimerInfo.getExpiryTimeInMs() * 1000, key[1] + self.size
        total, seen, done = self.total.get() if self.total.exists() else (0.0, 0, key[1])
        out = []
        if due > done:  # one timer does the work of all granules that the watermark has passed
            passed = timerValues.getCurrentWatermarkInMs() * 1000
            upto = min(end, max(due, key[1] + (passed - key[1]) // self.granule * self.granule))
            rows = sorted(self.waiting.get(), key=lambda r: (r[0], r[1])) if self.waiting.exists() else []
            later = [r for r in rows if r[0] >= upto]
            for at, tie, value in rows[:len(rows) - len(later)]:
                if value is not None:
                    total, seen = total + value, seen + 1
                out.append((key[0], key[1], at, tie, total if seen else None))
            self.total.update((total, seen, upto))
            self.waiting.put(later) if later else self.waiting.clear()
        if due >= end:
            self.total.clear()
            self.waiting.clear()
        if out:
            yield pd.DataFrame(out, columns=["key", "window_us", "at_us", "tie", "current"])

    def close(self) -> None:
        pass


def running_in_window_ordered(df: DataFrame, ts: str, key: str, value: str, tie: str, size_seconds: int,
                              granule_seconds: int, watermark: str = "10 seconds", round_to: int = 2) -> DataFrame:
    """After each event, the running sum of its key's tumbling window, events
    taken in the order of ``ts``, then ``tie`` (a whole number), however they
    arrive; later than the watermark they are dropped by the engine. Rows:
    (key, window_start, tie, ts, current), ``current`` null until the window's
    first value. Start the query with ``settings=SETTINGS``."""
    if size_seconds % granule_seconds:
        raise ValueError("the window must be a multiple of the granule")
    size_us, kind = size_seconds * 1_000_000, df.schema[key].dataType
    t = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    at = F.unix_micros(F.col(ts))
    # (names that start with "_" don't reach the processor as they are)
    t = t.filter(F.col(ts).isNotNull()).select(
        F.col(key).alias("run_key"), (at - F.pmod(at, F.lit(size_us))).alias("run_window"), at.alias("run_at"),
        F.col(tie).cast("long").alias("run_tie"), F.col(value).cast("double").alias("run_value"), ts)
    out = StructType([StructField("key", kind), StructField("window_us", LongType()), StructField("at_us", LongType()),
                      StructField("tie", LongType()), StructField("current", DoubleType())])
    res = t.groupBy("run_key", "run_window").transformWithStateInPandas(
        _Running(size_us, granule_seconds * 1_000_000), out, "Append", "EventTime")
    return res.select(F.col("key").alias(key), F.timestamp_micros("window_us").cast("timestamp_ntz").alias("window_start"),
                      F.col("tie").alias(tie), F.timestamp_micros("at_us").cast("timestamp_ntz").alias(ts),
                      F.round("current", round_to).alias("current"))
