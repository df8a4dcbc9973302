"""Sinks of the reference's pipelines, as Structured Streaming writers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.decode import json_value
from eventloom.sources.topics import to_envelope
from eventloom.streaming.runner import run_available


def keyed_json(df: DataFrame, key: str, topic: str, offset: str | Column, timestamp: str | Column | None = None,
               cols: Sequence[str] | None = None) -> DataFrame:
    """Rows as envelopes: ``key`` as text, the row (or ``cols``) as a JSON value,
    and the source's offset and time, by which the new topic can be started at
    a position."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    msgs = df.select(F.col(key).cast("string").alias("key"), json_value(cols or df.columns).alias("value"),
                     col(offset).cast("long").alias("_offset"),
                     *([] if timestamp is None else [col(timestamp).alias("_time")]))
    return to_envelope(msgs, topic, "value", key="key", offset="_offset",
                       **({} if timestamp is None else {"timestamp": "_time"}))


def to_topic(df: DataFrame, path: str, query_name: str,
             kafka_options: Mapping[str, str] | None = None, trigger=None, **kw):
    """Stream envelopes (key, value, topic …) into a topic with a checkpoint."""
    if kafka_options is not None:
        return run_available(df.select("key", "value", "topic"), query_name, fmt="kafka",
                             options=kafka_options, trigger=trigger, **kw)
    return run_available(df, query_name, fmt="parquet", partition_by=("topic",),
                         path=path, trigger=trigger, **kw)


def console_batches(df: DataFrame, query_name: str, counts: str, num_rows: int = 20, trigger=None, **kw):
    """Print each micro-batch like the console sink, but only ``num_rows`` rows
    reach the driver. The batch is kept while it is shown and counted, so it is
    computed once; its row count is written to ``counts`` under its batch id,
    so a replayed batch replaces its count."""
    def show(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            batch.show(num_rows, truncate=False)
            (batch.agg(F.count(F.lit(1)).alias("rows"))
             .write.mode("overwrite").parquet(f"{counts}/batch_id={batch_id}"))
        finally:
            batch.unpersist()

    return run_available(df, query_name, foreach_batch=show, trigger=trigger, **kw)


def to_csv(df: DataFrame, query_name: str, options: Mapping[str, str] | None = None,
           trigger=None, **kw):
    """CSV files per micro-batch with a checkpoint (processingTime triggers on
    a cluster, availableNow in tests)."""
    return run_available(df, query_name, fmt="csv", options=options, trigger=trigger, **kw)


def for_each_batch(df: DataFrame, query_name: str, fn: Callable[[DataFrame, int], None],
                   trigger=None, **kw):
    """Side effect per micro-batch; ``fn`` gets the batch DataFrame and id and
    must be idempotent per id (a batch can be replayed after a failure)."""
    return run_available(df, query_name, foreach_batch=fn, trigger=trigger, **kw)
