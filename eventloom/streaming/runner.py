"""Start streaming queries with a checkpoint of their own and run them.

Checkpoints and sink folders live under the shared checkpoint root
(``spark.checkpoint.dir``), one folder per query name, so a restarted job on
another executor set resumes from the same offsets and state.
"""

from __future__ import annotations

import json
import threading
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from eventloom.session import _checkpoint_root, _fs

_STARTING = threading.Lock()


def checkpoint_for(spark: SparkSession, query_name: str) -> str:
    """Stable per query name (not per process), so a restarted driver
    resumes the query from its offsets and state."""
    return "/".join([_checkpoint_root(spark), "eventloom", "checkpoints", query_name])


def drop_checkpoint(spark: SparkSession, query_name: str) -> None:
    """Remove the checkpoint of a query that will not be started again."""
    path, fs = _fs(spark, checkpoint_for(spark, query_name))
    fs.delete(path, True)


def sink_path(spark: SparkSession, query_name: str) -> str:
    return "/".join([_checkpoint_root(spark), "eventloom", "sinks", query_name])


def start(df: DataFrame, query_name: str, fmt: str = "parquet",
          output_mode: str = "append", partition_by: Sequence[str] = (),
          options: Mapping[str, str] | None = None,
          foreach_batch: Callable | None = None, trigger: Mapping | None = None,
          path: str | None = None, state_partitions: int | None = None,
          settings: Mapping[str, str] | None = None) -> StreamingQuery:
    """Start ``df`` (a stream) and return its handle; it runs until it is
    stopped, or until all input is processed if the trigger is ``availableNow``.

    ``foreach_batch`` takes the place of a file sink (side effects, ``update``
    mode tables). ``state_partitions`` sets the shuffle (and state store)
    partition count that the query's checkpoint is created with, ``settings``
    other session settings that it starts with; queries that set any start one
    at a time."""
    spark = df.sparkSession
    w = df.writeStream.queryName(query_name).outputMode(output_mode) \
        .option("checkpointLocation", checkpoint_for(spark, query_name))
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt)
        if fmt not in ("memory", "noop", "console", "kafka"):
            w = w.option("path", path or sink_path(spark, query_name))
        if partition_by:
            w = w.partitionBy(*partition_by)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w = w.trigger(**dict(trigger or {"availableNow": True}))
    held = dict(settings or {})
    if state_partitions:
        held["spark.sql.shuffle.partitions"] = str(state_partitions)
    if not held:
        return w.start()
    # a query takes the settings when it starts, so the session's are held for that long only
    with _STARTING:
        before = {k: spark.conf.get(k, None) for k in held}
        for k, v in held.items():
            spark.conf.set(k, v)
        try:
            return w.start()
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class NotFinished(RuntimeError):
    """A stream was still running when its caller's limit was reached."""


class _Reports(StreamingQueryListener):
    """Every progress report of the session's streams, by run (Spark's
    ``recentProgress`` keeps only the last ones)."""

    def __init__(self):
        self.reports: dict[str, list] = defaultdict(list)
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.reports[str(event.progress.runId)].append(json.loads(event.progress.json))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended[str(event.runId)].set()


def run_available(df: DataFrame, query_name: str, timeout_s: float | None = None, path: str | None = None,
                  **kw) -> tuple[str, list]:
    """:func:`start` the stream and wait until all input available at its start
    is processed. Returns the sink path and all progress reports.

    There is no time limit unless the caller sets one; a stream that is still
    running then is stopped and :class:`NotFinished` is raised, so partial
    output is never returned as complete."""
    spark = df.sparkSession
    seen = _Reports()
    spark.streams.addListener(seen)
    try:
        q = start(df, query_name, path=path, **kw)
        try:
            ended = q.awaitTermination(timeout_s) if timeout_s is not None else (q.awaitTermination() or True)
            if q.exception() is not None:
                raise RuntimeError(f"stream {query_name} failed: {q.exception()}")
            if not ended:
                raise NotFinished(f"stream {query_name} still ran after {timeout_s} s; its output is partial")
        finally:
            if q.isActive:
                q.stop()
        run = str(q.runId)
        seen.ended[run].wait(60)  # reports are delivered in order, the end last
        return path or sink_path(spark, query_name), list(seen.reports[run])
    finally:
        spark.streams.removeListener(seen)


def run_caught_up(df: DataFrame, query_name: str, path: str | None = None, **kw) -> tuple[str, list]:
    """:func:`start` the stream, let it run batch after batch until its sources
    have nothing new, and stop it. For sources that bound a batch by what they
    admit, of which an ``availableNow`` run would take one batch only."""
    spark = df.sparkSession
    seen = _Reports()
    spark.streams.addListener(seen)
    try:
        q = start(df, query_name, path=path, trigger={"processingTime": "0 seconds"}, **kw)
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        seen.ended[str(q.runId)].wait(60)
        return path or sink_path(spark, query_name), list(seen.reports[str(q.runId)])
    finally:
        spark.streams.removeListener(seen)


def dropped_by_watermark(progress: list) -> int:
    """Rows the engine dropped as later than the watermark, summed over the
    stateful operators of all reported micro-batches. For aggregations these
    are rows at the state store's input, i.e. after the map-side partial
    aggregate, so one count can stand for several late events."""
    total = 0
    for p in progress:
        for op in p.get("stateOperators", []) or []:
            total += int(op.get("numRowsDroppedByWatermark", 0) or 0)
    return total
