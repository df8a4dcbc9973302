"""Equi joins for stream–stream, stream–table and table–table inputs.

The join type is always explicit. A side whose files are small is broadcast;
the size is read from the file listing, so no job runs while a plan is built.
All other joins are left to the engine, which decides from its own estimates,
re-decides with runtime sizes, and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.session import _fs

_STREAM_STATIC_OK = {
    # (left is stream, right is stream) -> allowed join types
    (True, False): {"inner", "left", "left_outer", "left_semi", "left_anti"},
    (False, True): {"inner", "right", "right_outer"},
}


class JoinNotSupported(ValueError):
    pass


def join(left: DataFrame, right: DataFrame, on, how: str,
         left_watermark: tuple[str, str] | None = None,
         right_watermark: tuple[str, str] | None = None,
         time_bound: Column | None = None) -> DataFrame:
    """Join with an explicit type.

    Stream–table joins that Spark cannot run incrementally (full outer, or
    outer on the table side) are refused here, before any query starts.
    Stream–stream outer joins need watermarks on both sides plus a time bound
    so that unmatched rows can be emitted and state dropped; inner stream–stream
    joins accept them optionally to bound state.
    """
    if how is None:
        raise ValueError("how must be given")
    ls, rs = left.isStreaming, right.isStreaming
    if ls != rs:
        allowed = _STREAM_STATIC_OK[(ls, rs)]
        if how not in allowed:
            raise JoinNotSupported(
                f"{how} join between a stream and a table is not supported; "
                f"allowed: {sorted(allowed)}")
    if ls and rs and how not in ("inner",) and (
            left_watermark is None or right_watermark is None or time_bound is None):
        raise JoinNotSupported(
            "outer stream-stream joins need watermarks on both sides and a time bound")
    if ls and not rs:
        right = broadcast_if_small(right)
    elif rs and not ls:
        left = broadcast_if_small(left)
    if left_watermark is not None and ls:
        left = left.withWatermark(*left_watermark)
    if right_watermark is not None and rs:
        right = right.withWatermark(*right_watermark)
    cond = on
    if time_bound is not None:
        cond = (on & time_bound) if isinstance(on, Column) else time_bound
    return left.join(right, cond, how)


def broadcast_if_small(df: DataFrame, max_file_bytes: int = 8 << 20) -> DataFrame:
    """Hint a broadcast of a table whose files sum to at most ``max_file_bytes``.

    Only file metadata is read. A table that is not read from files is
    returned unchanged, and the engine decides."""
    if df.isStreaming:
        return df
    files = df.inputFiles()
    if not files:
        return df
    spark, total = df.sparkSession, 0
    for f in files:
        p, fs = _fs(spark, f)
        total += int(fs.getFileStatus(p).getLen())
        if total > max_file_bytes:
            return df
    return F.broadcast(df)


def split_known(events: DataFrame, known: DataFrame, event_key: str,
                known_key: str) -> tuple[DataFrame, DataFrame]:
    """Events whose key exists in ``known`` and the rejects whose key does not
    (semi / anti joins: no columns of ``known`` are carried)."""
    cond = events[event_key] == known[known_key]
    keys = broadcast_if_small(known.select(known_key))
    return (events.join(keys, cond, "left_semi"),
            events.join(keys, cond, "left_anti"))
