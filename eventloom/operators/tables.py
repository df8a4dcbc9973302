"""Tables derived from changelogs: latest value per key, compaction,
filtered tables, train positions and the station status board."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.scalars import line_of, status_text
from eventloom.operators.aggregates import _keys


def latest(df: DataFrame, keys, order: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """The latest record per key (a table, not a stream): ``max_by`` over the
    record, ordered by ``order`` (e.g. time, then offset for ties).

    ``max_by`` aggregates partially before the shuffle; on a stream it runs in
    ``update`` mode and each output replaces the previous row of its key."""
    ks = [str(k) for k in _keys(keys)]
    vals = list(cols) if cols is not None else [c for c in df.columns if c not in ks]
    g = df.groupBy(*ks).agg(F.max_by(F.struct(*vals), F.struct(*order)).alias("_r"))
    return g.select(*ks, *[F.col("_r").getField(c).alias(c) for c in vals])


def compact(df: DataFrame, keys, order: Sequence[str], value_col: str,
            cols: Sequence[str] | None = None) -> DataFrame:
    """Compacted topic: the last record per key; a key whose last value is
    null (a tombstone) is deleted."""
    return latest(df, keys, order, cols).filter(F.col(value_col).isNotNull())


def latest_where(df: DataFrame, keys, order: Sequence[str], cond: Column,
                 cols: Sequence[str] | None = None) -> DataFrame:
    """Table derived by a predicate: the predicate applies to each key's latest
    row (a key whose latest row fails it leaves the table)."""
    return latest(df, keys, order, cols).filter(cond)


def latest_global(df: DataFrame, order: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """One row: the latest reading, with defaults for fields never seen."""
    names = list(defaults)
    g = df.agg(F.max_by(F.struct(*names), F.struct(*order)).alias("_r"))
    return g.select(*[F.coalesce(F.col("_r").getField(n), F.lit(v)).alias(n)
                      for n, v in defaults.items()])


def transform_stations(stations: DataFrame) -> DataFrame:
    """Station rows → (station_id, station_name, order, line); the line is the
    first set flag of red, blue, green. One row per station_id (the latest
    by stop_id when a station has several stops)."""
    t = stations.select("station_id", "station_name", "order",
                        line_of("red", "blue", "green").alias("line"), "stop_id")
    return latest(t, "station_id", ["stop_id"], ["station_name", "order", "line"])


def _direction(c) -> Column:
    # Any direction other than "a" counts as "b".
    return F.when(F.col(c) == "a", F.lit("a")).otherwise(F.lit("b"))


def platform_updates(arrivals: DataFrame, ts: str, tie_break: str,
                     by_line: bool = True) -> DataFrame:
    """Arrivals as platform updates: an arrival first clears the platform it
    came from (previous station and direction, when both are known), then
    fills its own. Each arrival becomes up to two updates (clear: seq 0,
    set: seq 1) in one narrow pass; any direction but "a" counts as "b"."""
    line = [F.col("line").alias("line")] if by_line else []
    has_prev = F.col("prev_station_id").isNotNull() & F.col("prev_direction").isNotNull()
    clear = F.when(has_prev, F.struct(
        *line, F.col("prev_station_id").alias("station_id"),
        _direction("prev_direction").alias("direction"),
        F.lit(None).cast("string").alias("train_id"),
        F.lit(None).cast("string").alias("train_status"),
        F.col(ts).alias(ts), F.col(tie_break).alias(tie_break), F.lit(0).alias("seq")))
    put = F.struct(*line, F.col("station_id").alias("station_id"),
                   _direction("direction").alias("direction"),
                   F.col("train_id").alias("train_id"), F.col("train_status").alias("train_status"),
                   F.col(ts).alias(ts), F.col(tie_break).alias(tie_break), F.lit(1).alias("seq"))
    updates = arrivals.select(F.inline(F.filter(F.array(clear, put), lambda u: u.isNotNull())))
    return updates


def train_positions(arrivals: DataFrame, ts: str, tie_break: str,
                    by_line: bool = True, keep_order: bool = False) -> DataFrame:
    """Which train stands at each (line, station, direction): the latest
    platform update by (time, tie, seq); a cleared platform keeps a null
    train. On a stream, feed :func:`platform_updates` to a latest-value table
    instead (``streaming.tables.upsert_latest``)."""
    updates = platform_updates(arrivals, ts, tie_break, by_line)
    keys = (["line"] if by_line else []) + ["station_id", "direction"]
    # keep_order: also return the winning update's order, so the repeated
    # rows of a stream's update-mode output can be folded into the table
    extra = [ts, tie_break, "seq"] if keep_order else []
    return latest(updates, keys, [ts, tie_break, "seq"], ["train_id", "train_status", *extra])


# The lines the status board knows, in display order.
LINES = ("blue", "green", "red")


def route_by_topic(bus: DataFrame, station_topic_marker: str, summary_topic: str,
                   line_col: str = "line") -> DataFrame:
    """Route messages of a multi-topic bus to lines.

    Station and arrival messages (topic contains the marker) go to the line
    named in the message; unknown lines are discarded. Summary messages go to
    every line. Messages of other topics are ignored."""
    lines = F.array(*[F.lit(x) for x in LINES])
    kind = (F.when(F.col("topic").contains(station_topic_marker), F.lit("station"))
            .when(F.col("topic") == summary_topic, F.lit("summary")))
    routed = bus.withColumn("_kind", kind).filter(F.col("_kind").isNotNull())
    dest = F.when(F.col("_kind") == "summary", lines) \
        .otherwise(F.when(F.array_contains(lines, F.col(line_col)), F.array(F.col(line_col))))
    out = routed.withColumn("route_line", F.explode(dest))
    return out.drop("_kind")


def status_board(stations: DataFrame, positions: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per station on a known line: line, station, the trains on
    platforms a and b with their status text, and the turnstile entries.

    Positions are pivoted on the two known directions by conditional
    aggregation (no data-dependent pivot values)."""
    pos = positions.groupBy("line", "station_id").agg(
        F.max(F.when(F.col("direction") == "a", F.col("train_id"))).alias("train_a"),
        F.max(F.when(F.col("direction") == "a", F.col("train_status"))).alias("_sa"),
        F.max(F.when(F.col("direction") == "b", F.col("train_id"))).alias("train_b"),
        F.max(F.when(F.col("direction") == "b", F.col("train_status"))).alias("_sb"))
    st = stations.filter(F.col("line").isin(list(LINES)))
    board = (st.join(pos, ["line", "station_id"], "left")
             .join(entries.select("station_id", F.col("count").alias("entries")),
                   "station_id", "left"))
    return board.select(
        "line", "station_id", "station_name", "order",
        F.coalesce("train_a", F.lit("---")).alias("train_a"),
        F.when(F.col("train_a").isNotNull(), status_text("_sa")).otherwise(F.lit("---")).alias("status_a"),
        F.coalesce("train_b", F.lit("---")).alias("train_b"),
        F.when(F.col("train_b").isNotNull(), status_text("_sb")).otherwise(F.lit("---")).alias("status_b"),
        F.coalesce("entries", F.lit(0)).cast("long").alias("entries")
    ).orderBy("line", "order", "station_id")  # display order: line, then order on the line
