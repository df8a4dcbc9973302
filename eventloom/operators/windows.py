"""Event-time windows: tumbling, hopping, session, window tags, running
values and late-data handling. Window bounds come out as ``window_start`` /
``window_end`` columns of the event-time type of the input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.operators.aggregates import _keys


def event_time(df: DataFrame, ts: str, watermark: str | None = None) -> DataFrame:
    """Prepare the event-time column. Streams need a TIMESTAMP (watermarks
    refuse TIMESTAMP_NTZ), so a stream's ``ts`` is cast and watermarked."""
    if watermark is None:
        return df
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, watermark)


def _bounds(w: Column, ntz: bool) -> list:
    s, e = w.getField("start"), w.getField("end")
    if ntz:
        s, e = s.cast("timestamp_ntz"), e.cast("timestamp_ntz")
    return [s.alias("window_start"), e.alias("window_end")]


def windowed_agg(df: DataFrame, ts: str, keys, aggs: Sequence[Column], size: str,
                 slide: str | None = None, ntz_out: bool = True) -> DataFrame:
    """Aggregate per key per tumbling (``slide`` None) or hopping window."""
    w = F.window(F.col(ts), size, slide) if slide else F.window(F.col(ts), size)
    g = df.groupBy(w.alias("_w"), *_keys(keys)).agg(*aggs)
    return g.select(*_bounds(F.col("_w"), ntz_out), *_keys(keys),
                    *[c for c in g.columns if c not in ("_w", *map(str, _keys(keys)))])


def tumbling_sum(df, ts, keys, value, size, alias="total", round_to=2):
    return windowed_agg(df, ts, keys, [F.round(F.sum(value), round_to).alias(alias)], size)


def hopping_sum(df, ts, keys, value, size, slide, alias="total", round_to=2, panes=False):
    """Sum per key per hopping window. ``panes``: aggregate per slide-sized
    pane first and build each window from its panes, so every pane is
    shuffled once instead of once per window it belongs to (for dense
    streams); the size must be a multiple of the slide."""
    if not panes:
        return windowed_agg(df, ts, keys, [F.round(F.sum(value), round_to).alias(alias)], size, slide)
    return _from_panes(df, ts, keys, size, slide, F.sum(value), lambda c: F.round(F.sum(c), round_to), alias)


def hopping_count(df, ts, keys, size, slide, alias="n", panes=False):
    """Events per key per hopping window (``panes`` as in :func:`hopping_sum`)."""
    if not panes:
        return windowed_agg(df, ts, keys, [F.count(F.lit(1)).alias(alias)], size, slide)
    return _from_panes(df, ts, keys, size, slide, F.count(F.lit(1)), lambda c: F.sum(c).cast("long"), alias)


def hopping_sum_stream(df, ts, keys, value, size, slide, alias="total", round_to=2, ntz_out: bool = True) -> DataFrame:
    """Sum per key per hopping window of a watermarked stream, as two chained
    aggregations: panes as long as the slide first, then windows of panes. A
    row reaches one pane, and only closed panes (one row each) go on to the
    windows they belong to. Append mode."""
    ks = [str(k) for k in _keys(keys)]
    panes = df.groupBy(F.window(F.col(ts), slide).alias("_p"), *ks).agg(F.sum(value).alias("_s"))
    w = panes.groupBy(F.window(F.col("_p"), size, slide).alias("_w"), *ks).agg(F.round(F.sum("_s"), round_to).alias(alias))
    return w.select(*_bounds(F.col("_w"), ntz_out), *ks, alias)


def _from_panes(df, ts, keys, size, slide, pane_agg: Column, combine, alias):
    ks = [str(k) for k in _keys(keys)]
    size_s, slide_s = _seconds(size), _seconds(slide)
    if size_s % slide_s:
        raise ValueError("pane aggregation needs size to be a multiple of slide")
    ntz = dict(df.dtypes)[ts] == "timestamp_ntz"
    p = (df.groupBy(*ks, F.window(F.col(ts), slide).getField("start").alias("_pane"))
         .agg(pane_agg.alias("_p")))
    starts = F.transform(F.sequence(F.lit(0), F.lit(size_s // slide_s - 1)),
                         lambda k: F.col("_pane") - F.make_dt_interval(secs=k * slide_s))
    w = p.select(*ks, "_p", F.explode(starts).alias("window_start"))
    g = w.groupBy("window_start", *ks).agg(combine(F.col("_p")).alias(alias))
    start = F.col("window_start")
    end = start + F.make_dt_interval(secs=F.lit(size_s))
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    return g.select(start.alias("window_start"), end.alias("window_end"), *ks, alias)


def _seconds(interval: str) -> int:
    n, unit = interval.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
            "day": 86400, "days": 86400}[unit]
    return int(n) * mult


def bucket_start(df: DataFrame, ts: str, seconds: int) -> Column:
    """Start of the ``seconds`` wide bucket that holds ``ts``, of its own type.
    Plain arithmetic: unlike ``window`` it keeps rows whose time is null."""
    t = F.col(ts)
    width = seconds * 1_000_000
    start = F.timestamp_micros(F.floor(F.unix_micros(t.cast("timestamp")) / width).cast("long") * width)
    return start.cast(dict(df.dtypes)[ts])


def assign_window(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Tag every event with its tumbling window; no aggregation. Rows without
    an event time stay, with null bounds."""
    seconds = _seconds(size)
    start = bucket_start(df, ts, seconds)
    return df.select(*df.columns, start.alias("window_start"),
                     (start + F.make_dt_interval(secs=F.lit(seconds))).alias("window_end"))


def session_agg(df: DataFrame, ts: str, keys, gap: str, aggs: Sequence[Column],
                ntz_out: bool = True) -> DataFrame:
    """Sessions per key that close after ``gap`` without events (Spark's
    session windows; works on streams). For large batch inputs with hot keys
    use :func:`sessions_bucketed`."""
    sw = F.session_window(F.col(ts), gap)
    g = df.groupBy(*_keys(keys), sw.alias("_s")).agg(*aggs)
    s, e = F.col("_s.start"), F.col("_s.end")
    if ntz_out:
        s, e = s.cast("timestamp_ntz"), e.cast("timestamp_ntz")
    return g.select(*_keys(keys), s.alias("session_start"), e.alias("session_end"),
                    *[c for c in g.columns if c not in ("_s", *map(str, _keys(keys)))])


def windowed_top_k(df: DataFrame, ts: str, keys, value: str, k: int, size: str,
                   tie_break: Sequence[str] = ()) -> DataFrame:
    """Top-k values per key within each tumbling window, exploded."""
    from eventloom.operators.aggregates import top_k
    tagged = assign_window(df, ts, size)
    return top_k(tagged, ["window_start", "window_end", *_keys(keys)], value, k, tie_break)


def running_in_window(df: DataFrame, ts: str, keys, value: str, size: str,
                      tie_break: Sequence[str] = (), alias: str = "current",
                      round_to: int = 2, slide: str | None = None,
                      split: str | None = None) -> DataFrame:
    """After each event, the running sum of its own tumbling window (the value
    a windowed table shows right after the event); with ``slide``, one row per
    hopping window the event falls in. Window partitions are one key's events
    within one window, so they stay bounded by the window size; with ``split``
    (e.g. "10 seconds") they are cut further into sub-buckets summed in
    parallel, so even a hot key's window is not one sort."""
    if slide is None:
        tagged = assign_window(df, ts, size)
    else:
        ntz = dict(df.dtypes)[ts] == "timestamp_ntz"
        tagged = df.withColumn("_w", F.window(F.col(ts), size, slide)) \
            .select(*df.columns, *_bounds(F.col("_w"), ntz))
    if split is None:
        w = (Window.partitionBy(*_keys(keys), "window_start")
             .orderBy(F.col(ts), *[F.col(t) for t in tie_break])
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return tagged.withColumn(alias, F.round(F.sum(value).over(w), round_to))
    # Parallel prefix sum: running sums inside (key, window, sub-bucket)
    # groups, plus the total of the window's earlier sub-buckets.
    ks = [str(k) for k in _keys(keys)]
    sub = tagged.withColumn("_sub", bucket_start(tagged, ts, _seconds(split)))
    w_in = (Window.partitionBy(*ks, "window_start", "_sub")
            .orderBy(F.col(ts), *[F.col(t) for t in tie_break])
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = sub.withColumn("_run", F.sum(value).over(w_in))
    totals = sub.groupBy(*ks, "window_start", "_sub").agg(F.sum(value).alias("_tot"))
    w_sub = (Window.partitionBy(*ks, "window_start").orderBy("_sub")
             .rowsBetween(Window.unboundedPreceding, -1))
    before = totals.select(*ks, "window_start", "_sub", F.sum("_tot").over(w_sub).alias("_before"))
    out = _join_null_safe(inner, before, [*ks, "window_start", "_sub"])
    # null until the window's first value, as in the plain form
    total = F.coalesce(F.col("_before") + F.col("_run"), F.col("_run"), F.col("_before"))
    return out.select(*tagged.columns, F.round(total, round_to).alias(alias))


def _join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on ``on`` in which null meets null; key columns come from the left."""
    r = right.select(*[F.col(c).alias(f"_on_{i}") for i, c in enumerate(on)],
                     *[c for c in right.columns if c not in on])
    cond = None
    for i, c in enumerate(on):
        t = left[c].eqNullSafe(r[f"_on_{i}"])
        cond = t if cond is None else cond & t
    return left.join(r, cond, "left").drop(*[f"_on_{i}" for i in range(len(on))])


def closed_windows(windows: DataFrame, max_event_time: Column, delay_seconds: int,
                   end_col: str = "window_end") -> DataFrame:
    """Batch twin of append-mode output: keep only windows the watermark
    (latest event time minus the delay) has closed."""
    return windows.filter(F.col(end_col) <= max_event_time - F.expr(f"INTERVAL {delay_seconds} SECONDS"))


def previous_in_key(df: DataFrame, keys, ts: str, tie_break: Sequence[str],
                    cols: Sequence[str], prefix: str = "prev_",
                    bucket: str = "1 day") -> DataFrame:
    """For each row, the ``cols`` of the row before it in the same key, ordered
    by ``ts`` then ``tie_break`` (``lag``), computed so that one key is never
    one task.

    Rows are cut into (key, time bucket) groups; ``lag`` runs inside each
    group. The first row of a group takes the last row of the key's previous
    non-empty bucket, found from one partial-aggregated row per (key, bucket).
    The result is exactly a lag over the whole key.
    """
    ks = [str(k) for k in _keys(keys)]
    order = [F.col(ts), *[F.col(t) for t in tie_break]]
    b = df.withColumn("_bucket", bucket_start(df, ts, _seconds(bucket)))
    w_in = Window.partitionBy(*ks, "_bucket").orderBy(*order)
    inner = b.select(*b.columns, *[F.lag(c).over(w_in).alias(prefix + c) for c in cols],
                     (F.row_number().over(w_in) == 1).alias("_first"))
    last = (b.groupBy(*ks, "_bucket")
            .agg(F.max_by(F.struct(*cols), F.struct(*[ts, *tie_break])).alias("_last")))
    w_b = Window.partitionBy(*ks).orderBy("_bucket")
    carry = last.select(*ks, "_bucket", F.lag("_last").over(w_b).alias("_carry"))
    joined = _join_null_safe(inner, carry, [*ks, "_bucket"])
    out_cols = [F.col(c) for c in df.columns]
    for c in cols:
        out_cols.append(F.when(F.col("_first"), F.col("_carry").getField(c))
                        .otherwise(F.col(prefix + c)).alias(prefix + c))
    return joined.select(*out_cols)


def sessions_bucketed(df: DataFrame, ts: str, keys, gap_seconds: int, ntz_out: bool = True) -> DataFrame:
    """Batch sessions per key (start, end = last event + gap, event count),
    exact, without putting all events of one key into one task.

    Events of one key inside one gap-wide bucket are closer than the gap, so
    they always share a session: they are pre-aggregated to (first, last,
    count), which combines map-side. Sessions are then runs of a key's buckets
    whose distance is at most the gap; a key brings at most one row per
    gap-wide bucket to that step, however many events it has. Rows without an
    event time belong to no session.
    """
    ks = [str(k) for k in _keys(keys)]
    timed = df.filter(F.col(ts).isNotNull())
    p = (timed.groupBy(*ks, bucket_start(timed, ts, gap_seconds).alias("_b"))
         .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("n")))
    gap = F.make_dt_interval(secs=F.lit(gap_seconds))
    wk = Window.partitionBy(*ks).orderBy("_b")
    new = F.when(F.col("_first") <= F.lag("_last").over(wk) + gap, 0).otherwise(1)
    runs = (p.withColumn("_new", new)
            .withColumn("_g", F.sum("_new").over(wk.rowsBetween(Window.unboundedPreceding, 0))))
    out = runs.groupBy(*ks, "_g").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"),
                                      F.sum("n").alias("n"))
    s, e = F.col("_first"), F.col("_last") + gap
    if ntz_out:
        s, e = s.cast("timestamp_ntz"), e.cast("timestamp_ntz")
    return out.select(*ks, s.alias("session_start"), e.alias("session_end"), F.col("n").cast("long").alias("n"))
