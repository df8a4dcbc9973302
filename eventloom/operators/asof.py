"""Joins with a table as it stood at each event's time.

The table is given by its changes: a row per new value of a key, with the time
from which it holds (a flag may mark deletions). Every event meets the last
change of its key at or before its own time. No pair of events and changes is
formed: both sides are put in one order of time and the last change is carried
along it. A key's history is cut into time buckets, which are separate groups;
a bucket that starts before its first change takes the value that the key's
earlier buckets ended with, found from one row per key and bucket. So a key
that holds much of the data is spread over as many tasks as it has buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.operators.windows import _seconds, bucket_start
from eventloom.streaming.sinks import for_each_batch


def as_of(events: DataFrame, changes: DataFrame, keys: Sequence[str] | str, event_time: str, change_time: str,
          cols: Sequence[str], how: str = "left", tie_break: Sequence[str] = (), deleted: Column | None = None,
          bucket: str = "1 day") -> DataFrame:
    """Events with ``cols`` of the change that holds at their time.

    ``keys``: columns of that name on both sides. A change counts from its own
    time on, that time included; of changes of one key at one time the last by
    ``tie_break`` (columns of the changes) holds. ``deleted``: a condition on
    changes that end a key's value. ``inner`` drops the events without a value,
    ``left`` keeps them with nulls. Events with a null key or time have none;
    changes with a null key or time are never met. Repeated events each give a
    row. ``bucket``: the length of a group; it changes nothing in the result."""
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    ks = [keys] if isinstance(keys, str) else list(keys)
    if clash := set(cols) & set(events.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}; rename them first")
    known = F.lit(True)
    for k in ks:
        known = known & F.col(k).isNotNull()
    timed = known & F.col(event_time).isNotNull()

    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    held = F.struct(gone.alias("_gone"), *[F.col(c) for c in cols])
    ties = F.struct(F.lit(0).alias("_0"), *[F.col(t).alias(f"_t{i}") for i, t in enumerate(tie_break)])
    c = (changes.filter(known & F.col(change_time).isNotNull())
         .select(*ks, F.col(change_time).alias("_at"), F.lit(0).alias("_side"), ties.alias("_tie"), held.alias("_held")))
    row = F.struct(*[F.col(f"`{x}`") for x in events.columns])
    e = (events.filter(timed).select(*ks, F.col(event_time).alias("_at"), F.lit(1).alias("_side"), row.alias("_row")))
    both = c.unionByName(e, allowMissingColumns=True)
    both = both.withColumn("_bucket", bucket_start(both, "_at", _seconds(bucket)))

    inside = (Window.partitionBy(*ks, "_bucket").orderBy("_at", "_side", "_tie")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = both.withColumn("_last", F.last("_held", ignorenulls=True).over(inside)).filter("_side = 1")
    ends = both.groupBy(*ks, "_bucket").agg(
        F.max_by("_held", F.when(F.col("_held").isNotNull(), F.struct("_at", "_tie"))).alias("_end"))
    before = Window.partitionBy(*ks).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (ends.withColumn("_carry", F.last("_end", ignorenulls=True).over(before))
               .filter("_carry is not null").select(*ks, "_bucket", "_carry"))
    out = met.join(carried, [*ks, "_bucket"], "left")
    value = F.coalesce("_last", "_carry")
    holds = value.isNotNull() & ~value["_gone"]
    out = out.select("_row.*", *[F.when(holds, value[x]).alias(x) for x in cols], holds.alias("_holds"))
    if how == "inner":
        return out.filter("_holds").drop("_holds")
    # events without a key or time meet nothing, so they aren't grouped
    types = dict(changes.select(*cols).dtypes)
    rest = events.filter(~F.coalesce(timed, F.lit(False))).select(
        *[F.col(f"`{x}`") for x in events.columns], *[F.lit(None).cast(types[x]).alias(x) for x in cols], F.lit(False).alias("_holds"))
    return out.unionByName(rest).drop("_holds")


def stream_as_of(events: DataFrame, changes: Callable[[], DataFrame], query_name: str, path: str, *args,
                 **kw) -> tuple[str, list]:
    """:func:`as_of` for a stream of events and a table that changes while it
    runs: each micro-batch meets the changes as ``changes()`` reads them then.
    A batch is written under its id, so one that runs again replaces itself.
    (An event that arrives before a change of an earlier time has been stored
    meets the value known by then.)"""
    run = {k: kw.pop(k) for k in ("trigger", "state_partitions", "timeout_s") if k in kw}

    def meet(batch: DataFrame, batch_id: int) -> None:
        as_of(batch, changes(), *args, **kw).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return for_each_batch(events, query_name, meet, **run)
