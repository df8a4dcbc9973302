"""As-of joins against a plain search of each key's history."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators import asof as AO


def at(minutes):
    return None if minutes is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def tables(seed=1):
    r = random.Random(seed)
    key = lambda: r.choice(["hot"] * 6 + ["a", "b", "c", None])
    events = [(i, key(), at(r.choice([None, r.randint(0, 9000)]) if i % 17 == 0 else r.randint(0, 9000))) for i in range(400)]
    events += events[:5]
    changes = [(key(), at(r.randint(500, 8000) // 30 * 30 if i % 19 else None), r.choice([None, i / 2]), i, i % 7 == 0) for i in range(150)]
    return events, changes


def plain(events, changes, how, deletes=True):
    out = []
    for i, k, t in events:
        past = [(c[1], c[3], c) for c in changes if k is not None and t is not None and c[0] == k and c[1] is not None and c[1] <= t]
        last = max(past)[2] if past else None
        if last is not None and deletes and last[4]:
            last = None
        if last is not None:
            out.append((i, k, t, last[1], last[2]))
        elif how == "left":
            out.append((i, k, t, None, None))
    return sorted(out, key=str)


def frames(spark, events, changes):
    return (spark.createDataFrame(events, "id long, k string, t timestamp_ntz"),
            spark.createDataFrame(changes, "k string, since timestamp_ntz, v double, seq long, gone boolean"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("bucket", ["1 minute", "7 hours", "1000 days"])
def test_as_of_equals_a_search_of_the_history(spark, how, bucket):
    events, changes = tables()
    e, c = frames(spark, events, changes)
    got = AO.as_of(e, c, "k", "t", "since", ["since", "v"], how, ["seq"], F.col("gone"), bucket)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(events, changes, how)
    got = AO.as_of(e, c, ["k"], "t", "since", ["since", "v"], how, ["seq"], bucket=bucket)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(events, changes, how, deletes=False)


def test_as_of_with_empty_sides_and_clashes(spark):
    events, changes = tables(2)
    e, c = frames(spark, events, changes)
    nothing = AO.as_of(e, c.filter("false"), "k", "t", "since", ["v"])
    assert nothing.count() == len(events) and nothing.filter("v is not null").count() == 0
    assert AO.as_of(e.filter("false"), c, "k", "t", "since", ["v"]).count() == 0
    with pytest.raises(ValueError):
        AO.as_of(e.withColumn("v", F.lit(1)), c, "k", "t", "since", ["v"])
    with pytest.raises(ValueError):
        AO.as_of(e, c, "k", "t", "since", ["v"], "full")


def test_a_hot_key_is_many_groups(spark):
    """No window of the plan is partitioned by the key alone but the one over a row per bucket."""
    e, c = frames(spark, *tables())
    plan = AO.as_of(e, c, "k", "t", "since", ["v"], tie_break=["seq"])._jdf.queryExecution().optimizedPlan().toString()
    assert "CartesianProduct" not in plan and "_bucket" in plan
    rows = e.count() + c.count()
    buckets = e.filter("k = 'hot' and t is not null").select(F.floor(F.unix_timestamp(F.col("t").cast("timestamp")) / 86400)).distinct().count()
    assert 1 < buckets < rows / 10
