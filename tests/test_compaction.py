"""Deletes in stream tables and stored topics."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from eventloom.sources.topics import read_topic, write_topic
from eventloom.streaming import compaction as CP
from eventloom.streaming import tables as ST

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "k string, t timestamp_ntz, seq long, v string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def merge(spark, path, changes, n, **kw):
    df = spark.createDataFrame([(k, T0 + dt.timedelta(minutes=m), s, v) for k, m, s, v in changes], SCHEMA)
    ST.merge_batch(spark, df, ["k"], ["t", "seq"], path, 2, n, "q", "v", **kw)


def test_a_deleted_key_stays_deleted(spark, tmp_path, monkeypatch):
    path = str(tmp_path / uuid.uuid4().hex)
    merge(spark, path, [("a", 1, 1, "x"), ("b", 1, 2, "y")], 0)
    merge(spark, path, [("a", 5, 3, None)], 1)
    assert [r[0] for r in rows(ST.read_table(spark, path).select("k"))] == ["b"]
    merge(spark, path, [("a", 3, 4, "older, and late")], 2)
    assert [r[0] for r in rows(ST.read_table(spark, path).select("k"))] == ["b"]
    monkeypatch.setattr(ST, "BUCKET_ROWS", 0)  # the next merge deals all buckets anew
    merge(spark, path, [("c", 9, 5, "z")], 3)
    monkeypatch.undo()
    merge(spark, path, [("a", 4, 6, "older, and later still"), ("c", 8, 7, None)], 4)
    assert [r[0] for r in rows(ST.read_table(spark, path).select("k"))] == ["b", "c"]
    merge(spark, path, [("a", 6, 8, "back")], 5)
    assert [r[0] for r in rows(ST.read_table(spark, path).select("k"))] == ["a", "b", "c"]


def test_tombstones_go_after_the_retention_and_buckets_may_empty(spark, tmp_path):
    path = str(tmp_path / uuid.uuid4().hex)
    merge(spark, path, [("a", 1, 1, None), ("b", 1, 1, None)], 0, retention_seconds=600)
    assert rows(ST.read_table(spark, path)) == []
    merge(spark, path, [("a", 0, 0, "within the retention: too old"), ("b", 0, 0, "too old")], 1, retention_seconds=600)
    assert rows(ST.read_table(spark, path)) == []
    merge(spark, path, [("a", 60, 9, None), ("b", 60, 9, None)], 2, retention_seconds=0)
    merge(spark, path, [(k, 90, 9, None) for k in "ab"], 3, retention_seconds=0)
    folders = ST._load(spark, path, ST._manifests(spark, path)[-1])["folders"]
    kept = spark.read.schema(SCHEMA).parquet(*folders.values()).count() if folders else 0
    assert kept <= 2
    merge(spark, path, [("z", 200, 10, "v")], 4, retention_seconds=0)
    assert [r[0] for r in rows(ST.read_table(spark, path).select("k"))] == ["z"]


def messages(spark, low, high):
    """Offsets low..high over 5 keys and none; every 7th is a tombstone."""
    i = F.col("id")
    return spark.range(low, high).select(
        F.when(i % 6 < 5, F.concat(F.lit("k"), (i % 6).cast("string"))).cast("binary").alias("key"),
        F.when(i % 7 != 0, i.cast("string")).cast("binary").alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        i.alias("offset"), (F.lit(T0).cast("timestamp") + F.make_dt_interval(mins=i.cast("int"))).alias("timestamp"),
        F.lit(0).alias("timestampType"))


def plain(high):
    last = {}
    for i in range(high):
        last[f"k{i % 6}" if i % 6 < 5 else ("none", i)] = (i, str(i) if i % 7 else None)
    return last


def held(spark, path):
    log = CP.read_log(spark, path, "t").select(F.col("key").cast("string"), "offset", F.col("value").cast("string")).collect()
    last = {}
    for k, i, v in sorted(log, key=lambda r: r[1]):
        last[k if k is not None else ("none", i)] = (i, v)
    return last, len(log)


def test_a_topic_is_the_same_before_and_after_compactions(spark, tmp_path):
    path = str(tmp_path / "topic")
    write_topic(messages(spark, 0, 50), path)
    assert held(spark, path) == (plain(50), 50)
    assert CP.compact_topic(spark, path, "t") == 1
    last, n = held(spark, path)
    assert last == plain(50) and n == len(plain(50))
    write_topic(messages(spark, 50, 70), path)
    assert held(spark, path)[0] == plain(70)  # the head isn't compacted yet
    assert CP.compact_topic(spark, path, "t") == 2
    assert held(spark, path) == (plain(70), len(plain(70)))
    assert CP.compact_topic(spark, path, "t") == 2  # nothing new
    write_topic(messages(spark, 70, 71), path)
    CP.compact_topic(spark, path, "t", retention_seconds=0)
    want = {k: v for k, v in plain(71).items() if v[1] is not None or v[0] == 70 or not isinstance(k, str)}
    assert held(spark, path)[0] == want
    # files that were compacted are gone one compaction later; other readers of the folder see messages only
    assert read_topic(spark, path, topics="t").filter("offset < 50").count() == 0


def test_a_compaction_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "topic")
    write_topic(messages(spark, 0, 30), path)
    monkeypatch.setattr(CP, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        CP.compact_topic(spark, path, "t")
    monkeypatch.undo()
    assert held(spark, path) == (plain(30), 30)
    # published, but stopped before old files were removed: they still count as compacted
    CP.compact_topic(spark, path, "t")
    write_topic(messages(spark, 30, 40), path)
    monkeypatch.setattr(CP, "_older", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        CP.compact_topic(spark, path, "t")
    monkeypatch.undo()
    assert held(spark, path) == (plain(40), len(plain(40)))
