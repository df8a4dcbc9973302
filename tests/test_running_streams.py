"""Streams with state of their own: order, lateness, chained windows, restarts."""

import datetime as dt
import itertools
import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from eventloom.operators import aggregates as A
from eventloom.operators import windows as W
from eventloom.plans import persistent as PQ
from eventloom.plans.catalog import CatalogError
from eventloom.sources.topics import publish_slice, read_topic, stage_slices, to_envelope, write_topic
from eventloom.streaming import late as LT
from eventloom.streaming import runner as RN
from eventloom.streaming import running as RG

T0 = dt.datetime(2024, 1, 1)
EVENT = "id long, ts timestamp_ntz, k string, v double"


def feed(spark, path, rows):
    df = spark.createDataFrame([(i, T0 + dt.timedelta(seconds=s), k, v) for i, s, k, v in rows], EVENT)
    df.coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema(EVENT).parquet(path)


@pytest.mark.parametrize("order", ["in order", "shuffled"])
def test_running_values_do_not_depend_on_arrival(spark, tmp_path, order):
    r = random.Random(4)
    rows = [(i, 7 * i, r.choice("ab"), None if i % 11 == 0 else i / 4) for i in range(120)]
    batches = [rows[i:i + 30] for i in range(0, 120, 30)]
    if order == "shuffled":  # within the watermark's delay, over batches and inside them
        mixed = sorted(rows, key=lambda x: x[1] + r.randint(0, 90))
        batches = [mixed[i:i + 30] for i in range(0, 120, 30)]
    batches.append([(999, 5000, "z", 0.0)])  # moves the watermark past all
    path, out, name = str(tmp_path / "in"), str(tmp_path / "out"), f"run-{uuid.uuid4().hex}"
    for b in batches:
        feed(spark, path, b)
        df = RG.running_in_window_ordered(stream(spark, path), "ts", "k", "v", "id", 300, 60, "120 seconds")
        RN.run_available(df, name, path=out, settings=RG.SETTINGS, state_partitions=2)
    got = sorted((x.k, x.id, x.current) for x in spark.read.schema(df.schema).parquet(out).collect() if x.id != 999)
    want, sums = [], {}
    for i, s, k, v in rows:
        n = sums.setdefault((k, s // 300), [])
        n.extend([] if v is None else [v])
        want.append((k, i, round(sum(n), 2) if n else None))
    assert got == sorted(want)


def test_on_time_and_late_rows_are_the_input(spark, tmp_path):
    path, out, name = str(tmp_path / "in"), str(tmp_path / "out"), f"late-{uuid.uuid4().hex}"
    batches = [[(1, 100, "a", 1.0), (2, 90, "a", 1.0)], [(3, 89, "a", 1.0), (4, 90, "a", 1.0), (5, 300, "a", 1.0), (6, 50, "b", 1.0)],
               [(7, 289, "a", 1.0), (8, 290, "a", 1.0)]]
    for b in batches:
        feed(spark, path, b)
        LT.route_late(stream(spark, path), "ts", 10, name, out, state_partitions=2)
    got = LT.read_routed(spark, out, stream(spark, path).schema).collect()
    assert sorted((r.id, r.is_late) for r in got) == [
        (1, False), (2, False), (3, True), (4, False), (5, False), (6, True), (7, True), (8, False)]


def test_a_batch_that_runs_again_keeps_its_own_watermark(spark, tmp_path, monkeypatch):
    path, out, name = str(tmp_path / "in"), str(tmp_path / "out"), f"late-{uuid.uuid4().hex}"
    feed(spark, path, [(1, 100, "a", 1.0)])
    LT.route_late(stream(spark, path), "ts", 10, name, out)
    feed(spark, path, [(2, 80, "a", 1.0), (3, 500, "a", 1.0)])
    store = LT._store

    def lost(*a):
        store(*a)
        raise RuntimeError("lost after the mark was stored")
    monkeypatch.setattr(LT, "_store", lost)
    with pytest.raises(Exception):
        LT.route_late(stream(spark, path), "ts", 10, name, out)
    monkeypatch.undo()
    LT.route_late(stream(spark, path), "ts", 10, name, out)
    got = LT.read_routed(spark, out, stream(spark, path).schema).collect()
    assert sorted((r.id, r.is_late) for r in got) == [(1, False), (2, True), (3, False)]


def test_hopping_windows_of_panes_keep_one_row_per_pane(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [(i, i % 100, "a", 1.0) for i in range(2000)] + [(9999, 100_000, "z", 0.0)]
    feed(spark, path, rows)
    s = W.event_time(stream(spark, path), "ts", "0 seconds")
    _, progress = RN.run_available(W.hopping_sum_stream(s, "ts", "k", "v", "60 seconds", "10 seconds"), f"hop-{uuid.uuid4().hex}",
                                   path=str(tmp_path / "out"), state_partitions=2)
    got = {r.window_start: r.total for r in spark.read.parquet(str(tmp_path / "out")).filter("k = 'a'").collect()}
    want = {}
    for (_, s_, _, v), k in itertools.product(rows[:-1], range(6)):
        start = T0 + dt.timedelta(seconds=s_ // 10 * 10 - 10 * k)
        want[start] = want.get(start, 0) + v
    assert got == want
    updated = [sorted(o["numRowsUpdated"] for o in p["stateOperators"]) for p in progress if p["numInputRows"]]
    # ten panes and one of z, and of the closed ones nothing else yet: not 6 x 2,000 rows
    assert sum(max(u) for u in updated) <= 11


def test_histograms_of_a_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [(i, i % 7 * 30, "ab"[i % 2], float(i % 3)) for i in range(200)] + [(9999, 100_000, "z", 0.0)]
    feed(spark, path, rows)
    s = W.event_time(stream(spark, path), "ts", "0 seconds")
    out = str(tmp_path / "out")
    RN.run_available(A.histogram_stream(s, "ts", "k", "v", "v", "1 minute"), f"hist-{uuid.uuid4().hex}", path=out, state_partitions=2)
    want, total = {}, {}
    for _, at, k, v in rows[:-1]:
        w = (T0 + dt.timedelta(seconds=at // 60 * 60), k)
        want[(*w, v)] = want.get((*w, v), 0) + 1
        total[w] = total.get(w, 0) + v
    got = {(r.window_start, r.k, r.v): (r.occurrences, r.total) for r in spark.read.parquet(out).filter("k <> 'z'").collect()}
    assert got == {x: (n, total[x[:2]]) for x, n in want.items()}


def test_slices_are_published_by_renaming(spark, tmp_path):
    env = to_envelope(spark.range(40), "t", F.col("id"), key="id", offset="id")
    stage_slices(env, str(tmp_path / "staged"), (F.col("offset") % 3).cast("int"))
    for n, want in ((0, 14), (1, 27), (2, 40), (5, 40)):
        publish_slice(spark, str(tmp_path / "staged"), n, str(tmp_path / "topic"))
        assert read_topic(spark, str(tmp_path / "topic"), topics="t").count() == want


# --- persistent queries

SCHEMA = StructType([StructField("n", LongType()), StructField("s", StringType())])


def numbers(spark, low, high):
    df = spark.range(low, high).select(F.to_json(F.struct(F.col("id").alias("n"), F.lit("x").alias("s"))).alias("value"), "id")
    return to_envelope(df, "numbers", F.col("value"), key="id", offset="id")


def test_queries_survive_the_session(spark, tmp_path):
    tag = uuid.uuid4().hex
    folder, topic, out, stream_, name = (str(tmp_path / "log"), str(tmp_path / "in"), str(tmp_path / "out"), f"numbers_{tag}", f"even_{tag}")
    write_topic(numbers(spark, 0, 10), topic)
    one = PQ.Catalog(spark, folder, 2)
    one.create_stream(stream_, topic, "numbers", SCHEMA)
    sql = f"SELECT x.n, x.s FROM {stream_} AS x WHERE n % 2 = 0"
    q = one.create_query(name, sql, "n", "even", out, "n")
    assert one.create_query(name, sql, "n", "even", out, "n").id == q.id  # the same again
    with pytest.raises(CatalogError):
        one.create_query(name, sql + " AND n > 3", "n", "even", out, "n")
    with pytest.raises(CatalogError):
        one.create_stream(stream_, topic, "others", SCHEMA)
    q.processAllAvailable()
    q.stop()
    spark.catalog.dropTempView(stream_)

    # another session: the query isn't running, yet its stream can't be dropped
    other = spark.newSession()
    two = PQ.Catalog(other, folder, 2)
    assert [x[:3] for x in two.listing()] == [("stream", stream_, "declared"), ("query", name, "stopped")]
    with pytest.raises(CatalogError):
        two.drop_stream(stream_)
    write_topic(numbers(spark, 10, 16), topic)
    resumed = two.restore()[name]
    assert resumed.id == q.id  # from its checkpoint
    resumed.processAllAvailable()
    assert [x[2] for x in two.listing()] == ["declared", "running"]
    keys = sorted(int(r.key.decode()) for r in read_topic(spark, out, topics="even").collect())
    assert keys == [0, 2, 4, 6, 8, 10, 12, 14]
    assert two.terminate(name) and not two.terminate(name)
    assert two.drop_stream(stream_) and two.listing() == []
    RN.drop_checkpoint(spark, name)
