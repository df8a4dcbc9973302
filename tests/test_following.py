"""Sources that follow growing files: positions, restarts, rotation, limits."""

import collections
import datetime as dt
import json
import os
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from eventloom.sources import following as FW
from eventloom.sources.topics import to_envelope, write_topic
from eventloom.streaming import runner as RN
from pyspark.sql import functions as F


def write(path, data, mode="ab"):
    with open(path, mode) as f:
        f.write(data)


def lines_run(spark, folder, name, out, **kw):
    df = FW.follow_lines(spark, str(folder), RN.checkpoint_for(spark, name), **kw)
    RN.run_caught_up(df, name, path=str(out))
    return sorted((r.value, r.position) for r in spark.read.schema(df.schema).parquet(str(out)).collect())


def test_lines_arrive_once_as_files_grow_rotate_and_shrink(spark, tmp_path):
    logs, out, name = tmp_path / "logs", tmp_path / "out", f"tail-{uuid.uuid4().hex}"
    logs.mkdir()
    write(logs / "a.log", b"one\ntwo\nhalf a li")
    write(logs / "b.log", "é😀\r\n\n".encode())
    write(logs / "_hidden", b"no\n")
    assert lines_run(spark, logs, name, out) == sorted([("one", 0), ("two", 4), ("é😀", 0), ("", 8)])
    write(logs / "a.log", b"ne\nthree\n")
    write(logs / "c.log", b"\xff\xfe\n")
    got = lines_run(spark, logs, name, out)
    assert len(got) == 7 and ("half a line", 8) in got and ("three", 20) in got and ("\ufffd\ufffd", 0) in got
    # nothing new: nothing arrives
    assert lines_run(spark, logs, name, out) == got
    # rotated, with lines of its own that were not read yet; a new file takes its name
    write(logs / "a.log", b"last of old\n")
    os.rename(logs / "a.log", logs / "a.log.1")
    write(logs / "a.log", b"first of new\n")
    more = lines_run(spark, logs, name, out)
    assert collections.Counter(more) - collections.Counter(got) == collections.Counter([("last of old", 26), ("first of new", 0)])
    # truncated and written again, longer than before; another file goes
    write(logs / "b.log", b"after the cut, and longer than what was there\n", "wb")
    os.remove(logs / "c.log")
    last = lines_run(spark, logs, name, out)
    assert collections.Counter(last) - collections.Counter(more) == collections.Counter(
        [("after the cut, and longer than what was there", 0)])


def test_lines_of_a_failed_batch_are_read_again_after_a_rotation(spark, tmp_path):
    logs, name = tmp_path / "logs", f"tail-{uuid.uuid4().hex}"
    logs.mkdir()
    write(logs / "a.log", b"1\n2\n3\n")
    seen, fail = collections.defaultdict(list), [True]

    def sink(batch, batch_id):
        seen[batch_id] = [r.value for r in batch.collect()]
        if fail[0]:
            raise RuntimeError("lost between read and commit")

    def run():
        RN.run_caught_up(FW.follow_lines(spark, str(logs), RN.checkpoint_for(spark, name)), name, foreach_batch=sink)

    with pytest.raises(Exception):
        run()
    os.rename(logs / "a.log", logs / "a.log.1")
    write(logs / "a.log", b"4\n")
    fail[0] = False
    run()
    assert dict(seen) == {0: ["1", "2", "3"], 1: ["4"]}


@pytest.mark.parametrize("split", [1, 2, 7, 64, 1000])
def test_ranges_of_any_size_give_every_line_once(tmp_path, split):
    text = b"".join(b"x" * (i * 7 % 23) + b"\n" for i in range(60))
    write(tmp_path / "f", text + b"unfinished")
    reader = FW._Lines({"split": str(split)}, str(tmp_path))
    end = reader.latestOffset()
    got = []
    for p in reader.partitions({"at": {}}, end):
        for b in reader.read(p):
            got += list(zip(b.column(0).to_pylist(), b.column(2).to_pylist()))
    want, at = [], 0
    for x in text.split(b"\n")[:-1]:
        want.append((x.decode(), at))
        at += len(x) + 1
    assert got == want


def envelopes(spark, low, high, files):
    df = spark.range(low, high).withColumn("at", F.lit(dt.datetime(2024, 1, 1)))
    return to_envelope(df.repartition(files), "t", F.col("id"), key="id", timestamp="at", offset="id")


def test_pulls_hold_n_messages_over_files_and_restarts(spark, tmp_path):
    path, name = str(tmp_path / "topic"), f"pull-{uuid.uuid4().hex}"
    write_topic(envelopes(spark, 0, 95, 2), path)
    sizes, seen = {}, []

    def sink(batch, batch_id):
        rows = batch.collect()
        sizes[batch_id] = len(rows)
        seen.extend((r.offset, r.value.decode(), r.key.decode(), r.topic, r.timestamp) for r in rows)

    def run():
        df = FW.pull_messages(spark, path, 10, RN.checkpoint_for(spark, name), topic="t")
        RN.run_caught_up(df, name, foreach_batch=sink)
    run()
    assert [sizes[i] for i in sorted(sizes)] == [10] * 9 + [5]
    write_topic(envelopes(spark, 95, 118, 3), path)  # files that are added, after a restart
    run()
    assert [sizes[i] for i in sorted(sizes)] == [10] * 9 + [5, 10, 10, 3]
    assert sorted(seen) == [(i, str(i), str(i), "t", dt.datetime(2024, 1, 1)) for i in range(118)]


def test_increments_of_several_tables_survive_a_crash(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b.parquet"
    a.mkdir()
    pq.write_table(pa.table({"id": [1, 2, None], "x": ["p", None, "q"]}), a / "1.parquet")
    pq.write_table(pa.table({"no": pa.array([5, 6], pa.int32()), "y": [0.5, float("nan")]}), b)
    tables, name = {"ta": (str(a), "id"), "tb": (str(b), "no")}, f"inc-{uuid.uuid4().hex}"
    seen, fail = {}, [True]

    def sink(batch, batch_id):
        seen[batch_id] = list((r.topic, r.offset, json.loads(r.value).get("x")) for r in batch.orderBy("topic", "offset").collect())
        if fail[0]:
            raise RuntimeError("lost between read and commit")

    def run():
        RN.run_caught_up(FW.follow_tables(spark, tables, RN.checkpoint_for(spark, name), "db-"), name, foreach_batch=sink)

    with pytest.raises(Exception):
        run()
    pq.write_table(pa.table({"id": [4, 3], "x": ["r", "s"]}), a / "2.parquet")
    fail[0] = False
    run()
    run()
    assert seen == {0: [("db-ta", 1, "p"), ("db-ta", 2, None), ("db-tb", 5, None), ("db-tb", 6, None)],
                    1: [("db-ta", 3, "s"), ("db-ta", 4, "r")]}
