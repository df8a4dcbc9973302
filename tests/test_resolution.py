"""Schema versions: every rule on hand-made messages."""


import uuid

import pytest
from pyspark.sql import functions as F

from eventloom.functions import resolution as RS


def record(*fields):
    return {"type": "record", "name": "r", "fields": [
        {"name": f[0], "type": f[1], **(f[2] if len(f) > 2 else {})} for f in fields]}


def read(spark, versions, reader, messages):
    df = spark.createDataFrame([(i, n, p) for i, (n, p) in enumerate(messages)], "i int, n long, payload string")
    df = df.select("i", RS.framed(F.col("payload"), F.col("n")).alias("value"))
    out = RS.read_versions(df, "value", versions, reader, keep=["i"]).orderBy("i").collect()
    return [tuple(r)[2:] for r in out]


def test_defaults_aliases_promotion_and_extra_fields(spark):
    reader = record(("a", "double"), ("b", "string", {"aliases": ["old", "older"]}), ("c", ["null", "long"], {"default": None}),
                    ("d", {"type": "array", "items": "long"}, {"default": [7]}), ("e", "bytes", {"default": "x"}))
    versions = {1: record(("a", "int"), ("older", "string"), ("gone", "string")),
                2: record(("a", "float"), ("b", "bytes"), ("c", "int"), ("d", {"type": "array", "items": "int"}), ("e", "string"))}
    got = read(spark, versions, reader, [
        (1, '{"a": 3, "older": "x", "gone": "y"}'), (2, '{"a": 0.5, "b": "eA==", "c": 4, "d": [1, 2], "e": "t"}')])
    assert got[0] == (3.0, "x", None, [7], b"x", None)
    assert got[1] == (0.5, "x", 4, [1, 2], b"t", None)


def test_nested_records_maps_and_enums(spark):
    point = lambda *extra: {"type": "record", "name": "p", "fields": [{"name": "x", "type": "int"}, *extra]}
    reader = record(("m", {"type": "map", "values": point({"name": "y", "type": "long", "default": 9})}),
                    ("kind", {"type": "enum", "name": "k", "symbols": ["A", "B"], "default": "A"}),
                    ("p", point({"name": "q", "type": ["null", "string"], "default": None}), {"default": {"x": 1}}))
    versions = {5: record(("m", {"type": "map", "values": point()}), ("kind", {"type": "enum", "name": "k", "symbols": ["A", "B", "C"]}))}
    got = read(spark, versions, reader, [(5, '{"m": {"u": {"x": 1}, "v": {"x": 2}}, "kind": "B"}'), (5, '{"m": {}, "kind": "C"}')])
    as_plain = [({k: tuple(v) for k, v in m.items()}, kind, tuple(p), why) for m, kind, p, why in got]
    assert as_plain == [({"u": (1, 9), "v": (2, 9)}, "B", (1, None), None), ({}, "A", (1, None), None)]


def test_rejects_say_why(spark):
    reader = record(("a", "long"), ("m", {"type": "map", "values": {"type": "array", "items": "int"}}, {"default": {}}))
    versions = {1: record(("a", ["null", "long"])), 2: record(("a", "string")), 3: record(("b", "long")),
                4: record(("a", "long"), ("m", {"type": "map", "values": {"type": "array", "items": ["null", "int"]}})),
                6: record(("a", "double")), 7: record(("a", ["null", "int", "string"]))}
    got = read(spark, versions, reader, [
        (1, '{"a": null}'), (1, '{"a": 1}'), (2, '{"a": "1"}'), (3, '{"b": 1}'), (4, '{"a": 1, "m": {"k": [1, null]}}'), (6, '{"a": 1}'),
        (7, '{"a": 1}'), (1, '{"a": "text"}'), (1, "no json"), (99, "{}"), (1, None), (4, '{"a": 2, "m": {"k": [1]}}')])
    assert [g[-1] for g in got] == [
        "a is null", None, "a: string can't be read as long", "a: not written, and without a default", "m{}[] is null",
        "a: double can't be read as long", "a union of 2 types is not read", "not a message of schema 1", "not a message of schema 1",
        "unknown schema 99", "not framed", None]
    assert all(g[:-1] == (None, None) for g in got if g[-1]) and got[11][:2] == (2, {"k": [1]})


def test_unframed_messages_are_rejects(spark):
    df = spark.createDataFrame([(bytearray(b"{}"),), (bytearray(b"\x01\x00\x00\x00\x01{}"),), (bytearray(b""),), (None,)], "value binary")
    got = RS.read_versions(df, "value", {1: record(("a", "int"))}, record(("a", "int"))).collect()
    assert [r.reason for r in got] == ["not framed"] * 4


def test_a_stream_of_versions(spark, tmp_path):
    from eventloom.streaming.runner import run_available
    reader, versions = record(("a", "double")), {1: record(("a", "int")), 2: record(("a", "double"))}
    df = spark.createDataFrame([(1, '{"a": 3}'), (2, '{"a": 0.5}'), (3, "{}")], "n long, payload string")
    df.select(RS.framed(F.col("payload"), F.col("n")).alias("value")).write.parquet(str(tmp_path / "in"))
    stream = RS.read_versions(spark.readStream.schema("value binary").parquet(str(tmp_path / "in")), "value", versions, reader)
    out, _ = run_available(stream, f"versions-{uuid.uuid4().hex}", path=str(tmp_path / "out"))
    assert sorted((r.a, r.reason) for r in spark.read.schema(stream.schema).parquet(out).filter("reason is null").collect()) == [(0.5, None), (3.0, None)]


@pytest.mark.parametrize("writer, reader", [("long", "int"), ("double", "float"), ("boolean", "int"),
                                            ({"type": "array", "items": "string"}, {"type": "array", "items": "int"})])
def test_what_can_not_be_promoted(writer, reader):
    with pytest.raises(RS.Incompatible):
        RS.resolve(record(("a", writer)), record(("a", reader)), F.col("v"))
