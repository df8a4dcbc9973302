"""Stream–stream joins against the history of both sides."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL as SF
from eventloom.plans import registry as REG
from eventloom.session import scratch_path
from eventloom.streaming import joined as JD
from eventloom.streaming import runner as RN

LEFT, RIGHT = "k string, l int", "rk string, r int"
ON = "k = rk"


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _sides(spark, base):
    return (spark.readStream.schema(LEFT).parquet(f"{base}/left"), spark.readStream.schema(RIGHT).parquet(f"{base}/right"))


def _send(spark, base, left=(), right=()):
    spark.createDataFrame(list(left), LEFT).coalesce(1).write.mode("append").parquet(f"{base}/left")
    spark.createDataFrame(list(right), RIGHT).coalesce(1).write.mode("append").parquet(f"{base}/right")


def test_pairs_come_once_whenever_their_rows_arrive(spark):
    name = REG._uid("t_joined")
    base = scratch_path(spark, name)
    out = f"{base}/out"
    parts = [([("a", 1), ("a", 1), (None, 2), ("b", 3)], [("a", 10), (None, 11)]),
             ([("a", 4), ("c", 5)], [("b", 12), ("b", 13), ("a", 14)]),
             ([], [("c", 15), ("d", 16)]),
             ([("d", 6)], [])]
    for left, right in parts:
        _send(spark, base, left, right)
        JD.join_streams(*_sides(spark, base), F.expr(ON), name, out)
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() == 4
    want = spark.read.schema(LEFT).parquet(f"{base}/left").join(spark.read.schema(RIGHT).parquet(f"{base}/right"), F.expr(ON))
    assert want.count() == 10 and same(got.select("k", "l", "rk", "r"), want)


def test_a_replayed_batch_replaces_its_own(spark):
    name = REG._uid("t_replayed")
    base = scratch_path(spark, name)
    failing = {"now": False}

    def finish(df):
        return df.filter(F.assert_true(F.lit(not failing["now"])).isNull())

    _send(spark, base, [("a", 1)], [("a", 10)])
    JD.join_streams(*_sides(spark, base), F.expr(ON), name, f"{base}/out", finish)
    _send(spark, base, [("a", 2)], [("a", 11)])
    failing["now"] = True
    with pytest.raises(Exception):  # the batch's history is written, its pairs are not
        JD.join_streams(*_sides(spark, base), F.expr(ON), name, f"{base}/out", finish)
    failing["now"] = False
    JD.join_streams(*_sides(spark, base), F.expr(ON), name, f"{base}/out", finish)
    # its commit mark lost, the last batch runs once more
    p, fs = JD._fs(spark, f"{RN.checkpoint_for(spark, name)}/commits/1")
    assert fs.delete(p, False)
    JD.join_streams(*_sides(spark, base), F.expr(ON), name, f"{base}/out", finish)
    assert sorted((r.l, r.r) for r in spark.read.parquet(f"{base}/out").collect()) == [(1, 10), (1, 11), (2, 10), (2, 11)]


def test_empty_sides_give_no_rows(spark):
    name = REG._uid("t_empty")
    base = scratch_path(spark, name)
    _send(spark, base, [("a", 1)])
    out, _ = JD.join_streams(*_sides(spark, base), F.expr(ON), name, f"{base}/out")
    assert spark.read.schema(LEFT).parquet(out).count() == 0


def _stores(spark, monkeypatch, query):
    """The state stores' rows that a registered query reports."""
    seen, run = [], RN.run_available

    def watched(*a, **kw):
        out = run(*a, **kw)
        seen.extend(out[1])
        return out

    for module in (RN, JD, REG.SK):
        monkeypatch.setattr(module, "run_available", watched)
    REG.QUERIES[query](spark, SF).count()
    assert sum(p["numInputRows"] for p in seen) > 0
    return [op for p in seen for op in p.get("stateOperators", [])]


@pytest.mark.parametrize("query", ["join_ss_withdrawals", "join_ss_deposits", "join_ss_risk_stream", "join_ss_location", "sink_topic"])
def test_joins_keep_no_row_in_a_state_store(spark, monkeypatch, query):
    assert _stores(spark, monkeypatch, query) == []


def test_checkin_keeps_no_row_in_a_state_store(spark, monkeypatch):
    assert _stores(spark, monkeypatch, "join_ss_checkin") == []
