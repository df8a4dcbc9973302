"""The operators expressed in Spark SQL over a declared view give the same
results as the DataFrame functions (the path a KSQL user takes)."""

from eventloom.operators import aggregates as A
from eventloom.operators import tables as T
from eventloom.operators import windows as W
from eventloom.plans import catalog as C
from eventloom.plans import feeds as FD
from eventloom.plans import registry as REG
from eventloom.schemas import CLICK_EVENT
from conftest import SF_SMALL


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def view(spark):
    return C.declare(spark, "clickevents_sql", REG._topic(spark, SF_SMALL, FD.CLICKS), CLICK_EVENT)


def test_sum_per_key_in_sql(spark):
    ev = view(spark)
    sql = spark.sql("SELECT event_type, round(sum(value), 2) AS total FROM clickevents_sql GROUP BY event_type")
    assert same(sql, A.sum_by_key(ev, "event_type", "value", "total", 2))


def test_tumbling_window_in_sql(spark):
    ev = view(spark)
    sql = spark.sql("""
        SELECT window.start AS window_start, window.end AS window_end, event_type,
               round(sum(value), 2) AS total
        FROM clickevents_sql GROUP BY window(ts, '10 seconds'), event_type""")
    assert same(sql, W.tumbling_sum(ev, "ts", "event_type", "value", "10 seconds"))


def test_latest_table_in_sql(spark):
    ev = view(spark)
    sql = spark.sql("""
        SELECT user_id, r.event_id, r.ts, r.event_type, r.value, r.props FROM (
          SELECT user_id, max_by(struct(event_id, ts, event_type, value, props), struct(ts, event_id)) AS r
          FROM clickevents_sql GROUP BY user_id)""")
    assert same(sql, T.latest(ev, "user_id", ["ts", "event_id"]))


def test_top_k_in_sql(spark):
    ev = view(spark)
    sql = spark.sql("""
        SELECT event_type, pos, value FROM (
          SELECT event_type, value,
                 CAST(row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS INT) AS pos
          FROM clickevents_sql WHERE value IS NOT NULL) WHERE pos <= 5""")
    assert same(sql, A.top_k(ev, "event_type", "value", 5, ["event_id"]))
