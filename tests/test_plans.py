"""The physical plans keep the properties the scale design relies on."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from eventloom.operators import aggregates as A
from eventloom.operators import tables as T
from eventloom.operators import windows as W
from eventloom.plans import registry as REG
from conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_topk_limits_before_shuffle(spark):
    p = plan(A.top_k(REG.clicks(spark, SF_SMALL), "event_type", "value", 5, ["event_id"]))
    assert "WindowGroupLimit" in p and "Partial" in p
    # the partial limit sits below the exchange
    assert p.index("Exchange") < p.rindex("Partial")


def test_latest_and_histogram_aggregate_partially(spark):
    ev = REG.clicks(spark, SF_SMALL)
    assert "partial_max_by" in plan(T.latest(ev, "user_id", ["ts", "event_id"]))
    assert "partial_count" in plan(A.histogram(ev, "user_id", "event_type"))
    assert "partial_max_by" in plan(T.latest_global(ev, ["ts", "event_id"], {"value": 0.0}))


def test_topic_subscription_prunes_partitions(spark):
    p = plan(REG.QUERIES["src_topic"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(topic" in p and "clickevents" in p
    assert "ReadSchema: struct<key:binary,offset:bigint,timestamp:timestamp>" in p


def test_json_parsed_once_under_not_null_filter(spark):
    p = plan(REG.QUERIES["flt_notnull"](spark, SF_SMALL))
    # one from_json per envelope parse level, none duplicated into a Filter
    assert p.count("from_json(") == 2
    assert "Generate inline" in p


def test_filters_reach_the_scan(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    p = plan(ev.filter(F.col("value") >= 100).select("event_id"))
    assert "PushedFilters: [IsNotNull(value), GreaterThanOrEqual(value,100.0)]" in p
    assert "ReadSchema: struct<event_id:bigint,value:double>" in p


def test_broadcast_only_after_runtime_measurement(spark):
    df = REG.QUERIES["join_ss_risk"](spark, SF_SMALL)
    before = plan(df)
    assert "SortMergeJoin" in before and "BroadcastHashJoin" not in before
    df.collect()
    # AQE turns it into a broadcast once the side's shuffle measured small
    after = plan(df)
    assert "isFinalPlan=true" in after and "BroadcastHashJoin" in after


def test_bucketed_sessions_spread_a_key(spark):
    p = plan(W.sessions_bucketed(REG.clicks(spark, SF_SMALL), "ts", "user_id", 300))
    # raw events are aggregated per gap-wide bucket before they are shuffled
    assert p.rindex("partial_min") > p.rindex("hashpartitioning(user_id")


def test_hot_key_join_is_split_by_aqe(spark):
    from eventloom.plans import feeds as FD
    from eventloom.sources.topics import to_envelope
    from eventloom.functions.decode import json_value
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    # one customer gets most risk events (distinct scores, so the shuffle
    # bytes are skewed too, not just the row count)
    extra = spark.range(o.count() * 3).select(
        (F.col("id") + 10_000_000).alias("o_orderkey"), F.lit(7).cast("long").alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"), (F.col("id") * 1.37 + 0.11).alias("o_totalprice"),
        F.lit("1995-01-01").cast("timestamp_ntz").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"))
    skewed = o.unionByName(extra).repartition(16)  # many map tasks: splits happen between them
    risk = to_envelope(skewed.select("o_orderkey", FD.email_of(F.col("o_custkey")).alias("customer"),
                                     F.col("o_totalprice").cast("float").alias("score"),
                                     F.date_format("o_orderdate", "yyyy-MM-dd").alias("riskDate")),
                       FD.RISK, json_value(["customer", "score", "riskDate"]), key="customer",
                       offset="o_orderkey")
    cust = REG._topic(spark, SF_SMALL, FD.CUSTOMERS)
    conf = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = REG.risk_join(cust, risk)
        n = df.count()
        df.collect()
        final = plan(df)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert n == skewed.count()          # every event keeps its customer
    assert "skew=true" in final


def test_broadcast_if_small_reads_file_sizes_only(spark):
    from eventloom.operators.joins import broadcast_if_small
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    cond = F.col("o_custkey") == F.col("n_nationkey")
    assert "BroadcastHashJoin" in plan(orders.join(broadcast_if_small(nation), cond))
    assert "BroadcastHashJoin" not in plan(orders.join(broadcast_if_small(nation, max_file_bytes=10), cond))


def test_lookups_do_not_shuffle_the_large_side(spark):
    from eventloom.plans import feeds as FD
    p = plan(FD.location_records(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "hashpartitioning" not in p
    p = plan(REG.QUERIES["join_rejects"](spark, SF_SMALL))
    assert "BroadcastHashJoin LeftAnti" in p.replace("[", " [") or "LeftAnti, BuildRight" in p


def test_one_scan_and_one_parse_for_flagged_outputs(spark):
    p = plan(REG.QUERIES["dec_rejects"](spark, SF_SMALL))
    assert p.count("FileScan") == 1 and p.count("from_json(") == 1
    assert plan(REG.QUERIES["flt_contains"](spark, SF_SMALL)).count("FileScan") == 1


def test_demuxed_sides_parse_each_envelope_once(spark):
    p = plan(REG.QUERIES["join_travel"](spark, SF_SMALL))
    # two sides, each with one envelope parse and one member parse
    assert p.count("from_json(") == 4


def test_cluster_conf_sizes_partitions():
    from eventloom.session import cluster_conf
    c = cluster_conf(100 * 10**12, executors=1000, cores_per_executor=8)
    # 128 MB per partition at any size
    assert int(c["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (128 << 20))
    assert c["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    small = cluster_conf(10**9, executors=2, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
