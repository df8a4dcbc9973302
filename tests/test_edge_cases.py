"""Hand-made fixtures for the edge cases of FIXTURES.md."""

import base64
import json

import pytest
from pyspark.sql import functions as F

from eventloom.functions import decode as D
from eventloom.functions import scalars as S
from eventloom.operators import aggregates as A
from eventloom.operators import joins as J
from eventloom.operators import relational as R
from eventloom.operators import tables as T
from eventloom.operators import windows as W
from eventloom.schemas import CUSTOMER_RECORD, LOCATION_RECORD
from eventloom.sources.topics import start_at, subscribe, to_envelope


def b64(s):
    return base64.b64encode(s.encode()).decode()


def change(element=None, entries="one"):
    rec = {"key": b64("Customer"), "existType": "NONE", "ch": False, "incr": False}
    if entries == "one":
        rec["zSetEntries"] = [{"element": element, "score": "0.0"}]
    elif entries == "empty":
        rec["zSetEntries"] = []
    elif entries == "null":
        rec["zSetEntries"] = None
    return json.dumps(rec)


CUST = {"customerName": "Ines Vale", "email": "ines.vale@example.org", "phone": "5550100123",
        "birthDay": "1988-11-20"}


def test_two_level_decode_survives_bad_records(spark):
    rows = [(change(b64(json.dumps(CUST))),), (change(entries="empty"),), (change(entries="absent"),),
            (change(entries="null"),), (change("!!not base64"),), (change(b64("not json")),),
            ("not even json",)]
    df = spark.createDataFrame(rows, "value string")
    out = D.decode_two_level(df, CUSTOMER_RECORD)
    assert out.count() == len(rows)
    good = R.not_null(out, ["email", "birthDay"]).collect()
    assert [(r.email, r.birthDay) for r in good] == [("ines.vale@example.org", "1988-11-20")]
    yr = R.not_null(out, ["email"]).select(S.split_item("birthDay", "-", 0)).first()[0]
    assert yr == "1988"


def test_element_encoded_by_the_library_decodes(spark):
    df = spark.createDataFrame([(json.dumps(CUST),)], "m string").select(
        D.change_record_value(F.col("m"), F.lit(0.0), "Customer").alias("value"))
    r = D.decode_two_level(df, CUSTOMER_RECORD).first()
    assert (r.customerName, r.email, r.birthDay) == (CUST["customerName"], CUST["email"], CUST["birthDay"])


def test_demux_does_not_double_rows(spark):
    cust = dict(CUST, accountNumber="700800900", location="Norway")
    loc = {"accountNumber": "700800900", "location": "Kenya"}
    rows = [(change(b64(json.dumps(cust))),), (change(b64(json.dumps(loc))),),
            (change(b64(json.dumps(loc))),)]
    members = D.decode_change_members(spark.createDataFrame(rows, "value string"))
    c, lo, rejects = D.demux(members, "member", "customerName")
    assert rejects.count() == 0
    home = D.parse_json(c, "member", CUSTOMER_RECORD).select(
        F.col("accountNumber").alias("acc"), F.col("location").alias("home"))
    cur = D.parse_json(lo, "member", LOCATION_RECORD)
    j = J.join(cur, home, F.col("accountNumber") == F.col("acc"), "inner")
    assert sorted((r.location, r.home) for r in j.collect()) == [("Kenya", "Norway")] * 2


def test_threshold_edges(spark):
    df = spark.createDataFrame([(99, "http://www.k1"), (100, "http://www.k2"), (101, "http://www.k3"),
                                (101, "http://www.a")], "number int, uri string")
    assert R.at_least(df, "number", 100).count() == 3
    assert [r.uri for r in R.above_and_like(df, "number", 100, "uri", "http://www.k%").collect()] == \
        ["http://www.k3"]


def test_latest_ties_and_tombstones(spark):
    rows = [("a", 1, 10, "x"), ("a", 1, 11, "y"), ("b", 2, 20, "z"), ("b", 3, 21, None), ("c", 5, 30, None)]
    df = spark.createDataFrame(rows, "k string, ts int, off long, v string")
    lt = {r.k: r.v for r in T.latest(df, "k", ["ts", "off"]).collect()}
    assert lt == {"a": "y", "b": None, "c": None}
    assert [r.k for r in T.compact(df, "k", ["ts", "off"], "v").collect()] == ["a"]


def test_train_positions_rules(spark):
    rows = [  # line, station, dir, train, status, prev station, prev dir, ts, id
        ("red", 1, "a", "RL001", "in_service", None, None, 1, 1),
        ("red", 2, "a", "RL001", "in_service", 1, "a", 2, 2),     # clears (1, a)
        ("red", 3, "x", "RL002", "delayed", 99, "b", 3, 3),        # unknown prev: clears nothing real
        ("red", 4, "b", "RL003", "in_service", 5, None, 4, 4),    # prev direction missing: no clear
    ]
    df = spark.createDataFrame(rows, "line string, station_id int, direction string, train_id string, "
                                     "train_status string, prev_station_id int, prev_direction string, "
                                     "ts int, event_id int")
    pos = {(r.station_id, r.direction): r.train_id for r in T.train_positions(df, "ts", "event_id").collect()}
    assert pos[(1, "a")] is None
    assert pos[(2, "a")] == "RL001"
    assert pos[(3, "b")] == "RL002"          # any direction but "a" counts as "b"
    assert pos[(4, "b")] == "RL003"
    assert (5, "b") not in pos


def test_station_lines_and_colours(spark):
    df = spark.createDataFrame([(True, False, False), (False, True, True), (False, False, False),
                                (True, True, False)], "red boolean, blue boolean, green boolean")
    got = [tuple(r) for r in df.select(S.line_of("red", "blue", "green").alias("l"))
           .select("l", S.line_colour("l")).collect()]
    assert got == [("red", "#DC143C"), ("blue", "#1E90FF"), (None, "0xFFFFFF"), ("red", "#DC143C")]


def test_route_discards_unknown_lines(spark):
    rows = [("transit.station.arrivals.x", 1, "red"), ("transit.station.arrivals.x", 2, "purple"),
            ("TURNSTILE_SUMMARY", 3, None), ("weather", 4, "red")]
    bus = spark.createDataFrame(rows, "topic string, msg_offset long, line string")
    r = sorted((x.msg_offset, x.route_line) for x in T.route_by_topic(bus, "transit.station",
                                                                     "TURNSTILE_SUMMARY").collect())
    assert r == [(1, "red"), (3, "blue"), (3, "green"), (3, "red")]


def test_window_edges_and_session_gap(spark):
    rows = [(1, "2024-01-01 00:00:09.999999"), (2, "2024-01-01 00:00:10"),
            (3, "2024-01-01 00:10:10"), (4, "2024-01-01 00:15:10")]
    df = spark.createDataFrame(rows, "id int, t string").select(
        "id", F.col("t").cast("timestamp_ntz").alias("ts"), F.lit("u").alias("k"), F.lit(1.0).alias("v"))
    tagged = {r.id: str(r.window_start) for r in W.assign_window(df, "ts", "10 seconds").collect()}
    assert tagged[1].endswith("00:00:00") and tagged[2].endswith("00:00:10")
    sess = W.session_agg(df, "ts", "k", "5 minutes", [F.count(F.lit(1)).alias("n")]).orderBy("session_start")
    # 00:10:10 and 00:15:10 are exactly one gap apart: one session
    assert [r.n for r in sess.collect()] == [2, 2]


def test_envelope_round_trip_and_offsets(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "id long, v string")
    env = to_envelope(df, "t", F.col("v"), key="id", offset="id", partitions=4)
    assert env.select(F.col("value").cast("string")).orderBy("value").collect() == \
        df.select(F.col("v").alias("value")).orderBy("value").collect()
    assert start_at(env, "latest").count() == 0
    p0 = env.filter("partition = 0").agg(F.min("offset")).first()[0]
    started = start_at(env, {"t": {0: p0 + 1}})
    assert started.count() == 19
    assert subscribe(env, pattern="^t$").count() == 20


def test_scalars(spark):
    df = spark.createDataFrame([("Blue", 7, "in_station", 12.9, "Sep 29, 2020, 10:06:23 AM"),
                                ("green", 1234, None, -3.7, "Oct 7, 2020 12:33:34 AM")],
                               "line string, n int, st string, x double, d string")
    r = df.select(S.train_id("line", "n").alias("id"), S.status_text("st").alias("s"),
                  S.whole_number_text("x").alias("w"), S.parse_bank_time("d").cast("string").alias("t"),
                  S.slug(F.lit("Harlem/Lake O'Hare-Blue")).alias("slug")).collect()
    assert [(x.id, x.s, x.w) for x in r] == [("BL007", "In Station", "12"), ("GL1234", "---", "-3")]
    assert r[0].t == "2020-09-29 10:06:23" and r[1].t == "2020-10-07 00:33:34"
    assert r[0].slug == "harlem_and_lake_ohare_blue"


def test_topk_array_and_histogram_map(spark):
    df = spark.createDataFrame([("a", 5.0), ("a", 9.0), ("a", 9.0), ("a", 1.0), ("b", 2.0)], "k string, v double")
    arr = {r.k: r.topk for r in A.top_k_array(df, "k", "v", 3).collect()}
    assert arr == {"a": [9.0, 9.0, 5.0], "b": [2.0]}
    hm = {r.k: r.histogram for r in A.histogram_map(df, "k", "v").collect()}
    assert hm["a"] == {5.0: 1, 9.0: 2, 1.0: 1}


def test_previous_in_key_equals_lag(spark):
    from pyspark.sql import Window
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    fast = W.previous_in_key(ev, "user_id", "ts", ["event_id"], ["event_type"], bucket="1 hour")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    plain = ev.withColumn("prev_event_type", F.lag("event_type").over(w))
    assert fast.exceptAll(plain).count() == 0 and plain.exceptAll(fast).count() == 0


def test_refused_joins(spark, tmp_path):
    stream = spark.readStream.schema("k long").parquet(str(tmp_path))
    table = spark.range(3).withColumnRenamed("id", "k2")
    with pytest.raises(J.JoinNotSupported):
        J.join(stream, table, F.col("k") == F.col("k2"), "full")
    with pytest.raises(J.JoinNotSupported):
        J.join(table, stream, F.col("k") == F.col("k2"), "left")
    with pytest.raises(J.JoinNotSupported):
        J.join(stream, stream.withColumnRenamed("k", "k2"), F.col("k") == F.col("k2"), "left")
    with pytest.raises(ValueError):
        J.join(table, table, "k2", None)


def test_bucketed_sessions_equal_session_window(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("user_id", "ts")
    # a dense hot key: one event a minute for five hours, chaining across buckets,
    # plus events exactly one gap apart
    hot = spark.range(0, 300).select(F.lit(-1).cast("long").alias("user_id"),
                                     (F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
                                      + F.expr("make_dt_interval(0, 0, 0, 0)")
                                      + F.col("id") * F.expr("INTERVAL 60 SECONDS")).alias("ts"))
    edge = spark.createDataFrame([(-2, "2024-01-03 00:00:00"), (-2, "2024-01-03 00:05:00"),
                                  (-2, "2024-01-03 00:10:00.000001")], "user_id long, t string") \
        .select("user_id", F.col("t").cast("timestamp_ntz").alias("ts"))
    df = ev.unionByName(hot).unionByName(edge)
    want = W.session_agg(df, "ts", "user_id", "5 minutes", [F.count(F.lit(1)).alias("n")])
    got = W.sessions_bucketed(df, "ts", "user_id", 300)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    hot_sessions = got.filter("user_id = -1").collect()
    assert len(hot_sessions) == 1 and hot_sessions[0].n == 300


def test_kafka_source_is_gated_on_the_package(spark):
    from eventloom.sources.topics import read_topic
    try:
        df = read_topic(spark, topics="t", starting={"t": {0: 5}},
                        kafka_options={"kafka.bootstrap.servers": "localhost:9092"})
    except Exception as e:  # the Kafka package is not deployed here
        assert "kafka" in str(e).lower()
    else:  # with the package, the envelope schema is Kafka's own
        assert df.columns[:5] == ["key", "value", "topic", "partition", "offset"]


def test_station_csv_rejects_nulls_and_duplicate_keys(spark, tmp_path):
    from eventloom.plans import feeds as FD
    from eventloom.schemas import STATION
    from eventloom.sources.files import read_csv_table
    st = FD.supplier_stations(spark, "/root/testdata/sf0.001")
    n = st.count()
    bad = spark.createDataFrame(
        [(None, "E", "x", "x", "x", 1, 1, True, False, False),        # stop_id missing
         (0, "E", "dup", "dup", "dup", 0, 0, False, False, True)],    # stop_id 0 again
        "stop_id int, direction_id string, stop_name string, station_name string, "
        "station_descriptive_name string, station_id int, order int, red boolean, blue boolean, green boolean")
    path = str(tmp_path / "stations_csv")
    st.unionByName(bad).coalesce(1).write.option("header", True).csv(path)
    good, rejects = read_csv_table(spark, path, STATION, key=["stop_id"], order_by=["order", "stop_id"])
    assert good.count() == n - 1            # both rows with stop_id 0 are set aside
    assert rejects.count() == 3
    orders = [r.order for r in good.select("order").collect()]
    assert orders == sorted(orders)


def test_running_value_in_hopping_windows_brute_force(spark):
    import datetime as dt
    rows = [(i, dt.datetime(2024, 1, 1, 0, 0, 0) + dt.timedelta(seconds=7 * i), "k" if i % 3 else "j", float(i))
            for i in range(40)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, k string, v double")
    got = {(r.id, r.window_start): r.current for r in
           W.running_in_window(df, "ts", "k", "v", "60 seconds", ["id"], slide="20 seconds").collect()}
    want = {}
    for i, t, k, v in rows:
        sec = int((t - dt.datetime(2024, 1, 1)).total_seconds())
        for start in range(sec - sec % 20 - 40, sec + 1, 20):
            if start <= sec < start + 60:
                ws = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=start)
                want[(i, ws)] = round(sum(v2 for i2, t2, k2, v2 in rows if k2 == k and i2 <= i
                                          and ws <= t2 < ws + dt.timedelta(seconds=60)), 2)
    assert got == want


def test_python_processor_agrees_with_builtin(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    a = ev.transform(S.with_score).select("event_id", "score")
    b = ev.select("event_id", S.click_score("event_id", "user_id").alias("score"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_split_running_value_equals_plain(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    hot = ev.withColumn("event_type", F.lit("hot")).withColumn("event_id", F.col("event_id") + 1_000_000)
    df = ev.unionByName(hot)
    plain = W.running_in_window(df, "ts", "event_type", "value", "1 day", ["event_id"])
    split = W.running_in_window(df, "ts", "event_type", "value", "1 day", ["event_id"], split="1 hour")
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def test_demux_tag_matches_two_way_split(spark):
    df = spark.createDataFrame([("a customerName x",), ("loc",), ("customerName",), (None,)], "m string")
    yes, no, rejects = D.demux(df, "m", "customerName")
    tagged = D.demux_tag(df, "m", "customerName", "customer", "location")
    assert sorted(r.m for r in tagged.filter("kind = 'customer'").collect()) == sorted(r.m for r in yes.collect())
    assert sorted(r.m for r in tagged.filter("kind = 'location'").collect()) == sorted(r.m for r in no.collect())
    # a member that did not decode is neither kind, in both forms
    assert rejects.count() == tagged.filter("kind IS NULL").count() == 1


def test_pane_hopping_sum_equals_window_expansion(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    a = W.hopping_sum(ev, "ts", "event_type", "value", "60 seconds", "10 seconds")
    b = W.hopping_sum(ev, "ts", "event_type", "value", "60 seconds", "10 seconds", panes=True)
    assert a.dtypes == b.dtypes
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    with pytest.raises(ValueError):
        W.hopping_sum(ev, "ts", "event_type", "value", "60 seconds", "7 seconds", panes=True)


def test_pane_hopping_count_equals_window_expansion(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    a = W.hopping_count(ev, "ts", "event_type", "30 seconds", "5 seconds")
    b = W.hopping_count(ev, "ts", "event_type", "30 seconds", "5 seconds", panes=True)
    assert a.dtypes == b.dtypes
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_kafka_start_timestamp_is_epoch_millis():
    from eventloom.sources.topics import _epoch_millis
    assert _epoch_millis("1970-01-01 00:00:01") == 1000
    assert _epoch_millis("2024-01-16T00:00:00+01:00") == 1705359600000


def test_derived_folder_built_once_and_reused(spark):
    from eventloom import session
    calls = []

    def build(path):
        calls.append(path)
        spark.range(3).write.mode("overwrite").parquet(path)

    inputs = ["/root/testdata/sf0.001/region.parquet"]
    name = f"unit-{len(session._MEMO)}-{id(calls)}"
    p1 = session.derived_path(spark, name, inputs, build)
    session._MEMO.clear()                      # as a new process would
    p2 = session.derived_path(spark, name, inputs, build)
    assert p1 == p2 and len(calls) == 1 and spark.read.parquet(p2).count() == 3
    assert session.path_exists(spark, p2 + "/_EVENTLOOM_COMPLETE")
    session._MEMO.clear()
    session.REUSE_DERIVED = False
    try:
        p3 = session.derived_path(spark, name, inputs, build)
    finally:
        session.REUSE_DERIVED = True
        session._MEMO.clear()
    assert p3 != p1 and len(calls) == 2


def _null_events(spark):
    rows = [(1, "k", "2024-01-01 00:00:01", 1.0), (2, "k", "2024-01-01 00:01:30", None), (3, "k", None, 5.0),
            (4, None, "2024-01-01 00:00:02", None), (5, None, "2024-01-01 00:02:00", 2.0), (6, None, None, None),
            (7, "k", "2024-01-02 00:00:00", 4.0)]
    return spark.createDataFrame(rows, "event_id long, event_type string, t string, value double") \
        .select("event_id", "event_type", F.col("t").cast("timestamp_ntz").alias("ts"), "value")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_window_tags_keep_rows_without_time(spark):
    df = _null_events(spark)
    got = W.assign_window(df, "ts", "30 seconds")
    assert got.count() == df.count()
    assert {r.event_id for r in got.filter("window_start IS NULL").collect()} == {3, 6}
    timed = df.select("event_id", F.window("ts", "30 seconds").getField("start").cast("timestamp_ntz").alias("window_start"))
    assert same(got.filter("ts IS NOT NULL").select("event_id", "window_start"), timed)


def test_split_running_value_keeps_null_keys_and_values(spark):
    df = _null_events(spark)
    plain = W.running_in_window(df, "ts", "event_type", "value", "10 minutes", ["event_id"])
    split = W.running_in_window(df, "ts", "event_type", "value", "10 minutes", ["event_id"], split="1 minute")
    assert plain.count() == df.count() and same(plain, split)


def test_previous_in_key_carries_over_null_keys(spark):
    from pyspark.sql import Window
    df = _null_events(spark).filter("ts IS NOT NULL")
    w = Window.partitionBy("event_type").orderBy("ts", "event_id")
    want = df.withColumn("prev_event_id", F.lag("event_id").over(w))
    for bucket in ("1 minute", "1 day"):
        assert same(W.previous_in_key(df, "event_type", "ts", ["event_id"], ["event_id"], bucket=bucket), want)
    assert W.previous_in_key(_null_events(spark), "event_type", "ts", ["event_id"], ["event_id"]).count() == 7


def test_flagged_rejects_equal_the_split(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    good, bad = D.split_rejects(df, ["y"])
    flagged = D.flag_rejects(df, ["y"])
    assert same(flagged.filter("is_reject").drop("is_reject"), bad)
    assert same(flagged.filter("NOT is_reject").drop("is_reject"), good)
