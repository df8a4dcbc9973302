"""Streaming twins: each operator run as a stream (availableNow over replay
files) gives the same result as its batch form."""

from pyspark.sql import functions as F

from eventloom.functions import decode as D
from eventloom.operators import aggregates as A
from eventloom.operators import joins as J
from eventloom.operators import tables as T
from eventloom.operators import windows as W
from eventloom.plans import feeds as FD
from eventloom.plans import registry as REG
from eventloom.schemas import CLICK_EVENT
from eventloom.sources.topics import read_topic
from eventloom.streaming import runner as RN
from eventloom.streaming import state as ST
from conftest import SF_MID

SF = SF_MID


def stream_clicks(spark):
    return REG.clicks(spark, SF, stream=True)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_static_left_join(spark):
    table = spark.read.parquet(f"{SF}/customer.parquet").filter("c_mktsegment <> 'BUILDING'") \
        .select("c_custkey", "c_name")
    s = J.join(stream_clicks(spark).select("event_id", "user_id"), table,
               F.col("user_id") == F.col("c_custkey"), "left")
    out, _ = RN.run_available(s, REG._uid("t_left"))
    batch = J.join(REG.clicks(spark, SF).select("event_id", "user_id"), table,
                   F.col("user_id") == F.col("c_custkey"), "left")
    assert same(spark.read.parquet(out), batch)


def test_stream_sum_complete_mode(spark):
    s = A.sum_by_key(stream_clicks(spark), "event_type", "value", "total", 2)
    name = REG._uid("t_sum")
    RN.run_available(s, name, fmt="memory", output_mode="complete")
    assert same(spark.table(name), A.sum_by_key(REG.clicks(spark, SF), "event_type", "value", "total", 2))


def test_stream_latest_update_mode_folds_to_table(spark):
    s = T.latest(stream_clicks(spark), "user_id", ["ts", "event_id"])
    name = REG._uid("t_latest")
    RN.run_available(s, name, fmt="memory", output_mode="update")
    # update mode repeats keys across batches; folding keeps the newest row
    folded = T.latest(spark.table(name), "user_id", ["ts", "event_id"])
    assert same(folded, T.latest(REG.clicks(spark, SF), "user_id", ["ts", "event_id"]))


def test_stream_session_windows(spark):
    s = W.event_time(stream_clicks(spark), "ts", "1 minute")
    agg = W.session_agg(s, "ts", "user_id", "5 minutes", [F.count(F.lit(1)).alias("n")])
    name = REG._uid("t_sess")
    RN.run_available(agg, name, fmt="memory", output_mode="complete")
    batch = W.session_agg(REG.clicks(spark, SF), "ts", "user_id", "5 minutes", [F.count(F.lit(1)).alias("n")])
    assert same(spark.table(name), batch)


def test_stream_top_k_bounded_state(spark):
    s = ST.top_k_stream(stream_clicks(spark), "event_type", "value", 5)
    name = REG._uid("t_topk")
    RN.run_available(s, name, fmt="memory", output_mode="update")
    got = T.latest(spark.table(name).withColumn("_one", F.lit(1)), ["event_type", "pos"], ["version"],
                   ["value"])
    want = A.top_k(REG.clicks(spark, SF), "event_type", "value", 5).select("event_type", "pos", "value")
    assert same(got, want)


def test_stream_running_window_value(spark):
    s = ST.running_in_window_stream(stream_clicks(spark), "ts", "event_type", "value", 600, ["event_id"],
                                    watermark="1 minute")
    out, _ = RN.run_available(s, REG._uid("t_current"))
    got = spark.read.parquet(out).select("event_id", "event_type", "window_start",
                                         F.round("current", 1).alias("c"))
    want = W.running_in_window(REG.clicks(spark, SF), "ts", "event_type", "value", "10 minutes",
                               ["event_id"]).select("event_id", "event_type", "window_start",
                                                    F.round("current", 1).alias("c"))
    assert same(got, want)


def test_stream_stream_flagship_equals_batch(spark):
    df = REG.QUERIES["sink_topic"](spark, SF)
    batch = REG.QUERIES["join_ss_risk"](spark, SF)
    assert same(df, batch)


def test_late_rows_dropped_and_counted(spark):
    from eventloom.session import scratch_path
    from eventloom.sources.topics import write_topic
    env = read_topic(spark, FD.bus(spark, SF, FD.CLICKS), topics=FD.CLICKS)
    path = scratch_path(spark, REG._uid("late_replay"))
    cut = "2024-01-20 00:00:00"
    on_time = env.filter(F.col("timestamp") < F.lit(cut).cast("timestamp"))
    rest = env.filter(F.col("timestamp") >= F.lit(cut).cast("timestamp"))
    late = on_time.filter(F.col("timestamp") < F.lit("2024-01-05").cast("timestamp")) \
        .withColumn("offset", F.col("offset") + 10_000_000)
    for part in (on_time, rest, late):          # the late file arrives last
        write_topic(part, path)
    s = D.parse_json(read_topic(spark, path, topics=FD.CLICKS, stream=True, max_files_per_trigger=1),
                     "value", CLICK_EVENT)
    s = W.event_time(s, "ts", "10 seconds")
    agg = W.windowed_agg(s, "ts", "event_type", [F.count(F.lit(1)).alias("n")], "1 hour")
    files_per_part = [len(spark.read.parquet(path).inputFiles())]
    assert files_per_part[0] >= 3
    out, progress = RN.run_available(agg, REG._uid("late"))
    # The metric counts rows at the stateful operator's input, i.e. after the
    # partial aggregate: grouped late rows, not raw events.
    assert 0 < RN.dropped_by_watermark(progress) <= late.count()
    ev = REG.clicks(spark, SF)
    batch = W.windowed_agg(ev, "ts", "event_type", [F.count(F.lit(1)).alias("n")], "1 hour")
    closed = W.closed_windows(batch, ev.select(F.max("ts")).scalar(), 10)
    assert same(spark.read.parquet(out), closed)


def test_stream_stream_left_outer_with_watermarks(spark):
    def side():
        return stream_clicks(spark)

    def shape(df, stream):
        views = df.filter(F.col("event_type") == "view").select(
            "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
        buys = df.filter(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("p_id"), F.col("user_id").alias("p_user"),
            F.col("ts").cast("timestamp").alias("p_ts"))
        cond = F.col("user_id") == F.col("p_user")
        bound = (F.col("p_ts") >= F.col("ts")) & (F.col("p_ts") <= F.col("ts") + F.expr("INTERVAL 6 HOURS"))
        if stream:
            return J.join(views, buys, cond, "left", left_watermark=("ts", "1 minute"),
                          right_watermark=("p_ts", "1 minute"), time_bound=bound)
        return views.join(buys, cond & bound, "left")

    s = shape(side(), True).select("event_id", "p_id")
    out, _ = RN.run_available(s, REG._uid("t_outer"))
    got = spark.read.parquet(out)
    want = shape(REG.clicks(spark, SF), False).select("event_id", "p_id")
    # every matched pair is emitted; unmatched rows only once closed
    assert same(got.filter("p_id IS NOT NULL"), want.filter("p_id IS NOT NULL"))
    unmatched = got.filter("p_id IS NULL")
    assert unmatched.count() > 0 and unmatched.exceptAll(want.filter("p_id IS NULL")).count() == 0


def test_stream_two_level_decode(spark):
    from eventloom.schemas import CUSTOMER_RECORD
    s = D.decode_two_level(read_topic(spark, FD.bus(spark, SF, FD.CUSTOMERS), topics=FD.CUSTOMERS, stream=True),
                           CUSTOMER_RECORD)
    name = REG._uid("t_dec")
    RN.run_available(s, name, fmt="memory")
    assert same(spark.table(name), REG.QUERIES["dec_two_level"](spark, SF))


def test_stream_histogram_complete_mode(spark):
    s = A.histogram(stream_clicks(spark), "user_id", "event_type")
    name = REG._uid("t_hist")
    RN.run_available(s, name, fmt="memory", output_mode="complete")
    assert same(spark.table(name), A.histogram(REG.clicks(spark, SF), "user_id", "event_type"))


def test_stream_train_positions_fold_to_table(spark):
    from eventloom.schemas import ARRIVAL
    env = read_topic(spark, FD.bus(spark, SF, FD.ARRIVALS), pattern=FD.ARRIVALS_PATTERN,
                     stream=True)
    arr = D.parse_json(env, "value", ARRIVAL, keep=[F.col("offset").alias("event_id"),
                                                    F.col("timestamp").alias("ts")])
    s = T.train_positions(arr, "ts", "event_id", keep_order=True)
    name = REG._uid("t_pos")
    RN.run_available(s, name, fmt="memory", output_mode="update")
    folded = T.latest(spark.table(name), ["line", "station_id", "direction"], ["ts", "event_id", "seq"],
                      ["train_id", "train_status"])
    assert same(folded, REG.QUERIES["tbl_train_position"](spark, SF))


def test_restart_from_checkpoint_resumes_state_exactly_once(spark):
    from eventloom.session import scratch_path
    from eventloom.sources.topics import write_topic
    env = read_topic(spark, FD.bus(spark, SF, FD.CLICKS), topics=FD.CLICKS)
    src = scratch_path(spark, REG._uid("resume_src"))
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp")
    write_topic(env.filter(F.col("timestamp") < cut), src, mode="overwrite")
    name = REG._uid("resume")
    out = RN.sink_path(spark, name)

    def run():
        s = D.parse_json(read_topic(spark, src, topics=FD.CLICKS, stream=True, max_files_per_trigger=4),
                         "value", CLICK_EVENT)
        s = W.event_time(s, "ts", "10 seconds")
        agg = W.windowed_agg(s, "ts", "event_type", [F.count(F.lit(1)).alias("n")], "1 hour")
        # same query name → same checkpoint folder → resumes offsets and state
        return RN.run_available(agg, name, path=out)

    assert RN.checkpoint_for(spark, name).endswith(f"/eventloom/checkpoints/{name}")

    run()
    first = spark.read.parquet(out).count()
    write_topic(env.filter(F.col("timestamp") >= cut), src)   # new files arrive
    run()
    got = spark.read.parquet(out)
    ev = REG.clicks(spark, SF)
    batch = W.windowed_agg(ev, "ts", "event_type", [F.count(F.lit(1)).alias("n")], "1 hour")
    want = W.closed_windows(batch, ev.select(F.max("ts")).scalar(), 10)
    assert 0 < first < got.count()
    assert same(got, want)


def test_upsert_latest_table_from_stream(spark):
    from eventloom.session import scratch_path
    from eventloom.streaming import tables as ST2
    path = scratch_path(spark, REG._uid("latest_table"))
    s = stream_clicks(spark)
    ST2.upsert_latest(s, ["user_id"], ["ts", "event_id"], path, REG._uid("upsert"), buckets=16,
                      state_partitions=8)
    got = ST2.read_table(spark, path).select(*REG.clicks(spark, SF).columns)
    want = T.latest(REG.clicks(spark, SF), "user_id", ["ts", "event_id"]).select(*got.columns)
    assert same(got, want)
    # replaying a batch changes nothing
    batch = REG.clicks(spark, SF).filter("event_id < 500")
    ST2.merge_batch(spark, batch, ["user_id"], ["ts", "event_id"], path, 16, 999)
    assert same(ST2.read_table(spark, path).select(*got.columns), want)


def test_live_status_board_from_streams(spark):
    """Dashboard fan-in: arrivals stream into a materialised positions table;
    the board over the live tables equals the batch board."""
    from eventloom.schemas import ARRIVAL
    from eventloom.session import scratch_path
    from eventloom.streaming import tables as ST2
    from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType
    env = read_topic(spark, FD.bus(spark, SF, FD.ARRIVALS), pattern=FD.ARRIVALS_PATTERN, stream=True, max_files_per_trigger=4)
    arr = D.parse_json(env, "value", ARRIVAL, keep=[F.col("offset").alias("event_id"),
                                                    F.col("timestamp").cast("timestamp_ntz").alias("ts")])
    path = scratch_path(spark, REG._uid("positions"))
    ST2.upsert_latest(T.platform_updates(arr, "ts", "event_id"), ["line", "station_id", "direction"],
                      ["ts", "event_id", "seq"], path, REG._uid("positions"), buckets=8, state_partitions=8)
    positions = ST2.read_table(spark, path)
    st = D.parse_json(read_topic(spark, FD.bus(spark, SF, FD.STATIONS_TOPIC), topics=FD.STATIONS_TOPIC), "value",
                      StructType([StructField("station_id", IntegerType()), StructField("station_name", StringType()),
                                  StructField("order", IntegerType()), StructField("line", StringType())]))
    cnt = D.parse_json(read_topic(spark, FD.bus(spark, SF, FD.SUMMARY_TOPIC), topics=FD.SUMMARY_TOPIC), "value",
                       StructType([StructField("STATION_ID", IntegerType()), StructField("COUNT", LongType())]))
    cnt = cnt.select(F.col("STATION_ID").alias("station_id"), F.col("COUNT").alias("count"))
    live = T.status_board(st, positions, cnt)
    assert same(live, REG.QUERIES["tbl_status_board"](spark, SF))


def test_rate_limited_read_pulls_bounded_batches(spark):
    path = FD.bus(spark, SF, FD.CLICKS)
    files = spark.read.parquet(f"{path}/topic={FD.CLICKS}").inputFiles()
    s = read_topic(spark, path, topics=FD.CLICKS, stream=True, max_files_per_trigger=1)
    _, progress = RN.run_available(D.cast_strings(s), REG._uid("bounded1"), fmt="noop")
    rows = [p["numInputRows"] for p in progress if p["numInputRows"] > 0]
    per_file = max(spark.read.parquet(f).count() for f in files)
    assert len(rows) == len(files) and max(rows) <= per_file
    assert sum(rows) == REG.clicks(spark, SF).count()


def test_stream_running_value_in_hopping_windows(spark):
    s = ST.running_in_window_stream(stream_clicks(spark), "ts", "event_type", "value", 600, ["event_id"],
                                    watermark="1 minute", slide_seconds=300)
    out, _ = RN.run_available(s, REG._uid("t_current_hop"), state_partitions=8)
    got = spark.read.parquet(out).select("event_id", "event_type", "window_start",
                                         F.round("current", 1).alias("c"))
    want = W.running_in_window(REG.clicks(spark, SF), "ts", "event_type", "value", "10 minutes", ["event_id"],
                               slide="5 minutes").select("event_id", "event_type", "window_start",
                                                         F.round("current", 1).alias("c"))
    assert same(got, want)


def test_stream_windowed_top_k(spark):
    s = ST.top_k_stream(stream_clicks(spark), "event_type", "value", 3, ts="ts", window_seconds=86400,
                        watermark="1 hour")
    name = REG._uid("t_wtopk")
    RN.run_available(s, name, fmt="memory", output_mode="update", state_partitions=8)
    got = T.latest(spark.table(name), ["event_type", "window_start", "pos"], ["version"], ["value"])
    want = W.windowed_top_k(REG.clicks(spark, SF), "ts", "event_type", "value", 3, "1 day") \
        .select("event_type", "window_start", "pos", "value")
    assert same(got.select(*want.columns), want)


def test_stream_starts_at_time_and_offsets(spark):
    start = "2024-01-16 00:00:00"
    s = read_topic(spark, FD.bus(spark, SF, FD.CLICKS), topics=FD.CLICKS, stream=True, starting=start)
    name = REG._uid("t_start")
    RN.run_available(D.cast_strings(s).select("key", "offset"), name, fmt="memory")
    batch = read_topic(spark, FD.bus(spark, SF, FD.CLICKS), topics=FD.CLICKS, starting=start)
    assert same(spark.table(name), D.cast_strings(batch).select("key", "offset"))
    p0 = {"clickevents": {0: 5000}}
    s2 = read_topic(spark, FD.bus(spark, SF, FD.CLICKS), topics=FD.CLICKS, stream=True, starting=p0)
    name2 = REG._uid("t_start2")
    RN.run_available(s2.select("partition", "offset"), name2, fmt="memory")
    got = spark.table(name2)
    assert got.filter("partition = 0 AND offset < 5000").count() == 0
    assert got.filter("partition <> 0").count() == \
        read_topic(spark, FD.bus(spark, SF, FD.CLICKS), topics=FD.CLICKS).filter("partition <> 0").count()


def test_limited_run_raises_instead_of_returning_partial_output(spark):
    import pytest
    with pytest.raises(RN.NotFinished):
        RN.run_available(stream_clicks(spark), REG._uid("limited"), timeout_s=0.01, trigger={"processingTime": "1 second"})


def test_started_query_outlives_triggers_until_stopped(spark):
    import time
    from eventloom.session import scratch_path
    from eventloom.sources.topics import write_topic
    env = read_topic(spark, FD.bus(spark, SF, FD.CLICKS), topics=FD.CLICKS)
    src = scratch_path(spark, REG._uid("running_src"))
    write_topic(env.filter("offset < 100"), src)
    name = REG._uid("running")
    q = RN.start(read_topic(spark, src, topics=FD.CLICKS, stream=True), name, path=RN.sink_path(spark, name),
                 trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        time.sleep(3)
        assert q.isActive
        write_topic(env.filter("offset >= 100 and offset < 300"), src)
        q.processAllAvailable()
        assert q.isActive and spark.read.parquet(RN.sink_path(spark, name)).count() == 300
    finally:
        q.stop()


def test_all_progress_reports_are_kept(spark):
    path = FD.bus(spark, SF, FD.CLICKS)
    files = len(spark.read.parquet(f"{path}/topic={FD.CLICKS}").inputFiles())
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        s = read_topic(spark, path, topics=FD.CLICKS, stream=True, max_files_per_trigger=1)
        _, progress = RN.run_available(D.cast_strings(s), REG._uid("reports"), fmt="noop")
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert sum(p["numInputRows"] > 0 for p in progress) == files


def test_replay_of_many_files_per_slice_loses_nothing(spark):
    from eventloom.session import scratch_path
    from eventloom.sources.topics import replay, replay_slices
    env = read_topic(spark, FD.bus(spark, SF, FD.CLICKS), topics=FD.CLICKS)
    slices = [s.repartition(24) for s in replay_slices(env, scratch_path(spark, REG._uid("cut")), 3)]
    topic, name = scratch_path(spark, REG._uid("many")), REG._uid("many")
    dropped = []

    def step():
        s = D.parse_json(read_topic(spark, topic, topics=FD.CLICKS, stream=True), "value", CLICK_EVENT)
        agg = W.windowed_agg(W.event_time(s, "ts", "10 seconds"), "ts", "event_type",
                             [F.count(F.lit(1)).alias("n")], "1 hour")
        _, progress = RN.run_available(agg, name, path=RN.sink_path(spark, name), state_partitions=8)
        dropped.append(RN.dropped_by_watermark(progress))

    replay(slices, topic, step)
    assert len(spark.read.parquet(topic).inputFiles()) >= 72 and not any(dropped)
    ev = REG.clicks(spark, SF)
    batch = W.windowed_agg(ev, "ts", "event_type", [F.count(F.lit(1)).alias("n")], "1 hour")
    assert same(spark.read.parquet(RN.sink_path(spark, name)), W.closed_windows(batch, ev.select(F.max("ts")).scalar(), 10))


def test_latest_table_survives_a_crash_at_every_file_step(spark, monkeypatch):
    import pytest
    from eventloom.session import scratch_path
    from eventloom.streaming import tables as ST2
    ev = REG.clicks(spark, SF).filter("event_id < 400").persist()
    first, second = ev.filter("event_id < 200"), ev.filter("event_id >= 200")
    want_old = T.latest(first, "user_id", ["ts", "event_id"])
    want = T.latest(ev, "user_id", ["ts", "event_id"])
    merge = lambda p, b, n: ST2.merge_batch(spark, b, ["user_id"], ["ts", "event_id"], p, 2, n, "q")
    steps = ["_buckets_written", "latest", "_publish", "_drop_old"]
    for fail_at in steps:
        path = scratch_path(spark, REG._uid("crash"))
        merge(path, first, 0)
        real = getattr(ST2, fail_at)

        def crash(*a, **k):
            raise OSError("crash")
        monkeypatch.setattr(ST2, fail_at, crash)
        with pytest.raises(OSError):
            merge(path, second, 1)
        monkeypatch.setattr(ST2, fail_at, real)
        seen = ST2.read_table(spark, path).select(*want.columns)
        assert same(seen, want if fail_at == "_drop_old" else want_old), fail_at
        merge(path, second, 1)  # the replayed batch
        assert same(ST2.read_table(spark, path).select(*want.columns), want), fail_at


def test_latest_table_grows_its_buckets_with_its_rows(spark, monkeypatch):
    from eventloom.session import scratch_path
    from eventloom.streaming import tables as ST2
    monkeypatch.setattr(ST2, "BUCKET_ROWS", 20)
    path = scratch_path(spark, REG._uid("grow"))
    ev = REG.clicks(spark, SF)
    for n in range(4):
        ST2.merge_batch(spark, ev.filter(F.col("event_id") % 4 == n), ["event_id"], ["ts"], path, 2, n, "q")
    assert ST2._load(spark, path, 4)["buckets"] == 16
    assert same(ST2.read_table(spark, path).select(*ev.columns), ev)


def test_bounded_state_joins_with_watermarks(spark):
    views = stream_clicks(spark).filter("event_type = 'view'").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    buys = stream_clicks(spark).filter("event_type = 'purchase'").select(
        F.col("user_id").alias("buyer"), F.col("ts").cast("timestamp").alias("b_ts"))
    bound = (F.col("b_ts") >= F.col("ts")) & (F.col("b_ts") <= F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    j = J.join(views, buys, F.col("user_id") == F.col("buyer"), "inner", ("ts", "1 minute"), ("b_ts", "1 minute"), bound)
    out, _ = RN.run_available(j, REG._uid("t_bound"), state_partitions=8)
    ev = REG.clicks(spark, SF)
    v = ev.filter("event_type = 'view'").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    b = ev.filter("event_type = 'purchase'").select(F.col("user_id").alias("buyer"), F.col("ts").cast("timestamp").alias("b_ts"))
    assert same(spark.read.parquet(out), v.join(b, (F.col("user_id") == F.col("buyer")) & bound))


def test_drop_guard_sees_readers_it_was_not_told_of(spark):
    import pytest
    from eventloom.plans import catalog as C
    view, name = REG._uid("guarded"), REG._uid("guard_reader")
    C.declare(spark, view, read_topic(spark, FD.bus(spark, SF, FD.CLICKS), topics=FD.CLICKS, stream=True), CLICK_EVENT)
    q = (spark.table(view).select("event_id").writeStream.queryName(name).format("noop")
         .option("checkpointLocation", RN.checkpoint_for(spark, name)).start())
    try:
        with pytest.raises(C.CatalogError):
            C.drop_view(spark, view)
    finally:
        q.stop()
    C.drop_view(spark, view)
