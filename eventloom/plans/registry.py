"""Registered queries (one per operator of SURVEY §2) and their SQL oracles.

Each query takes (spark, sf_dir) and returns a DataFrame computed by Spark
from the driver tables (directly, or from topics Spark derived from them);
each oracle is DuckDB SQL over the same tables with the same column names.
Sinks are read back and decoded, catalog actions return what they did.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, FloatType, IntegerType, LongType,
                               StringType, StructField, StructType,
                               TimestampNTZType)

from eventloom.functions import decode as D
from eventloom.functions import resolution as RS
from eventloom.functions import scalars as S
from eventloom.operators import aggregates as A
from eventloom.operators import asof as AO
from eventloom.operators import joins as J
from eventloom.operators import relational as R
from eventloom.operators import tables as T
from eventloom.operators import windows as W
from eventloom.plans import catalog as C
from eventloom.plans import feeds as FD
from eventloom.plans import persistent as PQ
from eventloom.schemas import (ARRIVAL, CLICK_EVENT, CUSTOMER_RECORD, LOCATION_RECORD,
                               RISK_EVENT)
from eventloom.session import configure, derived_path, scratch_path
from eventloom.sources import files as FS
from eventloom.sources import following as FW
from eventloom.sources import incremental as INC
from eventloom.sources.topics import publish_slice, read_topic, stage_slices, time_slices, write_topic
from eventloom.streaming import compaction as CP
from eventloom.streaming import joined as JD
from eventloom.streaming import late as LT
from eventloom.streaming import runner as RN
from eventloom.streaming import running as RG
from eventloom.streaming import sinks as SK
from eventloom.streaming import tables as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def q(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run
    return deco


# ---------------------------------------------------------------- helpers

def _t(spark, sf, name):
    return FD.table(spark, sf, name)


def _topic(spark, sf, topics=None, pattern=None, stream=False, **kw):
    """One topic's folder, or with ``pattern`` that of all arrival topics."""
    folder = FD.bus(spark, sf, topics if pattern is None else FD.ARRIVALS)
    return read_topic(spark, folder, topics=topics, pattern=pattern, stream=stream, **kw)


def _run_and_read(spark, df: DataFrame, name: str, **kw) -> DataFrame:
    """Run a stream over all available input into files, and read them back.
    The checkpoint of such a one-off run is dropped."""
    name = _uid(name)
    out, _ = RN.run_available(df, name, path=scratch_path(spark, name), state_partitions=_parallelism(spark), **kw)
    RN.drop_checkpoint(spark, name)
    return spark.read.schema(df.schema).parquet(out)


def _join_and_read(spark, left: DataFrame, right: DataFrame, on, name: str, finish=lambda df: df) -> DataFrame:
    """Join two streams over all available input into files, and read them back.
    History and checkpoint of such a one-off run are dropped."""
    name = _uid(name)
    out, _ = JD.join_streams(left, right, on, name, scratch_path(spark, name), finish)
    RN.drop_checkpoint(spark, name)
    schema = finish(J.join(left, right, on, "inner")).schema
    return spark.read.schema(schema).parquet(out).select(*schema.names)


def _join_to_topic(spark, left: DataFrame, right: DataFrame, on, name: str, finish) -> str:
    """Join two streams into a topic of the envelopes that ``finish`` makes; its folder."""
    name = _uid(name)
    path, _ = JD.join_streams(left, right, on, name, scratch_path(spark, name), finish, partition_by=("topic",))
    RN.drop_checkpoint(spark, name)
    return path


#: State of stream joins: on disk, one store per partition, written as changes.
JOIN_STATE = {**RG.SETTINGS, "spark.sql.streaming.join.stateFormatVersion": "3",
              "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def clicks(spark, sf, stream=False) -> DataFrame:
    """Decoded click events from the clickevents topic."""
    return D.parse_json(_topic(spark, sf, FD.CLICKS, stream=stream), "value", CLICK_EVENT)


def risk_join(customer_env: DataFrame, risk_env: DataFrame, keep=()) -> DataFrame:
    """Flagship: change-record customers (envelope → base64 → JSON) joined with
    risk-score events by e-mail; batch or stream. ``keep``: envelope columns of
    the risk events to carry along."""
    return J.join(*risk_sides(customer_env, risk_env, keep), "inner")


def risk_sides(customer_env: DataFrame, risk_env: DataFrame, keep=()) -> tuple[DataFrame, DataFrame, Column]:
    """The decoded sides of :func:`risk_join`, events first, and their condition."""
    cust = D.decode_two_level(customer_env, CUSTOMER_RECORD)
    cust = R.not_null(cust, ["email", "birthDay"]).select(
        "email", S.split_item("birthDay", "-", 0).alias("birthYear"))
    risk = D.parse_json(risk_env, "value", RISK_EVENT, keep=list(keep))
    risk = R.not_null(risk, ["customer", "score"]).select("customer", "score", *keep)
    return risk, cust, F.col("customer") == F.col("email")


def _parallelism(spark) -> int:
    """State partitions for the registered streams: one per core slot."""
    return spark.sparkContext.defaultParallelism


def _uid(name: str) -> str:
    import uuid
    return f"{name}_{uuid.uuid4().hex[:8]}"


EMAIL_SQL = "concat('customer', {k}, '@example.org')"
BIRTHDAY_SQL = "strftime(DATE '1940-01-01' + CAST(({k} * 37) % 21915 AS INTEGER), '%Y-%m-%d')"
LINE_SQL = ("CASE event_type WHEN 'click' THEN 'red' WHEN 'view' THEN 'blue' "
            "WHEN 'purchase' THEN 'green' WHEN 'error' THEN 'green' WHEN 'signup' THEN 'orange' END")
TRAIN_SQL = ("upper(left(event_type, 1)) || 'L' || CASE WHEN length(CAST(user_id AS VARCHAR)) >= 3 "
             "THEN CAST(user_id AS VARCHAR) ELSE lpad(CAST(user_id AS VARCHAR), 3, '0') END")
STATUS_SQL = "CASE WHEN value >= 100 THEN 'delayed' ELSE 'in_service' END"
STATION_SQL = "CAST(json_extract(props, '$.k') AS INTEGER)"
RISK_SQL = f"""
SELECT {EMAIL_SQL.format(k='o_custkey')} AS customer, CAST(o_totalprice AS FLOAT) AS score,
       {EMAIL_SQL.format(k='c_custkey')} AS email,
       split_part({BIRTHDAY_SQL.format(k='c_custkey')}, '-', 1) AS birthYear
FROM orders JOIN customer ON o_custkey = c_custkey"""
CUSTOMER_RECORD_SQL = f"""
SELECT c_name AS customerName, {EMAIL_SQL.format(k='c_custkey')} AS email,
       '555010' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
       {BIRTHDAY_SQL.format(k='c_custkey')} AS birthDay,
       CAST(c_custkey AS VARCHAR) AS accountNumber, n_name AS location
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""
ARRIVALS_SQL = f"""
SELECT event_id, ts, user_id, {STATION_SQL} AS station_id, {TRAIN_SQL} AS train_id,
       CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS direction,
       {LINE_SQL} AS line, {STATUS_SQL} AS train_status
FROM events"""
POSITIONS_SQL = f"""
WITH a AS ({ARRIVALS_SQL}),
arr AS (SELECT *, lag(station_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_station_id,
               lag(direction) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_direction FROM a),
upd AS (
  SELECT line, prev_station_id AS station_id,
         CASE WHEN prev_direction = 'a' THEN 'a' ELSE 'b' END AS direction,
         CAST(NULL AS VARCHAR) AS train_id, CAST(NULL AS VARCHAR) AS train_status, ts, event_id, 0 AS seq
  FROM arr WHERE prev_station_id IS NOT NULL AND prev_direction IS NOT NULL
  UNION ALL
  SELECT line, station_id, CASE WHEN direction = 'a' THEN 'a' ELSE 'b' END,
         train_id, train_status, ts, event_id, 1 FROM arr)
SELECT line, station_id, direction, train_id, train_status FROM upd
QUALIFY row_number() OVER (PARTITION BY line, station_id, direction
                           ORDER BY ts DESC, event_id DESC, seq DESC) = 1"""
STATIONS_T_SQL = """
SELECT n_nationkey AS station_id, n_name AS station_name, n_nationkey AS "order",
       CASE WHEN r_regionkey IN (0, 3) THEN 'red' WHEN r_regionkey IN (1, 3) THEN 'blue'
            WHEN r_regionkey = 2 THEN 'green' END AS line
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""
INITCAP_SQL = ("array_to_string(list_transform(string_split(lower({x}), ' '), "
               "lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')")


# ---------------------------------------------------------------- sources

@q("src_topic", """
SELECT CAST(user_id AS VARCHAR) AS key, 'clickevents' AS topic, event_id AS msg_offset,
       ts AS msg_timestamp FROM events""")
def src_topic(spark, sf):
    """Read one topic from the earliest offset (envelope columns)."""
    env = _topic(spark, sf, FD.CLICKS, starting="earliest")
    return env.select(F.col("key").cast("string").alias("key"), "topic",
                      F.col("offset").alias("msg_offset"),
                      F.col("timestamp").cast("timestamp_ntz").alias("msg_timestamp"))


@q("src_topic_pattern", f"""
SELECT concat('transit.station.arrivals.', {LINE_SQL}) AS topic,
       CAST(event_id AS VARCHAR) AS key, event_id AS msg_offset FROM events""")
def src_topic_pattern(spark, sf):
    """Subscribe to every topic matching a regex and keep the topic name."""
    env = _topic(spark, sf, pattern=FD.ARRIVALS_PATTERN)
    return env.select("topic", F.col("key").cast("string").alias("key"),
                      F.col("offset").alias("msg_offset"))


@q("src_offsets", """
SELECT CAST(user_id AS VARCHAR) AS key, event_id AS msg_offset FROM events
WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'""")
def src_offsets(spark, sf):
    """Start a topic read at a position (here: the first offset stamped at or
    after a time; offsets per partition and earliest/latest work the same)."""
    env = _topic(spark, sf, FD.CLICKS, starting="2024-01-16 00:00:00")
    return env.select(F.col("key").cast("string").alias("key"), F.col("offset").alias("msg_offset"))


@q("src_bounded_batch", "SELECT CAST(count(*) AS BIGINT) AS rows, true AS within_limit FROM events")
def src_bounded_batch(spark, sf):
    """Pull at most n messages per micro-batch (here a sixth of the topic, less
    than a file holds): each batch writes its number of rows under its id; the
    rows of all batches and whether each kept within the limit are returned."""
    path = FD.bus(spark, sf, FD.CLICKS)
    limit = max(1, read_topic(spark, path, topics=FD.CLICKS).count() // 6)
    name = _uid("bounded")
    base = scratch_path(spark, name)

    def count(batch: DataFrame, batch_id: int) -> None:
        (batch.agg(F.count(F.lit(1)).alias("rows"))
         .write.mode("overwrite").parquet(f"{base}/batch_id={batch_id}"))

    s = FW.pull_messages(spark, path, limit, RN.checkpoint_for(spark, name), topic=FD.CLICKS)
    RN.run_caught_up(s, name, foreach_batch=count)
    RN.drop_checkpoint(spark, name)
    return spark.read.schema("rows long, batch_id long").parquet(base).agg(
        F.sum("rows").alias("rows"), ((F.max("rows") <= limit) & (F.count(F.lit(1)) >= 6)).alias("within_limit"))


def _doc_lines(spark, sf) -> str:
    return derived_path(spark, "doc_lines", FD.table_paths(sf, ["documents"]),
                        lambda path: FS.write_lines(_t(spark, sf, "documents"), "text", path))


@q("src_text", "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def src_text(spark, sf):
    """A text file as one row per line in column ``value``."""
    return FS.read_text(spark, _doc_lines(spark, sf))


@q("src_text_stream", "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def src_text_stream(spark, sf):
    """Follow a folder of text files as a stream of lines."""
    return _run_and_read(spark, FS.read_text_stream(spark, _doc_lines(spark, sf)), "text_stream")


@q("src_text_follow", "SELECT unnest(string_split(text, chr(10))) AS value FROM documents")
def src_text_follow(spark, sf):
    """Follow text files that are appended to: the lines of files cut anywhere,
    then, when the stream starts again, of what was added to the same files."""
    whole, name = _doc_lines(spark, sf), _uid("follow")
    grown, out = scratch_path(spark, f"{name}-files"), scratch_path(spark, name)
    lines = FW.follow_lines(spark, grown, RN.checkpoint_for(spark, name))
    for share in (0.4, 1.0):
        FW.publish_files(spark, whole, grown, share)
        RN.run_caught_up(lines, name, path=out)
    RN.drop_checkpoint(spark, name)
    return spark.read.schema(lines.schema).parquet(out).select("value")


@q("src_incremental", """
SELECT event_id, ts, user_id, event_type, value, props,
       CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 1 ELSE 2 END AS load_no
FROM events""")
def src_incremental(spark, sf):
    """Load rows above the last high-water mark of an increasing column: the
    table as it stood on Jan 16, then the whole table."""
    ev = _t(spark, sf, "events")
    base = scratch_path(spark, _uid("incremental"))
    target, state = f"{base}/rows", f"{base}/marks"
    INC.load_increment(spark, ev.filter(F.col("ts") < F.lit(FD.DRIFT_START).cast("timestamp_ntz")),
                       "event_id", target, state)
    INC.load_increment(spark, ev, "event_id", target, state)
    return INC.read_loaded(spark, target).select(*ev.columns, F.col("load_no").cast("int"))


@q("src_incremental_stream", """
SELECT 'db-events' AS topic, event_id AS mark, event_type AS label, value AS amount,
       CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 1 ELSE 2 END AS load_no FROM events
UNION ALL SELECT 'db-customer', c_custkey, c_name, c_acctbal, 1 FROM customer""")
def src_incremental_stream(spark, sf):
    """A running incremental load of two whitelisted tables, whose marks are the
    stream's offset: the events as they stood on Jan 16 and the customers; then,
    when the stream starts again, the events added since."""
    ev, name = _t(spark, sf, "events"), _uid("increments")
    base = scratch_path(spark, name)
    before = F.col("ts") < F.lit(FD.DRIFT_START).cast("timestamp_ntz")
    tables = {"events": (f"{base}/events", "event_id"), "customer": (f"{sf.rstrip('/')}/customer.parquet", "c_custkey")}
    fields = StructType([StructField("event_type", StringType()), StructField("value", DoubleType()),
                         StructField("c_name", StringType()), StructField("c_acctbal", DoubleType())])

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = D.parse_json(batch, "value", fields, keep=["topic", F.col("offset").alias("mark")])
        (rows.select("topic", "mark", F.coalesce("event_type", "c_name").alias("label"), F.coalesce("value", "c_acctbal").alias("amount"))
         .write.mode("overwrite").parquet(f"{base}/loads/load_no={batch_id + 1}"))

    stream = FW.follow_tables(spark, tables, RN.checkpoint_for(spark, name), prefix="db-")
    for part in (ev.filter(before), ev.filter(~before)):
        part.write.mode("append").parquet(f"{base}/events")
        RN.run_caught_up(stream, name, foreach_batch=load)
    RN.drop_checkpoint(spark, name)
    return spark.read.schema("topic string, mark long, label string, amount double, load_no int").parquet(f"{base}/loads")


CUSTOMER_TABLE = StructType([
    StructField("c_custkey", LongType(), False), StructField("c_name", StringType(), False),
    StructField("c_nationkey", IntegerType(), True), StructField("c_acctbal", DoubleType(), True),
    StructField("c_mktsegment", StringType(), True)])


@q("src_csv_schema", "SELECT *, false AS is_reject FROM customer")
def src_csv_schema(spark, sf):
    """Headed CSV into a declared table; NOT NULL and key violations set aside."""
    path = derived_path(spark, "customer_csv", FD.table_paths(sf, ["customer"]),
                        lambda p: _t(spark, sf, "customer").write.mode("overwrite")
                        .option("header", True).csv(p))
    rows = FS.read_csv_flagged(spark, path, CUSTOMER_TABLE, key=["c_custkey"])
    return rows.withColumn("is_reject", F.col("reason").isNotNull()).drop("reason")


# ---------------------------------------------------------------- sinks

RISK_OUT = StructType([StructField("customer", StringType()), StructField("score", FloatType()),
                       StructField("email", StringType()), StructField("birthYear", StringType())])


def _read_back(spark, path, topic, schema) -> DataFrame:
    env = read_topic(spark, path, topics=topic)
    return D.parse_json(env, "value", schema, keep=[F.col("key").cast("string").alias("key")])


@q("sink_topic", RISK_SQL)
def sink_topic(spark, sf):
    """Stream–stream flagship written as key + JSON value to a topic with a
    checkpoint; the topic is read back and decoded."""
    cust = _topic(spark, sf, FD.CUSTOMERS, stream=True)
    risk = _topic(spark, sf, FD.RISK, stream=True)
    path = _join_to_topic(spark, *risk_sides(cust, risk, keep=["offset", "timestamp"]), "risk_information",
                          lambda j: SK.keyed_json(j, "customer", "risk-information", offset="offset", timestamp="timestamp",
                                                  cols=["customer", "score", "email", "birthYear"]))
    return _read_back(spark, path, "risk-information", RISK_OUT).drop("key")


@q("sink_topic_raw", "SELECT * FROM events")
def sink_topic_raw(spark, sf):
    """Forward key and value unchanged to a second topic."""
    s = _topic(spark, sf, FD.CLICKS, stream=True)
    fwd = s.select("key", "value", F.lit("clickevents-copy").alias("topic"), "partition",
                   "offset", "timestamp", "timestampType")
    path = scratch_path(spark, _uid("copy"))
    SK.to_topic(fwd, path, _uid("sink_raw"), state_partitions=_parallelism(spark))
    return D.parse_json(read_topic(spark, path, topics="clickevents-copy"), "value", CLICK_EVENT)


SANITIZED = StructType([f for f in CLICK_EVENT.fields if f.name != "user_id"])


@q("sink_keyed_send", """
SELECT event_type AS key, event_id, ts, event_type, value, props FROM events""")
def sink_keyed_send(spark, sf):
    """Re-key each (sanitized) click by its type and send it on."""
    s = R.sanitize(clicks(spark, sf, stream=True), ["user_id"])
    env = SK.keyed_json(s, "event_type", "clickevents-by-type", offset="event_id")
    path = scratch_path(spark, _uid("by_type"))
    SK.to_topic(env, path, _uid("sink_keyed"), state_partitions=_parallelism(spark))
    return _read_back(spark, path, "clickevents-by-type", SANITIZED)


@q("sink_console", "SELECT CAST(count(*) AS BIGINT) AS rows FROM events")
def sink_console(spark, sf):
    """Console sink: each micro-batch printed (first rows only reach the
    driver); returns the number of rows the batches carried."""
    base = scratch_path(spark, _uid("console"))
    SK.console_batches(clicks(spark, sf, stream=True), _uid("console"), base, num_rows=5,
                       state_partitions=_parallelism(spark))
    return spark.read.parquet(base).agg(F.sum("rows").cast("long").alias("rows"))


CSV_OPTS = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


@q("sink_csv", "SELECT event_id, ts, event_type, value FROM events")
def sink_csv(spark, sf):
    """CSV files per micro-batch with a checkpoint, read back with a schema."""
    s = clicks(spark, sf, stream=True).select("event_id", "ts", "event_type", "value")
    out, _ = SK.to_csv(s, _uid("csv"), options=CSV_OPTS, path=scratch_path(spark, _uid("csv_rows")),
                       state_partitions=_parallelism(spark))
    schema = StructType([StructField("event_id", LongType()), StructField("ts", TimestampNTZType()),
                         StructField("event_type", StringType()), StructField("value", DoubleType())])
    return spark.read.schema(schema).options(**CSV_OPTS).csv(out)


@q("sink_foreach", "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type")
def sink_foreach(spark, sf):
    """A side effect per micro-batch (each batch's counts written under its
    batch id, so a replayed batch overwrites itself); the written partial
    counts are then summed."""
    base = scratch_path(spark, _uid("foreach"))

    def write_counts(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
         .write.mode("overwrite").parquet(f"{base}/batch_id={batch_id}"))

    s = clicks(spark, sf, stream=True)
    SK.for_each_batch(s, _uid("foreach"), write_counts, state_partitions=_parallelism(spark))
    return spark.read.parquet(base).groupBy("event_type").agg(F.sum("n").cast("long").alias("n"))


# ---------------------------------------------------------------- decode / encode

@q("dec_strings", """
SELECT CAST(user_id AS VARCHAR) AS key, event_type AS value, event_id AS msg_offset FROM events""")
def dec_strings(spark, sf):
    """Binary key and value of a plain-text topic as strings."""
    env = D.cast_strings(_topic(spark, sf, FD.FUEL))
    return env.select("key", "value", F.col("offset").alias("msg_offset"))


@q("dec_json", "SELECT * FROM events")
def dec_json(spark, sf):
    """JSON values parsed with a declared schema and flattened."""
    return clicks(spark, sf)


@q("dec_envelope", """
SELECT 'CustomerBalance' AS set_key, c_name AS member, c_acctbal AS score FROM customer""")
def dec_envelope(spark, sf):
    """First sorted-set member (and its score) of each change record."""
    m = D.decode_change_members(_topic(spark, sf, FD.BALANCES))
    return m.select(F.col("key").alias("set_key"), "member", F.col("score").cast("double").alias("score"))


@q("dec_base64", """
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS decoded FROM customer""")
def dec_base64(spark, sf):
    """Base64 text decoded; invalid input (every 7th key is corrupted here)
    gives null instead of failing the job."""
    c = _t(spark, sf, "customer")
    enc = F.when(F.pmod(F.col("c_custkey"), F.lit(7)) == 0, F.concat(F.lit("!"), F.col("c_name"))) \
        .otherwise(D.encode_base64(F.col("c_name")))
    return c.select("c_custkey", D.decode_base64(enc).alias("decoded"))


@q("dec_two_level", CUSTOMER_RECORD_SQL)
def dec_two_level(spark, sf):
    """Envelope JSON → base64 member → inner JSON → columns."""
    return D.decode_two_level(_topic(spark, sf, FD.CUSTOMERS), CUSTOMER_RECORD)


@q("enc_json", """
SELECT CAST(c_custkey AS VARCHAR) AS key,
       CAST(json_object('c_custkey', c_custkey, 'c_name', c_name, 'c_mktsegment', c_mktsegment) AS VARCHAR) AS value
FROM customer""")
def enc_json(spark, sf):
    """Rows as keyed JSON messages."""
    return D.encode_json(_t(spark, sf, "customer"), "c_custkey", ["c_custkey", "c_name", "c_mktsegment"])


@q("dec_rejects", """
SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' THEN NULL ELSE user_id END AS user_id,
       ts >= TIMESTAMP '2024-01-16 00:00:00' AS is_reject FROM events""")
def dec_rejects(spark, sf):
    """After producer drift renamed a required field, the records missing it
    are set aside as rejects; the rest flows on."""
    parsed = D.parse_json(_topic(spark, sf, FD.DRIFT), "value", CLICK_EVENT)
    return D.flag_rejects(parsed, ["user_id"]).select("event_id", "user_id", "is_reject")


def _record(*fields: dict) -> dict:
    return {"type": "record", "name": "click", "fields": list(fields)}


def _field(name: str, of, **more) -> dict:
    return {"name": name, "type": of, **more}


#: Writers' schemas of the versioned click topic, by id: an integer user and whole
#: values; a renamed user; counts as a map of records; a type nobody can read.
CLICK_VERSIONS = {
    1: _record(_field("event_id", "long"), _field("user_id", "int"), _field("event_type", "string"), _field("value", ["null", "long"])),
    2: _record(_field("event_id", "long"), _field("user_ref", "long"), _field("event_type", "string"),
               _field("value", ["null", "double"]), _field("channel", "string")),
    3: _record(_field("event_id", "long"), _field("user_id", "long"), _field("event_type", "string"),
               _field("value", ["null", "double"]), _field("channel", "string"),
               _field("counts", {"type": "map", "values": {"type": "record", "name": "count", "fields": [_field("n", ["null", "int"])]}})),
    4: _record(_field("event_id", "long"), _field("user_id", "long"), _field("event_type", "long")),
}
CLICK_READER = _record(
    _field("event_id", "long"), _field("user_id", "long", aliases=["user_ref"]), _field("event_type", "string"),
    _field("value", ["null", "double"], default=None), _field("channel", "string", default="none"),
    _field("counts", {"type": "map", "values": {"type": "record", "name": "count", "fields": [
        _field("n", ["null", "long"]), _field("unit", "string", default="one")]}}, default={}))


@q("dec_schema_versions", f"""
SELECT event_id AS msg_offset, CAST(event_id % 5 + 1 AS BIGINT) AS schema_id,
       CASE WHEN event_id % 5 < 3 THEN event_id END AS event_id,
       CASE WHEN event_id % 5 < 3 THEN user_id END AS user_id,
       CASE WHEN event_id % 5 < 3 THEN event_type END AS event_type,
       CASE WHEN event_id % 5 = 0 THEN CAST(trunc(value) AS DOUBLE) WHEN event_id % 5 < 3 THEN value END AS value,
       CASE event_id % 5 WHEN 0 THEN 'none' WHEN 1 THEN 'app' WHEN 2 THEN 'web' END AS channel,
       CASE WHEN event_id % 5 = 2 THEN CAST({STATION_SQL} AS BIGINT) END AS k,
       CASE WHEN event_id % 5 = 2 THEN 'one' END AS unit,
       CASE event_id % 5 WHEN 3 THEN 'event_type: long can''t be read as string' WHEN 4 THEN 'unknown schema 5' END AS reason
FROM events""")
def dec_schema_versions(spark, sf):
    """One topic, written under several schema versions, read as one; messages
    of versions that don't fit, or are unknown, set aside with the reason."""
    read = RS.read_versions(_topic(spark, sf, FD.VERSIONS), "value", CLICK_VERSIONS, CLICK_READER,
                            keep=[F.col("offset").alias("msg_offset")])
    return read.select("msg_offset", "schema_id", "event_id", "user_id", "event_type", "value", "channel",
                       F.col("counts")["k"]["n"].alias("k"), F.col("counts")["k"]["unit"].alias("unit"), "reason")


@q("dec_demux", """
SELECT 'customer' AS kind, CAST(c_custkey AS VARCHAR) AS accountNumber FROM customer
UNION ALL SELECT 'location', CAST(o_custkey AS VARCHAR) FROM orders""")
def dec_demux(spark, sf):
    """One topic with two record kinds, split by a marker field."""
    members = D.demux_tag(D.decode_change_members(_topic(spark, sf, FD.MIXED)), "member",
                          "customerName", "customer", "location")
    # both record kinds carry accountNumber, so one parse serves both sides
    return D.parse_json(members, "member", LOCATION_RECORD, keep=["kind"]).select("kind", "accountNumber")


# ---------------------------------------------------------------- projections, filters, scalars

@q("sel_star", "SELECT * FROM events")
def sel_star(spark, sf):
    """SELECT * from a named view over a decoded topic."""
    return R.select_star(spark, clicks(spark, sf), "ClickEvents")


@q("sel_rename", """
SELECT o_orderkey, o_custkey AS customerNumber, o_totalprice AS amount, o_orderdate AS dateAndTime
FROM orders""")
def sel_rename(spark, sf):
    return R.rename(_t(spark, sf, "orders"), {"o_orderkey": "o_orderkey", "o_custkey": "customerNumber",
                                               "o_totalprice": "amount", "o_orderdate": "dateAndTime"})


@q("sel_sanitize", "SELECT event_id, ts, event_type, value, props FROM events")
def sel_sanitize(spark, sf):
    """Drop the personal field before passing records on."""
    return R.sanitize(clicks(spark, sf), ["user_id"])


@q("flt_ge", "SELECT * FROM events WHERE value >= 100")
def flt_ge(spark, sf):
    return R.at_least(clicks(spark, sf), "value", 100)


@q("flt_like_and", "SELECT page_id, url FROM pages WHERE page_id > 100 AND url LIKE 'https://m.%'")
def flt_like_and(spark, sf):
    return R.above_and_like(_t(spark, sf, "pages").select("page_id", "url"), "page_id", 100,
                            "url", "https://m.%")


@q("flt_notnull", f"SELECT email, birthDay FROM ({CUSTOMER_RECORD_SQL})")
def flt_notnull(spark, sf):
    """Parse a mixed topic with the customer schema and keep the rows where
    the needed fields parsed."""
    parsed = D.decode_two_level(_topic(spark, sf, FD.MIXED), CUSTOMER_RECORD)
    return R.not_null(parsed, ["email", "birthDay"]).select("email", "birthDay")


@q("flt_contains", "SELECT page_id, contains(url, '.example.com') AS matched FROM pages")
def flt_contains(spark, sf):
    """Substring filter and its negation, from one scan; a null url is neither."""
    p = _t(spark, sf, "pages").select("page_id", "url")
    return R.tag_containing(p, "url", ".example.com", "matched").select("page_id", "matched")


@q("fn_upper_substr", "SELECT page_id, upper(substring(url, 12)) AS uri_tail FROM pages")
def fn_upper_substr(spark, sf):
    return _t(spark, sf, "pages").select("page_id", S.upper_substr("url", 12).alias("uri_tail"))


@q("fn_split_item", """
SELECT o_orderkey, split_part(strftime(o_orderdate, '%Y-%m-%d'), '-', 1) AS order_year FROM orders""")
def fn_split_item(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey",
                    S.split_item(F.date_format("o_orderdate", "yyyy-MM-dd"), "-", 0).alias("order_year"))


@q("fn_slug", """
SELECT p_partkey, replace(replace(replace(replace(lower(p_name), '/', '_and_'), ' ', '_'), '-', '_'), '''', '')
       AS slug FROM part""")
def fn_slug(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", S.slug("p_name").alias("slug"))


@q("fn_status_text", f"""
SELECT o_orderkey,
       coalesce({INITCAP_SQL.format(x="replace(replace(lower(o_orderpriority), '-', '_'), '_', ' ')")}, '---')
         AS priority_text,
       coalesce(CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR), '---') AS price_text
FROM orders""")
def fn_status_text(spark, sf):
    """Status text for display: ``_`` → space, title case; numbers truncated."""
    o = _t(spark, sf, "orders")
    code = F.replace(F.lower("o_orderpriority"), F.lit("-"), F.lit("_"))
    return o.select("o_orderkey", S.status_text(code).alias("priority_text"),
                    S.whole_number_text("o_totalprice").alias("price_text"))


@q("fn_train_id", f"SELECT event_id, {TRAIN_SQL} AS train_id FROM events")
def fn_train_id(spark, sf):
    return _t(spark, sf, "events").select("event_id", S.train_id("event_type", "user_id").alias("train_id"))


@q("fn_line_case", """
SELECT s_suppkey, line, CASE line WHEN 'blue' THEN '#1E90FF' WHEN 'red' THEN '#DC143C'
                                  WHEN 'green' THEN '#32CD32' ELSE '0xFFFFFF' END AS colour
FROM (SELECT s_suppkey, CASE WHEN s_nationkey % 3 = 0 THEN 'red' WHEN s_nationkey % 2 = 0 THEN 'blue'
                             WHEN s_nationkey % 5 = 0 THEN 'green' END AS line FROM supplier)""")
def fn_line_case(spark, sf):
    """Three line flags → one line label → its colour code."""
    s = _t(spark, sf, "supplier").select(
        "s_suppkey", (F.col("s_nationkey") % 3 == 0).alias("red"),
        (F.col("s_nationkey") % 2 == 0).alias("blue"), (F.col("s_nationkey") % 5 == 0).alias("green"))
    lined = s.select("s_suppkey", S.line_of("red", "blue", "green").alias("line"))
    return lined.select("s_suppkey", "line", S.line_colour("line").alias("colour"))


@q("fn_json_get", f"SELECT event_id, {STATION_SQL} AS station_id FROM events")
def fn_json_get(spark, sf):
    return clicks(spark, sf).select("event_id", S.json_get("props", "$.k", "int").alias("station_id"))


@q("fn_letter_count", """
SELECT CAST(sum(strlen(text) - strlen(replace(text, 'a', ''))) AS BIGINT) AS n_a,
       CAST(sum(strlen(text) - strlen(replace(text, 'b', ''))) AS BIGINT) AS n_b FROM documents""")
def fn_letter_count(spark, sf):
    """Letters ``a`` and ``b`` over all lines of a text source (an aggregate,
    not driver-side counters)."""
    lines = FS.read_text(spark, _doc_lines(spark, sf))
    return lines.agg(F.sum(S.letter_count("value", "a")).cast("long").alias("n_a"),
                     F.sum(S.letter_count("value", "b")).cast("long").alias("n_b"))


@q("udf_processor", "SELECT event_id, (event_id * 7919 + user_id) % 101 AS score FROM events")
def udf_processor(spark, sf):
    """A user function applied to every record before the main step
    (``df.transform`` with built-in expressions)."""
    return clicks(spark, sf).transform(S.with_score).select("event_id", "score")


# ---------------------------------------------------------------- joins

DEPOSIT = StructType([StructField("accountNumber", StringType()), StructField("amount", FloatType()),
                      StructField("dateAndTime", StringType())])
WITHDRAWAL = StructType([StructField("transactionId", StringType()), StructField("l_linenumber", IntegerType()),
                         StructField("amount", DoubleType())])
ATM_VISIT = StructType([StructField("atmTransactionId", StringType()), StructField("accountNumber", StringType()),
                        StructField("transactionDate", TimestampNTZType())])
VEHICLE = StructType([StructField("l_orderkey", LongType()), StructField("l_linenumber", IntegerType()),
                      StructField("statusTruckNumber", StringType()), StructField("milesFromShop", IntegerType())])
CHECKIN = StructType([StructField("checkinTruckNumber", StringType()), StructField("locationName", StringType())])


@q("join_ss_deposits", f"""
SELECT CAST(o_custkey AS VARCHAR) AS accountNumber, CAST(o_totalprice AS FLOAT) AS amount,
       o_orderdate AS depositTime, c_name AS customerName, {EMAIL_SQL.format(k='c_custkey')} AS email
FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_ss_deposits(spark, sf):
    """Deposits × customers by account number, both streams; deposit times
    arrive as text like ``Sep 29, 2020, 10:06:23 AM`` and are parsed back."""
    dep = D.parse_json(_topic(spark, sf, FD.DEPOSITS, stream=True), "value", DEPOSIT)
    cust = D.decode_two_level(_topic(spark, sf, FD.CUSTOMERS, stream=True), CUSTOMER_RECORD).select(
        "customerName", "email", F.col("accountNumber").alias("customerNumber"))
    return _join_and_read(spark, dep, cust, F.col("accountNumber") == F.col("customerNumber"), "deposits", lambda j: j.select(
        "accountNumber", "amount", S.parse_bank_time("dateAndTime").cast("timestamp_ntz").alias("depositTime"),
        "customerName", "email"))


@q("join_ss_withdrawals", """
SELECT CAST(l_orderkey AS VARCHAR) AS transactionId, l_linenumber, l_extendedprice AS amount,
       CAST(o_custkey AS VARCHAR) AS accountNumber, o_orderdate AS transactionDate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def join_ss_withdrawals(spark, sf):
    """Withdrawals × ATM visits by transaction id, both streams, written as
    keyed JSON to a topic that is read back."""
    w = D.parse_json(_topic(spark, sf, FD.WITHDRAWALS, stream=True), "value", WITHDRAWAL, keep=["offset"])
    atm = D.parse_json(_topic(spark, sf, FD.ATM, stream=True), "value", ATM_VISIT)
    fields = ["transactionId", "l_linenumber", "amount", "accountNumber", "transactionDate"]
    path = _join_to_topic(spark, w, atm, F.col("transactionId") == F.col("atmTransactionId"), "withdrawals",
                          lambda j: SK.keyed_json(j, "accountNumber", "withdrawals-location", offset="offset", cols=fields))
    out = StructType([f for f in [*WITHDRAWAL.fields, *ATM_VISIT.fields] if f.name in fields])
    return D.parse_json(read_topic(spark, path, topics="withdrawals-location"), "value", out).select(*fields)


@q("join_ss_checkin", """
SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS VARCHAR) AS statusTruckNumber,
       CAST(l_quantity AS INTEGER) AS milesFromShop, CAST(s_suppkey AS VARCHAR) AS checkinTruckNumber,
       s_name AS locationName
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")
def join_ss_checkin(spark, sf):
    """Vehicle status × check-ins by truck number, both streams."""
    st = D.parse_json(_topic(spark, sf, FD.VEHICLES, stream=True), "value", VEHICLE)
    ck = D.parse_json(_topic(spark, sf, FD.CHECKINS, stream=True), "value", CHECKIN)
    return _join_and_read(spark, st, ck, F.col("statusTruckNumber") == F.col("checkinTruckNumber"), "checkin")


@q("join_ss_risk", RISK_SQL)
def join_ss_risk(spark, sf):
    """Flagship: decoded customers × risk events by e-mail (batch form)."""
    return risk_join(_topic(spark, sf, FD.CUSTOMERS), _topic(spark, sf, FD.RISK))


@q("join_ss_risk_stream", RISK_SQL)
def join_ss_risk_stream(spark, sf):
    """The flagship with both sides as streams."""
    sides = risk_sides(_topic(spark, sf, FD.CUSTOMERS, stream=True), _topic(spark, sf, FD.RISK, stream=True))
    return _join_and_read(spark, *sides, "risk")


LOCATIONS = ["accountNumber", "location", "homeLocation", "customerName"]


def _location_sides(spark, sf, stream=False) -> tuple[DataFrame, DataFrame, Column]:
    members = D.decode_change_members(_topic(spark, sf, FD.MIXED, stream=stream))
    cust, loc, _rejects = D.demux(members, "member", "customerName")
    home = D.parse_json(cust, "member", CUSTOMER_RECORD).select(
        "customerName", F.col("accountNumber").alias("homeAccountNumber"),
        F.col("location").alias("homeLocation"))
    cur = D.parse_json(loc, "member", LOCATION_RECORD)
    return cur, home, F.col("accountNumber") == F.col("homeAccountNumber")


LOCATION_SQL = """
SELECT CAST(o_custkey AS VARCHAR) AS accountNumber, cur.n_name AS location, home.n_name AS homeLocation,
       c_name AS customerName
FROM orders LEFT JOIN nation cur ON o_orderkey % 25 = cur.n_nationkey
JOIN customer ON o_custkey = c_custkey LEFT JOIN nation home ON c_nationkey = home.n_nationkey"""


@q("join_ss_location", LOCATION_SQL)
def join_ss_location(spark, sf):
    """Current × home location per account, as streams, after demultiplexing one topic."""
    return _join_and_read(spark, *_location_sides(spark, sf, stream=True), "location", lambda j: j.select(*LOCATIONS))


@q("join_travel", f"SELECT * FROM ({LOCATION_SQL}) WHERE location <> homeLocation")
def join_travel(spark, sf):
    """Customers seen outside their home country."""
    return J.join(*_location_sides(spark, sf), "inner").select(*LOCATIONS).filter(F.col("location") != F.col("homeLocation"))


@q("join_st_left", """
SELECT event_id, user_id, s_name, s_acctbal FROM events LEFT JOIN supplier ON user_id = s_suppkey""")
def join_st_left(spark, sf):
    """Stream × table, left outer (the stream on the left; some users have no supplier)."""
    ev = clicks(spark, sf, stream=True).select("event_id", "user_id")
    j = J.join(ev, _t(spark, sf, "supplier"), F.col("user_id") == F.col("s_suppkey"), "left")
    return _run_and_read(spark, j.select("event_id", "user_id", "s_name", "s_acctbal"), "st_left")


@q("join_st_inner", """
SELECT event_id, user_id, s_name, s_acctbal FROM events JOIN supplier ON user_id = s_suppkey""")
def join_st_inner(spark, sf):
    """Stream × table, inner."""
    ev = clicks(spark, sf, stream=True).select("event_id", "user_id")
    j = J.join(ev, _t(spark, sf, "supplier"), F.col("user_id") == F.col("s_suppkey"), "inner")
    return _run_and_read(spark, j.select("event_id", "user_id", "s_name", "s_acctbal"), "st_inner")


ASOF_SQL = """
WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type IN ('view', 'click')),
c AS (SELECT user_id, ts AS changed_at, value AS last_value, event_type = 'error' AS gone FROM events
      WHERE event_type IN ('purchase', 'error')
      QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)
SELECT event_id, e.user_id, ts, CASE WHEN NOT gone THEN changed_at END AS changed_at,
       CASE WHEN NOT gone THEN last_value END AS last_value
FROM e ASOF {how} JOIN c ON e.user_id = c.user_id AND e.ts >= c.changed_at"""


def _purchases(ev: DataFrame) -> DataFrame:
    """The changing table: a user's last purchase; an error deletes it."""
    return ev.filter(F.col("event_type").isin("purchase", "error")).select(
        "user_id", F.col("ts").alias("changed_at"), F.col("value").alias("last_value"), "event_id",
        (F.col("event_type") == "error").alias("gone"))


def _looks(ev: DataFrame) -> DataFrame:
    return ev.filter(F.col("event_type").isin("view", "click")).select("event_id", "user_id", "ts")


def _asof(spark, sf, how) -> DataFrame:
    ev = clicks(spark, sf)
    return AO.as_of(_looks(ev), _purchases(ev), "user_id", "ts", "changed_at", ["changed_at", "last_value"], how,
                    tie_break=["event_id"], deleted=F.col("gone"))


@q("join_asof_left", ASOF_SQL.format(how="LEFT"))
def join_asof_left(spark, sf):
    """Events × a table as it stood at each event's time, left outer."""
    return _asof(spark, sf, "left")


@q("join_asof_inner", f"SELECT * FROM ({ASOF_SQL.format(how='')}) WHERE changed_at IS NOT NULL")
def join_asof_inner(spark, sf):
    """Events × a table as it stood at each event's time, inner."""
    return _asof(spark, sf, "inner")


@q("join_asof_stream", ASOF_SQL.format(how="LEFT"))
def join_asof_stream(spark, sf):
    """A stream of events × a table that changes while it runs."""
    name = _uid("asof")
    path = scratch_path(spark, name)
    looks = _looks(clicks(spark, sf, stream=True))
    AO.stream_as_of(looks, lambda: _purchases(clicks(spark, sf)), name, path, "user_id", "ts", "changed_at",
                    ["changed_at", "last_value"], "left", tie_break=["event_id"], deleted=F.col("gone"),
                    state_partitions=_parallelism(spark))
    RN.drop_checkpoint(spark, name)
    return spark.read.schema("event_id long, user_id long, ts timestamp_ntz, changed_at timestamp_ntz, last_value double,"
                             " batch_id long").parquet(path).drop("batch_id")


@q("join_full", """
WITH latest AS (SELECT user_id, event_id, event_type FROM events
                QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, event_id, event_type, doc_id, quality FROM latest FULL OUTER JOIN labels ON user_id = doc_id""")
def join_full(spark, sf):
    """Table × table full outer: latest click per user × labels, which know
    some of the users' ids and others besides."""
    lt = T.latest(clicks(spark, sf), "user_id", ["ts", "event_id"], ["event_id", "event_type"])
    j = J.join(lt, _t(spark, sf, "labels"), F.col("user_id") == F.col("doc_id"), "full")
    return j.select("user_id", "event_id", "event_type", "doc_id", "quality")


@q("join_full_stream", """
WITH v AS (SELECT event_id AS view_id, user_id AS viewer, ts AS viewed_at FROM events WHERE event_type = 'view'),
p AS (SELECT event_id AS purchase_id, user_id AS buyer, ts AS bought_at FROM events WHERE event_type = 'purchase'),
w AS (SELECT least((SELECT max(viewed_at) FROM v), (SELECT max(bought_at) FROM p)) - INTERVAL '10 seconds' AS mark)
SELECT view_id, viewer, viewed_at, purchase_id, buyer, bought_at
FROM v FULL OUTER JOIN p ON viewer = buyer AND bought_at >= viewed_at AND bought_at <= viewed_at + INTERVAL '2 hours', w
WHERE (view_id IS NOT NULL AND purchase_id IS NOT NULL) OR viewed_at + INTERVAL '2 hours' < mark
   OR (view_id IS NULL AND bought_at < mark)""")
def join_full_stream(spark, sf):
    """Full outer join of two streams: a user's purchases within two hours of a
    view. Rows without a partner come out, and leave the state, once the
    watermarks say that none can come."""
    s = clicks(spark, sf, stream=True)
    at = lambda c: F.col("ts").cast("timestamp").alias(c)
    views = s.filter("event_type = 'view'").select(F.col("event_id").alias("view_id"), F.col("user_id").alias("viewer"), at("viewed_at"))
    buys = s.filter("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"), F.col("user_id").alias("buyer"), at("bought_at"))
    bound = F.expr("bought_at >= viewed_at AND bought_at <= viewed_at + INTERVAL 2 HOURS")
    j = J.join(views, buys, F.col("viewer") == F.col("buyer"), "full", ("viewed_at", "10 seconds"), ("bought_at", "10 seconds"), bound)
    return _run_and_read(spark, j.select("view_id", "viewer", F.col("viewed_at").cast("timestamp_ntz").alias("viewed_at"), "purchase_id",
                                         "buyer", F.col("bought_at").cast("timestamp_ntz").alias("bought_at")),
                         "full", settings=JOIN_STATE)


@q("join_rejects", f"""
SELECT event_id, {STATION_SQL} AS station_id FROM events
WHERE {STATION_SQL} NOT IN (SELECT n_nationkey FROM nation)""")
def join_rejects(spark, sf):
    """Arrivals whose station is unknown are set aside (anti join)."""
    ev = clicks(spark, sf).select("event_id", S.json_get("props", "$.k", "int").alias("station_id"))
    st = T.transform_stations(FD.stations(spark, sf)).select(F.col("station_id").alias("known_id"))
    _known, rejects = J.split_known(ev, st, "station_id", "known_id")
    return rejects


# ---------------------------------------------------------------- aggregations

@q("agg_sum_key", "SELECT event_type, round(sum(value), 2) AS total FROM events GROUP BY event_type")
def agg_sum_key(spark, sf):
    """Sum per key after re-keying (a shuffle on the key)."""
    return A.sum_by_key(clicks(spark, sf), "event_type", "value", "total", 2)


@q("agg_basic", """
SELECT event_type, max(value) AS max_value, min(value) AS min_value, round(sum(value), 2) AS sum_value,
       count(value) AS n FROM events GROUP BY event_type""")
def agg_basic(spark, sf):
    return A.basic_stats(clicks(spark, sf), "event_type", "value", 2)


@q("agg_count_station", f"SELECT {STATION_SQL} AS station_id, count(*) AS count FROM events GROUP BY 1")
def agg_count_station(spark, sf):
    """Turnstile entries counted per station."""
    ev = clicks(spark, sf).select(S.json_get("props", "$.k", "int").alias("station_id"))
    return A.count_by(ev, "station_id", "count")


@q("agg_histogram", """
WITH h AS (SELECT user_id, event_type, count(*) AS occurrences, sum(value) AS s
           FROM events GROUP BY user_id, event_type)
SELECT user_id, event_type, occurrences, round(sum(s) OVER (PARTITION BY user_id), 2) AS total FROM h""")
def agg_histogram(spark, sf):
    """Per user: how often each event type occurs (the histogram, one row per
    entry) next to the user's total value."""
    return A.histogram_with_total(clicks(spark, sf), "user_id", "event_type", "value")


@q("agg_histogram_stream", """
WITH h AS (SELECT time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') AS window_start, user_id, event_type,
                  count(*) AS occurrences, sum(value) AS s FROM events GROUP BY 1, 2, 3)
SELECT window_start, user_id, event_type, occurrences, round(sum(s) OVER (PARTITION BY window_start, user_id), 2) AS total
FROM h WHERE window_start + INTERVAL '1 day' <= (SELECT max(ts) FROM events) - INTERVAL '10 seconds'""")
def agg_histogram_stream(spark, sf):
    """The histogram and total of each user's day, as a stream; closed days."""
    return _run_and_read(spark, A.histogram_stream(_timed_clicks(spark, sf), "ts", "user_id", "event_type", "value", "1 day"),
                         "histogram")


@q("agg_topk", """
SELECT event_type, CAST(pos AS INTEGER) AS pos, value FROM (
  SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS pos
  FROM events WHERE value IS NOT NULL) WHERE pos <= 5""")
def agg_topk(spark, sf):
    """The 5 largest values per key, duplicates kept."""
    return A.top_k(clicks(spark, sf), "event_type", "value", 5, tie_break=["event_id"])


# ---------------------------------------------------------------- windows

def _bucket(sec: int) -> str:
    return f"time_bucket(INTERVAL '{sec} seconds', ts, TIMESTAMP '1970-01-01')"


@q("win_tumbling", f"""
SELECT {_bucket(10)} AS window_start, {_bucket(10)} + INTERVAL '10 seconds' AS window_end, event_type,
       round(sum(value), 2) AS total FROM events GROUP BY 1, 2, 3""")
def win_tumbling(spark, sf):
    """Sum per key per 10-second tumbling window."""
    return W.tumbling_sum(clicks(spark, sf), "ts", "event_type", "value", "10 seconds")


@q("win_hopping", f"""
WITH e AS (SELECT {_bucket(10)} - k * INTERVAL '10 seconds' AS window_start, event_type, value
           FROM events, range(6) t(k))
SELECT window_start, window_end, event_type, total FROM (
  SELECT window_start, window_start + INTERVAL '60 seconds' AS window_end, event_type,
         round(sum(value), 2) AS total FROM e GROUP BY 1, 2, 3)""")
def win_hopping(spark, sf):
    """Sum per key, 60-second windows every 10 seconds. Few keys, so at scale
    each (key, 10 s pane) holds many events: sum the panes first, then build
    the six windows of each pane from pane sums (no 6x expansion of events)."""
    return W.hopping_sum(clicks(spark, sf), "ts", "event_type", "value", "60 seconds", "10 seconds",
                         panes=True)


@q("win_assign", f"""
SELECT event_id, ts, {_bucket(30)} AS window_start, {_bucket(30)} + INTERVAL '30 seconds' AS window_end
FROM events""")
def win_assign(spark, sf):
    """Every event tagged with its 30-second window; no aggregate."""
    return W.assign_window(clicks(spark, sf).select("event_id", "ts"), "ts", "30 seconds")


@q("win_hopping_keys", f"""
WITH e AS (SELECT {_bucket(5)} - k * INTERVAL '5 seconds' AS window_start, event_type
           FROM events, range(6) t(k) WHERE event_type LIKE 'p%')
SELECT window_start, window_start + INTERVAL '30 seconds' AS window_end, event_type, count(*) AS n
FROM e GROUP BY 1, 2, 3""")
def win_hopping_keys(spark, sf):
    """Keys (with counts) per 30-second window every 5 seconds, prefix-filtered."""
    ev = clicks(spark, sf).filter(F.col("event_type").like("p%"))
    return W.hopping_count(ev, "ts", "event_type", "30 seconds", "5 seconds", panes=True)


@q("win_session", """
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
                                      <= INTERVAL '5 minutes' THEN 0 ELSE 1 END AS brk FROM events),
s AS (SELECT user_id, ts, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '5 minutes' AS session_end, count(*) AS n
FROM s GROUP BY user_id, sid""")
def win_session(spark, sf):
    """Sessions per user closing after 5 minutes without events."""
    return W.sessions_bucketed(clicks(spark, sf), "ts", "user_id", 300)


@q("win_topk", f"""
SELECT window_start, window_end, event_type, CAST(pos AS INTEGER) AS pos, value FROM (
  SELECT {_bucket(30)} AS window_start, {_bucket(30)} + INTERVAL '30 seconds' AS window_end, event_type, value,
         row_number() OVER (PARTITION BY {_bucket(30)}, event_type ORDER BY value DESC, event_id) AS pos
  FROM events WHERE value IS NOT NULL) WHERE pos <= 5""")
def win_topk(spark, sf):
    """Top 5 values per key in each 30-second tumbling window."""
    return W.windowed_top_k(clicks(spark, sf), "ts", "event_type", "value", 5, "30 seconds", ["event_id"])


@q("win_current", f"""
SELECT event_id, event_type, {_bucket(600)} AS window_start,
       round(sum(value) OVER (PARTITION BY event_type, {_bucket(600)} ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS current
FROM events""")
def win_current(spark, sf):
    """After each event, the running value of its own 10-minute window."""
    r = W.running_in_window(clicks(spark, sf), "ts", "event_type", "value", "10 minutes", ["event_id"],
                            split="1 minute")
    return r.select("event_id", "event_type", "window_start", "current")


@q("win_current_stream", f"""
SELECT event_id, event_type, {_bucket(86400)} AS window_start,
       round(sum(value) OVER (PARTITION BY event_type, {_bucket(86400)} ORDER BY ts, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS current
FROM events WHERE {_bucket(3600)} + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '10 seconds'""")
def win_current_stream(spark, sf):
    """After each event, the running value of its own day, from a stream whose
    events aren't in order; those of the hours that the watermark closed."""
    s = clicks(spark, sf, stream=True).select("event_id", "ts", "event_type", "value")
    r = RG.running_in_window_ordered(s, "ts", "event_type", "value", "event_id", 86400, 3600)
    return _run_and_read(spark, r, "running", settings=RG.SETTINGS).select("event_id", "event_type", "window_start", "current")


@q("win_late", """
WITH w AS (SELECT time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS window_start, event_type,
                  count(*) AS n FROM events GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, event_type, n FROM w
WHERE window_start + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '10 seconds'""")
def win_late(spark, sf):
    """Streaming hourly counts with a 10-second watermark, append mode: a
    window is emitted once the watermark passes its end, later rows are
    dropped by the engine. The topic is replayed in slices of event time, each
    one micro-batch of the same checkpointed query."""
    env, staging = _topic(spark, sf, FD.CLICKS), scratch_path(spark, _uid("slices"))
    stage_slices(env, staging, time_slices(env, 4))
    topic, name = scratch_path(spark, _uid("replay")), _uid("late")
    out = scratch_path(spark, name)
    for i in range(4):
        publish_slice(spark, staging, i, topic)
        s = D.parse_json(read_topic(spark, topic, topics=FD.CLICKS, stream=True), "value", CLICK_EVENT)
        s = W.event_time(s, "ts", "10 seconds")
        agg = W.windowed_agg(s, "ts", "event_type", [F.count(F.lit(1)).alias("n")], "1 hour")
        RN.run_available(agg, name, path=out, state_partitions=_parallelism(spark))
    RN.drop_checkpoint(spark, name)
    return spark.read.schema(agg.schema).parquet(out)


#: Ends of the slices in which late rows are looked for; every 50th event comes a slice late.
SLICE_ENDS = ["2024-01-08 00:00:00", "2024-01-16 00:00:00", "2024-01-24 00:00:00"]
SLICE_SQL = " + ".join(f"CAST(ts >= TIMESTAMP '{t}' AS INTEGER)" for t in SLICE_ENDS)


@q("win_late_rows", f"""
WITH s AS (SELECT *, least(3, {SLICE_SQL} + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END) AS slice FROM events),
w AS (SELECT a.slice, max(b.ts) AS mark FROM (SELECT DISTINCT slice FROM s) a JOIN s b ON b.slice < a.slice GROUP BY 1)
SELECT event_id, ts, event_type, coalesce(ts < mark - INTERVAL '10 seconds', false) AS is_late
FROM s LEFT JOIN w USING (slice)""")
def win_late_rows(spark, sf):
    """Rows that come after the watermark as an output of their own, each
    compared with the watermark of its own micro-batch; all rows are returned."""
    at, delayed = F.col("timestamp"), F.when(F.col("offset") % 50 == 0, 1).otherwise(0)
    slice_no = delayed
    for end in SLICE_ENDS:
        slice_no = slice_no + F.when(at >= F.lit(end).cast("timestamp"), 1).otherwise(0)
    staging, topic, name = scratch_path(spark, _uid("slices")), scratch_path(spark, _uid("delayed")), _uid("routed")
    stage_slices(_topic(spark, sf, FD.CLICKS), staging, F.least(F.lit(3), slice_no))
    out = scratch_path(spark, name)
    for i in range(4):
        publish_slice(spark, staging, i, topic)
        s = D.parse_json(read_topic(spark, topic, topics=FD.CLICKS, stream=True), "value", CLICK_EVENT)
        s = s.select("event_id", "ts", "event_type")
        LT.route_late(s, "ts", 10, name, out, state_partitions=_parallelism(spark))
    RN.drop_checkpoint(spark, name)
    return LT.read_routed(spark, out, s.schema).drop("batch_id")


CLOSED = "(SELECT max(ts) FROM events) - INTERVAL '10 seconds'"


def _timed_clicks(spark, sf) -> DataFrame:
    return W.event_time(clicks(spark, sf, stream=True), "ts", "10 seconds")


@q("win_tumbling_stream", f"""
SELECT {_bucket(10)} AS window_start, {_bucket(10)} + INTERVAL '10 seconds' AS window_end, event_type,
       round(sum(value), 2) AS total FROM events GROUP BY 1, 2, 3
HAVING {_bucket(10)} + INTERVAL '10 seconds' <= {CLOSED}""")
def win_tumbling_stream(spark, sf):
    """Streaming sum per key and 10-second window; windows the watermark closed."""
    return _run_and_read(spark, W.tumbling_sum(_timed_clicks(spark, sf), "ts", "event_type", "value", "10 seconds"),
                         "tumbling")


@q("win_hopping_stream", f"""
WITH e AS (SELECT {_bucket(10)} - k * INTERVAL '10 seconds' AS window_start, event_type, value
           FROM events, range(6) t(k))
SELECT window_start, window_start + INTERVAL '60 seconds' AS window_end, event_type, round(sum(value), 2) AS total
FROM e WHERE window_start + INTERVAL '60 seconds' <= {CLOSED} GROUP BY 1, 2, 3""")
def win_hopping_stream(spark, sf):
    """Streaming sum per key in 60-second windows every 10 seconds; closed windows."""
    return _run_and_read(spark, W.hopping_sum_stream(_timed_clicks(spark, sf), "ts", "event_type", "value",
                                                     "60 seconds", "10 seconds"), "hopping")


@q("win_session_stream", f"""
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
                                      <= INTERVAL '5 minutes' THEN 0 ELSE 1 END AS brk FROM events),
s AS (SELECT user_id, ts, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '5 minutes' AS session_end, count(*) AS n
FROM s GROUP BY user_id, sid HAVING max(ts) + INTERVAL '5 minutes' <= {CLOSED}""")
def win_session_stream(spark, sf):
    """Streaming sessions per user (5-minute gap); sessions the watermark closed."""
    return _run_and_read(spark, W.session_agg(_timed_clicks(spark, sf), "ts", "user_id", "5 minutes",
                                              [F.count(F.lit(1)).alias("n")]), "session")


# ---------------------------------------------------------------- tables

LATEST_SQL = """SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


@q("tbl_latest", f"SELECT user_id, event_id, ts, event_type, value, props FROM ({LATEST_SQL})")
def tbl_latest(spark, sf):
    """Latest record per key of a changelog (a table, not all values)."""
    return T.latest(clicks(spark, sf), "user_id", ["ts", "event_id"])


@q("tbl_compact", f"""
SELECT user_id, event_id, event_type, props AS payload FROM ({LATEST_SQL}) WHERE event_type <> 'error'""")
def tbl_compact(spark, sf):
    """Compacted topic: last record per key; error events are tombstones
    (null value) and delete their key."""
    cl = clicks(spark, sf).withColumn(
        "payload", F.when(F.col("event_type") != "error", F.col("props")))
    return T.compact(cl, "user_id", ["ts", "event_id"], "payload", ["event_id", "event_type", "payload"])


COMPACT_SQL = f"SELECT user_id, event_id, event_type, props AS payload FROM ({LATEST_SQL}) WHERE event_type <> 'error'"


def _with_tombstones(env: DataFrame) -> DataFrame:
    """The click topic with errors as messages without a value, offsets in event order."""
    is_error = F.get_json_object(F.col("value").cast("string"), "$.event_type") == "error"
    return env.withColumn("value", F.when(~is_error, F.col("value")))


@q("tbl_compact_topic", COMPACT_SQL)
def tbl_compact_topic(spark, sf):
    """A stored topic compacted twice, with messages appended in between: the
    last message of every key, keys whose last one is a tombstone deleted."""
    env = _with_tombstones(_topic(spark, sf, FD.CLICKS))
    path = scratch_path(spark, _uid("compacted"))
    before = F.col("timestamp") < F.lit(FD.DRIFT_START).cast("timestamp")
    for part in (env.filter(before), env.filter(~before)):
        write_topic(part, path)
        CP.compact_topic(spark, path, FD.CLICKS, retention_seconds=0)
    log = CP.read_log(spark, path, FD.CLICKS)
    clicks_ = D.parse_json(log.filter("value is not null"), "value", CLICK_EVENT)
    return clicks_.select("user_id", "event_id", "event_type", F.col("props").alias("payload"))


@q("tbl_compact_stream", COMPACT_SQL)
def tbl_compact_stream(spark, sf):
    """The same as a table that a stream keeps: a tombstone deletes its key, and
    older values that come later don't bring it back (the newer half of the
    events is merged first; the stream starts again for the older half)."""
    cl = clicks(spark, sf)
    cl = cl.select("user_id", "event_id", "event_type", "ts", F.when(F.col("event_type") != "error", F.col("props")).alias("payload"))
    name = _uid("compact_stream")
    base = scratch_path(spark, name)
    before = F.col("ts") < F.lit(FD.DRIFT_START).cast("timestamp_ntz")
    for part in (cl.filter(~before), cl.filter(before)):
        part.write.mode("append").parquet(f"{base}/changes")
        s = spark.readStream.schema(cl.schema).parquet(f"{base}/changes")
        ST.upsert_latest(s, ["user_id"], ["ts", "event_id"], f"{base}/table", name, buckets=8, deleted="payload",
                         state_partitions=_parallelism(spark))
    RN.drop_checkpoint(spark, name)
    return ST.read_table(spark, f"{base}/table").select("user_id", "event_id", "event_type", "payload")


@q("tbl_filtered", f"""
SELECT user_id, event_id, ts, event_type, value, props FROM ({LATEST_SQL}) WHERE event_type LIKE 'p%'""")
def tbl_filtered(spark, sf):
    """A table derived by a predicate on each key's latest row."""
    return T.latest_where(clicks(spark, sf), "user_id", ["ts", "event_id"], F.col("event_type").like("p%"))


@q("tbl_station_transform", """
SELECT CAST(s_suppkey AS INTEGER) AS station_id, s_name AS station_name, CAST(s_suppkey AS INTEGER) AS "order",
       CASE WHEN r_regionkey IN (0, 3) THEN 'red' WHEN r_regionkey IN (1, 3) THEN 'blue'
            WHEN r_regionkey = 2 THEN 'green' END AS line
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def tbl_station_transform(spark, sf):
    """Station rows (two stops each) reduced to id, name, order and line,
    one row per station."""
    return T.transform_stations(FD.supplier_stations(spark, sf))


def _arrivals_from_topics(spark, sf) -> DataFrame:
    env = _topic(spark, sf, pattern=FD.ARRIVALS_PATTERN)
    return D.parse_json(env, "value", ARRIVAL,
                        keep=[F.col("offset").alias("event_id"),
                              F.col("timestamp").cast("timestamp_ntz").alias("ts")])


@q("tbl_train_position", POSITIONS_SQL)
def tbl_train_position(spark, sf):
    """Which train stands at each (line, station, direction), from arrivals
    that clear their previous platform and fill their own."""
    return T.train_positions(_arrivals_from_topics(spark, sf), "ts", "event_id")


# Weather shown before any reading arrived.
WEATHER_DEFAULTS = {"temperature": 70.0, "status": "sunny"}


@q("tbl_latest_global", """
SELECT coalesce(value, 70.0) AS temperature, coalesce(event_type, 'sunny') AS status FROM (
  SELECT value, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)""")
def tbl_latest_global(spark, sf):
    """The latest single reading (temperature, status) with defaults."""
    w = clicks(spark, sf).select("ts", "event_id", F.col("value").alias("temperature"),
                                 F.col("event_type").alias("status"))
    return T.latest_global(w, ["ts", "event_id"], WEATHER_DEFAULTS)


@q("tbl_route_by_topic", f"""
SELECT concat('transit.station.arrivals.', {LINE_SQL}) AS topic, event_id AS msg_offset,
       {LINE_SQL} AS route_line FROM events WHERE {LINE_SQL} IN ('blue', 'green', 'red')
UNION ALL
SELECT 'transit.stations.table', station_id, line FROM ({STATIONS_T_SQL})
WHERE line IN ('blue', 'green', 'red')
UNION ALL
SELECT 'TURNSTILE_SUMMARY', station_id, l.line FROM (SELECT DISTINCT {STATION_SQL} AS station_id FROM events),
  (VALUES ('blue'), ('green'), ('red')) l(line)""")
def tbl_route_by_topic(spark, sf):
    """Messages of all topics routed to lines: station and arrival messages
    by their line (unknown lines dropped), summaries to every line."""
    env = _topic(spark, sf, pattern=FD.ARRIVALS_PATTERN)
    for name in (FD.STATIONS_TOPIC, FD.SUMMARY_TOPIC):
        env = env.unionByName(_topic(spark, sf, name))
    bus = env.select("topic", F.col("offset").alias("msg_offset"),
                     F.get_json_object(F.col("value").cast("string"), "$.line").alias("line"))
    r = T.route_by_topic(bus, FD.STATION_MARKER, FD.SUMMARY_TOPIC)
    return r.select("topic", "msg_offset", "route_line")


@q("tbl_status_board", f"""
WITH st AS ({STATIONS_T_SQL}),
pos AS ({POSITIONS_SQL}),
p AS (SELECT line, station_id,
             max(CASE WHEN direction = 'a' THEN train_id END) AS train_a,
             max(CASE WHEN direction = 'a' THEN train_status END) AS sa,
             max(CASE WHEN direction = 'b' THEN train_id END) AS train_b,
             max(CASE WHEN direction = 'b' THEN train_status END) AS sb
      FROM pos GROUP BY line, station_id),
cnt AS (SELECT {STATION_SQL} AS station_id, count(*) AS c FROM events GROUP BY 1)
SELECT st.line, st.station_id, station_name, "order",
       coalesce(train_a, '---') AS train_a,
       CASE WHEN train_a IS NOT NULL THEN coalesce({INITCAP_SQL.format(x="replace(sa, '_', ' ')")}, '---')
            ELSE '---' END AS status_a,
       coalesce(train_b, '---') AS train_b,
       CASE WHEN train_b IS NOT NULL THEN coalesce({INITCAP_SQL.format(x="replace(sb, '_', ' ')")}, '---')
            ELSE '---' END AS status_b,
       CAST(coalesce(c, 0) AS BIGINT) AS entries
FROM st LEFT JOIN p ON st.line = p.line AND st.station_id = p.station_id
LEFT JOIN cnt ON st.station_id = cnt.station_id
WHERE st.line IN ('blue', 'green', 'red')""")
def tbl_status_board(spark, sf):
    """One row per station: line, station, trains on both platforms, entries;
    from the stations topic, the arrival topics and the turnstile summary."""
    st = D.parse_json(_topic(spark, sf, FD.STATIONS_TOPIC), "value",
                      StructType([StructField("station_id", IntegerType()),
                                  StructField("station_name", StringType()),
                                  StructField("order", IntegerType()),
                                  StructField("line", StringType())]))
    pos = T.train_positions(_arrivals_from_topics(spark, sf), "ts", "event_id")
    cnt = D.parse_json(_topic(spark, sf, FD.SUMMARY_TOPIC), "value",
                       StructType([StructField("STATION_ID", IntegerType()),
                                   StructField("COUNT", LongType())]))
    cnt = cnt.select(F.col("STATION_ID").alias("station_id"), F.col("COUNT").alias("count"))
    return T.status_board(st, pos, cnt)


# ---------------------------------------------------------------- catalog

@q("cat_declare", "SELECT * FROM events")
def cat_declare(spark, sf):
    """Declare a named stream over a topic (columns + JSON format)."""
    return C.declare(spark, "clickevents_declared", _topic(spark, sf, FD.CLICKS), CLICK_EVENT)


@q("cat_derive", "SELECT event_id, ts, event_type, value FROM events WHERE value >= 100")
def cat_derive(spark, sf):
    """A persistent query (CREATE STREAM … AS SELECT) over a declared stream,
    writing its own topic; the topic is read back."""
    view = _uid("clickevents_live")
    C.declare(spark, view, _topic(spark, sf, FD.CLICKS, stream=True), CLICK_EVENT)
    path = scratch_path(spark, _uid("popular"))
    name = _uid("popular_values")

    def sink(df, query_name):
        env = SK.keyed_json(df, "event_type", "popular-values", offset="event_id")
        return RN.start(env, query_name, path=path, partition_by=("topic",), trigger={"processingTime": "1 second"},
                        state_partitions=_parallelism(spark))

    query = C.derive(spark, name, f"SELECT event_id, ts, event_type, value FROM `{view}` WHERE value >= 100", sink)
    query.processAllAvailable()  # the query itself runs on until it is terminated
    C.terminate(spark, name)
    C.drop_view(spark, view)
    schema = StructType([StructField("event_id", LongType()), StructField("ts", TimestampNTZType()),
                         StructField("event_type", StringType()), StructField("value", DoubleType())])
    return D.parse_json(read_topic(spark, path, topics="popular-values"), "value", schema)


@q("cat_restore", """
SELECT event_id, event_type, value FROM events WHERE value >= 100""")
def cat_restore(spark, sf):
    """A persistent query that outlives its session: created over the first
    part of a topic, stopped with everything else, then restored from the log
    in a new session, where it goes on with what was added since."""
    base = scratch_path(spark, _uid("persistent"))
    stream, name = _uid("clicks_logged"), _uid("large_values")
    env, before = _topic(spark, sf, FD.CLICKS), F.col("timestamp") < F.lit(FD.DRIFT_START).cast("timestamp")
    write_topic(env.filter(before), f"{base}/in")
    first = PQ.Catalog(spark, f"{base}/catalog", _parallelism(spark))
    first.create_stream(stream, f"{base}/in", FD.CLICKS, CLICK_EVENT)
    query = first.create_query(name, f"SELECT event_id, event_type, value FROM `{stream}` WHERE value >= 100", "event_type",
                               "large-values", f"{base}/out", "event_id")
    query.processAllAvailable()
    query.stop()
    spark.catalog.dropTempView(stream)
    write_topic(env.filter(~before), f"{base}/in")

    again = PQ.Catalog(configure(spark.newSession()), f"{base}/catalog", _parallelism(spark))
    again.restore()[name].processAllAvailable()
    again.terminate(name)
    again.drop_stream(stream)
    RN.drop_checkpoint(spark, name)
    schema = StructType([f for f in CLICK_EVENT.fields if f.name in ("event_id", "event_type", "value")])
    return D.parse_json(read_topic(spark, f"{base}/out", topics="large-values"), "value", schema)


@q("cat_drop", """
SELECT 'drop_while_running' AS step, 'refused' AS outcome
UNION ALL SELECT 'drop_after_terminate', 'dropped'
UNION ALL SELECT 'sink_rows_kept', CAST(count(*) AS VARCHAR) FROM events""")
def cat_drop(spark, sf):
    """Drop is refused while a running query reads the view; after the query
    is terminated the drop succeeds and the written data stays."""
    view = _uid("clicks_to_drop")
    C.declare(spark, view, _topic(spark, sf, FD.CLICKS, stream=True), CLICK_EVENT)
    name = _uid("drop_reader")
    path = scratch_path(spark, name)
    qy = RN.start(spark.sql(f"SELECT event_id FROM `{view}`"), name, path=path,
                  trigger={"processingTime": "1 second"})
    steps = []
    try:
        qy.processAllAvailable()
        try:
            C.drop_view(spark, view)
            steps.append(("drop_while_running", "dropped"))
        except C.CatalogError:
            steps.append(("drop_while_running", "refused"))
    finally:
        C.terminate(spark, name)
    C.drop_view(spark, view)
    steps.append(("drop_after_terminate", "dropped"))
    kept = spark.read.parquet(path).count()
    steps.append(("sink_rows_kept", str(kept)))
    return spark.createDataFrame(steps, "step string, outcome string")
