"""Topics derived from the driver tables, standing in for the reference's
Kafka topics (mapping: SURVEY §7.3).

All feeds are lazy DataFrames computed by Spark from the tables. :func:`bus`
writes them once per session into a file-backed topic folder (partitioned by
topic) under the checkpoint root, so sources can be read back as files or as
streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.decode import change_record_value, json_value
from eventloom.functions.resolution import framed
from eventloom.functions.scalars import json_get, train_id
from eventloom.operators.joins import broadcast_if_small
from eventloom.operators.tables import transform_stations
from eventloom.operators.windows import previous_in_key
from eventloom.schemas import CLICK_EVENT
from eventloom.session import derived_path
from eventloom.sources.topics import to_envelope, write_topic

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Topic names used by the pipelines.
CLICKS = "clickevents"
FUEL = "fuel-level"
CUSTOMERS = "customer-changes"
MIXED = "change-feed"
BALANCES = "customer-balances"
RISK = "risk-events"
DRIFT = "clickevents-drift"
ARRIVALS_PREFIX = "transit.station.arrivals."
STATIONS_TOPIC = "transit.stations.table"
SUMMARY_TOPIC = "TURNSTILE_SUMMARY"
STATION_MARKER = "transit.station"


def arrival_topic(line: Column) -> Column:
    """The one naming rule for arrival topics; producers and the subscription
    pattern below both come from it, so they cannot drift apart."""
    return F.concat(F.lit(ARRIVALS_PREFIX), line)


ARRIVALS_PATTERN = "^" + ARRIVALS_PREFIX.replace(".", r"\.")

# Event types of the events table stand in for train lines; "signup" maps to
# a line the status board does not know, so its arrivals are discarded.
EVENT_LINE = {"click": "red", "view": "blue", "purchase": "green",
              "error": "green", "signup": "orange"}
DRIFT_START = "2024-01-16 00:00:00"

DEPOSITS = "bank-deposits"
WITHDRAWALS = "bank-withdrawals"
ATM = "atm-visits"
VEHICLES = "vehicle-status"
CHECKINS = "vehicle-checkins"
VERSIONS = "clickevents-versions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def email_of(custkey: Column) -> Column:
    return F.concat(F.lit("customer"), custkey.cast("string"), F.lit("@example.org"))


def birth_day_of(custkey: Column) -> Column:
    days = F.pmod(custkey * 37, F.lit(21915)).cast("int")
    return F.date_format(F.date_add(F.lit("1940-01-01").cast("date"), days), "yyyy-MM-dd")


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer records (the inner JSON of the change feed), one per customer."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return c.join(broadcast_if_small(n), c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey"),
        F.col("c_name").alias("customerName"),
        email_of(F.col("c_custkey")).alias("email"),
        F.concat(F.lit("555010"), F.lpad(F.pmod(F.col("c_custkey"), F.lit(10000)).cast("string"), 4, "0")).alias("phone"),
        birth_day_of(F.col("c_custkey")).alias("birthDay"),
        F.col("c_custkey").cast("string").alias("accountNumber"),
        F.col("n_name").alias("location"))


def location_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current-location records: each order places its customer in a nation."""
    o = table(spark, sf_dir, "orders")
    n = table(spark, sf_dir, "nation")
    return o.join(broadcast_if_small(n), F.pmod(o.o_orderkey, F.lit(25)) == n.n_nationkey, "left").select(
        F.col("o_orderkey"), F.col("o_custkey").cast("string").alias("accountNumber"),
        F.col("n_name").alias("location"))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train arrivals: train = user, station = props.k, direction by event
    parity, previous station/direction = the train's previous arrival."""
    e = table(spark, sf_dir, "events")
    line = None
    for et, ln in EVENT_LINE.items():
        c = F.col("event_type") == et
        line = F.when(c, F.lit(ln)) if line is None else line.when(c, F.lit(ln))
    a = e.select(
        "event_id", "ts", "user_id",
        json_get("props", "$.k", "int").alias("station_id"),
        train_id("event_type", "user_id").alias("train_id"),
        F.when(F.col("event_id") % 2 == 0, F.lit("a")).otherwise(F.lit("b")).alias("direction"),
        line.alias("line"),
        F.when(F.col("value") >= 100, F.lit("delayed")).otherwise(F.lit("in_service")).alias("train_status"))
    return previous_in_key(a, "user_id", "ts", ["event_id"], ["station_id", "direction"])


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station rows (the 10-column station table) from nation × region: one
    stop per direction; line flags from the region (region 3 has two flags,
    region 4 none)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    nr = n.join(broadcast_if_small(r), n.n_regionkey == r.r_regionkey, "left")
    dirs = F.explode(F.array(F.lit("E"), F.lit("W"))).alias("direction_id")
    return nr.select("*", dirs).select(
        (F.col("n_nationkey") * 2 + F.when(F.col("direction_id") == "W", 1).otherwise(0))
        .cast("int").alias("stop_id"),
        "direction_id",
        F.concat(F.col("n_name"), F.lit(" ("), F.col("direction_id"), F.lit(")")).alias("stop_name"),
        F.col("n_name").alias("station_name"),
        F.concat(F.col("n_name"), F.lit(" - "), F.col("r_name")).alias("station_descriptive_name"),
        F.col("n_nationkey").cast("int").alias("station_id"),
        F.col("n_nationkey").cast("int").alias("order"),
        F.col("r_regionkey").isin(0, 3).alias("red"),
        F.col("r_regionkey").isin(1, 3).alias("blue"),
        (F.col("r_regionkey") == 2).alias("green"))


def supplier_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A station table that grows with the data: one station per supplier,
    two stops (directions), line flags from the supplier nation's region."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    snr = (s.join(broadcast_if_small(n), s.s_nationkey == n.n_nationkey, "left")
           .join(broadcast_if_small(r), F.col("n_regionkey") == r.r_regionkey, "left"))
    dirs = F.explode(F.array(F.lit("E"), F.lit("W"))).alias("direction_id")
    return snr.select("*", dirs).select(
        (F.col("s_suppkey") * 2 + F.when(F.col("direction_id") == "W", 1).otherwise(0))
        .cast("int").alias("stop_id"),
        "direction_id",
        F.concat(F.col("s_name"), F.lit(" ("), F.col("direction_id"), F.lit(")")).alias("stop_name"),
        F.col("s_name").alias("station_name"),
        F.concat(F.col("s_name"), F.lit(" - "), F.coalesce(F.col("r_name"), F.lit("?"))).alias("station_descriptive_name"),
        F.col("s_suppkey").cast("int").alias("station_id"),
        F.col("s_suppkey").cast("int").alias("order"),
        F.coalesce(F.col("r_regionkey").isin(0, 3), F.lit(False)).alias("red"),
        F.coalesce(F.col("r_regionkey").isin(1, 3), F.lit(False)).alias("blue"),
        F.coalesce(F.col("r_regionkey") == 2, F.lit(False)).alias("green"))


def turnstile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return (e.select(json_get("props", "$.k", "int").alias("station_id"))
            .groupBy("station_id").agg(F.count(F.lit(1)).alias("count")))


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived topic as a lazy envelope DataFrame (nothing is written)."""
    return FEEDS[name](spark, sf_dir)


def _clicks(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    cols = [f.name for f in CLICK_EVENT.fields]
    return to_envelope(e, CLICKS, json_value(cols), key="user_id", timestamp="ts", offset="event_id")


def _fuel(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return to_envelope(e, FUEL, F.col("event_type"), key="user_id", timestamp="ts", offset="event_id")


def _drift(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    cols = [f.name for f in CLICK_EVENT.fields]
    drift_val = F.when(F.col("ts") >= F.lit(DRIFT_START).cast("timestamp_ntz"),
                       json_value(["event_id", "ts", F.col("user_id").alias("user_ref"),
                                   "event_type", "value", "props"])) \
        .otherwise(json_value(cols))
    return to_envelope(e, DRIFT, drift_val, key="user_id", timestamp="ts", offset="event_id")


_CUSTOMER_FIELDS = ["customerName", "email", "phone", "birthDay", "accountNumber", "location"]


def _customers(spark, sf_dir):
    cr = customer_records(spark, sf_dir)
    return to_envelope(cr, CUSTOMERS, change_record_value(json_value(_CUSTOMER_FIELDS), F.lit(0.0), "Customer"),
                       key=F.lit("Customer"), offset="c_custkey")


def _mixed(spark, sf_dir):
    cr = customer_records(spark, sf_dir)
    mixed_c = to_envelope(cr, MIXED, change_record_value(json_value(_CUSTOMER_FIELDS), F.lit(0.0), "Customer"),
                          key=F.lit("Customer"), offset=F.col("c_custkey") * 2)
    lr = location_records(spark, sf_dir)
    mixed_l = to_envelope(lr, MIXED,
                          change_record_value(json_value(["accountNumber", "location"]), F.lit(0.0), "Location"),
                          key=F.lit("Location"), offset=F.col("o_orderkey") * 2 + 1)
    return mixed_c.unionByName(mixed_l)


def _balances(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return to_envelope(c, BALANCES, change_record_value(F.col("c_name"), F.col("c_acctbal"), "CustomerBalance"),
                       key=F.lit("CustomerBalance"), offset="c_custkey")


def _risk(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return to_envelope(
        o.select("o_orderkey", "o_orderdate", email_of(F.col("o_custkey")).alias("customer"),
                 F.col("o_totalprice").cast("float").alias("score"),
                 F.date_format("o_orderdate", "yyyy-MM-dd").alias("riskDate")),
        RISK, json_value(["customer", "score", "riskDate"]), key="customer",
        timestamp="o_orderdate", offset="o_orderkey")


def _arrivals(spark, sf_dir):
    return to_envelope(
        arrivals(spark, sf_dir), arrival_topic(F.col("line")),
        json_value(["station_id", "train_id", "direction", "line", "train_status",
                    "prev_station_id", "prev_direction"]),
        key="event_id", timestamp="ts", offset="event_id")


def _stations(spark, sf_dir):
    st = transform_stations(stations(spark, sf_dir)).select("station_id", "station_name", "order", "line")
    return to_envelope(st, STATIONS_TOPIC, json_value(st.columns), key="station_id", offset="station_id")


def _summary(spark, sf_dir):
    tc = turnstile_counts(spark, sf_dir)
    return to_envelope(tc, SUMMARY_TOPIC,
                       json_value([F.col("station_id").alias("STATION_ID"), F.col("count").alias("COUNT")]),
                       key="station_id", offset="station_id")


def _deposits(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_custkey").cast("string").alias("accountNumber"),
        F.col("o_totalprice").cast("float").alias("amount"),
        F.date_format("o_orderdate", "MMM d, yyyy, h:mm:ss a").alias("dateAndTime"))
    return to_envelope(o, DEPOSITS, json_value(["accountNumber", "amount", "dateAndTime"]),
                       key="accountNumber", timestamp="o_orderdate", offset="o_orderkey")


def _withdrawals(spark, sf_dir):
    w = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("transactionId"), "l_linenumber",
        F.col("l_extendedprice").alias("amount"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("at"))
    return to_envelope(w, WITHDRAWALS, json_value(["transactionId", "l_linenumber", "amount"]),
                       key="transactionId", offset="at")


def _atm(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("atmTransactionId"), "o_orderkey", "o_orderdate",
        F.col("o_custkey").cast("string").alias("accountNumber"), F.col("o_orderdate").alias("transactionDate"))
    return to_envelope(o, ATM, json_value(["atmTransactionId", "accountNumber", "transactionDate"]),
                       key="atmTransactionId", timestamp="o_orderdate", offset="o_orderkey")


def _vehicles(spark, sf_dir):
    v = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("statusTruckNumber"),
        F.col("l_quantity").cast("int").alias("milesFromShop"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("at"))
    return to_envelope(v, VEHICLES, json_value(["l_orderkey", "l_linenumber", "statusTruckNumber", "milesFromShop"]),
                       key="statusTruckNumber", offset="at")


def _checkins(spark, sf_dir):
    c = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_suppkey").cast("string").alias("checkinTruckNumber"), F.col("s_name").alias("locationName"))
    return to_envelope(c, CHECKINS, json_value(["checkinTruckNumber", "locationName"]),
                       key="checkinTruckNumber", offset="s_suppkey")


def _versions(spark, sf_dir):
    """Clicks written by producers of several ages, each body with its schema's id."""
    e = table(spark, sf_dir, "events").withColumn("age", (F.col("event_id") % 5).cast("int"))
    k = json_get("props", "$.k", "int")
    body = (F.when(F.col("age") == 0, F.to_json(F.struct(
                "event_id", F.col("user_id").cast("int").alias("user_id"), "event_type", F.col("value").cast("long").alias("value"))))
            .when(F.col("age") == 1, F.to_json(F.struct(
                "event_id", F.col("user_id").alias("user_ref"), "event_type", "value", F.lit("app").alias("channel"))))
            .when(F.col("age") == 2, F.to_json(F.struct(
                "event_id", "user_id", "event_type", "value", F.lit("web").alias("channel"),
                F.create_map(F.lit("k"), F.struct(k.alias("n"))).alias("counts"))))
            .otherwise(F.to_json(F.struct("event_id", "user_id", F.length("event_type").alias("event_type")))))
    return to_envelope(e.withColumn("body", framed(body, F.col("age") + 1)), VERSIONS, "body", key="user_id", timestamp="ts",
                       offset="event_id")


ARRIVALS = "arrivals"  # all arrival topics
FEEDS = {CLICKS: _clicks, FUEL: _fuel, DRIFT: _drift, CUSTOMERS: _customers, MIXED: _mixed,
         BALANCES: _balances, RISK: _risk, ARRIVALS: _arrivals, STATIONS_TOPIC: _stations,
         SUMMARY_TOPIC: _summary, DEPOSITS: _deposits, WITHDRAWALS: _withdrawals, ATM: _atm,
         VEHICLES: _vehicles, CHECKINS: _checkins, VERSIONS: _versions}

#: Tables each feed is derived from.
FEED_TABLES = {CLICKS: ["events"], FUEL: ["events"], DRIFT: ["events"], CUSTOMERS: ["customer", "nation"],
               MIXED: ["customer", "nation", "orders"], BALANCES: ["customer"], RISK: ["orders"],
               ARRIVALS: ["events"], STATIONS_TOPIC: ["nation", "region"], SUMMARY_TOPIC: ["events"],
               DEPOSITS: ["orders"], WITHDRAWALS: ["lineitem"], ATM: ["orders"], VEHICLES: ["lineitem"],
               CHECKINS: ["supplier"], VERSIONS: ["events"]}


def table_paths(sf_dir: str, names=TABLES) -> list:
    return [f"{sf_dir.rstrip('/')}/{n}.parquet" for n in names]


def bus(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Write one feed, when first wanted, into a file-backed topic folder;
    returns the folder. It is reused by later queries, runs and processes as
    long as the feed's tables and the code are unchanged."""
    return derived_path(spark, f"bus-{name.rstrip('.')}", table_paths(sf_dir, FEED_TABLES[name]),
                        lambda path: write_topic(feed(spark, sf_dir, name), path, mode="overwrite"))
