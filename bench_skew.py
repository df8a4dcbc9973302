"""Hot-key experiment: one user holds a third of all events.

Derives $SKEW_COPIES (default 10) time-shifted copies of
$BENCH_SF_DIR/events.parquet, every third event re-keyed to one user, and times the plain Spark
forms of the order-dependent operators against the split forms this
package uses. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from eventloom.operators import windows as W  # noqa: E402
from eventloom.session import build_session, scratch_path  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    copies = int(os.environ.get("SKEW_COPIES", "10"))
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    # time-shifted copies (31 days apart); every third event goes to user -1
    big = ev.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        (F.col("event_id") * copies + F.col("copy")).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(days=F.col("copy") * 31)).alias("ts"),
        F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("user_id"),
        "event_type", "value")
    path = scratch_path(spark, "skew_events")
    big.repartition(cpus * 4).write.mode("overwrite").parquet(path)
    df = spark.read.parquet(path)
    n = df.count()
    out = {"rows": n, "hot_share": round(df.filter("user_id = -1").count() / n, 3)}

    def timed(name, d):
        t = time.time()
        d.write.format("noop").mode("overwrite").save()
        out[name] = round(time.time() - t, 3)

    timed("session_window_plain", W.session_agg(df, "ts", "user_id", "5 minutes", [F.count(F.lit(1)).alias("n")]))
    timed("sessions_bucketed", W.sessions_bucketed(df, "ts", "user_id", 300))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    timed("lag_plain", df.withColumn("prev_event_type", F.lag("event_type").over(w)))
    timed("previous_in_key", W.previous_in_key(df, "user_id", "ts", ["event_id"], ["event_type"]))
    timed("running_plain", W.running_in_window(df, "ts", "user_id", "value", "1 day", ["event_id"]))
    timed("running_split", W.running_in_window(df, "ts", "user_id", "value", "1 day", ["event_id"],
                                               split="1 hour"))
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
