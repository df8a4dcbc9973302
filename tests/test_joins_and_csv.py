"""Stream joins whose state ends, CSV rejects, histograms with totals."""

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from eventloom.operators import aggregates as A
from eventloom.operators import joins as J
from eventloom.plans.registry import JOIN_STATE
from eventloom.sources import files as FS
from eventloom.streaming import runner as RN


def test_state_of_a_bounded_join_stays_flat(spark, tmp_path):
    name, out = f"flat-{uuid.uuid4().hex}", str(tmp_path / "out")
    sizes = []
    for n in range(6):
        ids = spark.range(n * 1000, n * 1000 + 1000)
        at = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp") + F.make_dt_interval(secs=F.col("id").cast("int"))
        ids.select("id", at.alias("t")).write.mode("append").parquet(str(tmp_path / "a"))
        ids.select(F.col("id").alias("of"), (at + F.expr("INTERVAL 30 SECONDS")).alias("u")).write.mode("append").parquet(str(tmp_path / "b"))
        a = spark.readStream.schema("id long, t timestamp").parquet(str(tmp_path / "a"))
        b = spark.readStream.schema("of long, u timestamp").parquet(str(tmp_path / "b"))
        j = J.join(a, b, F.col("id") == F.col("of"), "inner", ("t", "10 seconds"), ("u", "10 seconds"),
                   F.expr("u >= t AND u <= t + INTERVAL 1 MINUTE"))
        _, progress = RN.run_available(j, name, path=out, state_partitions=2, settings=JOIN_STATE)
        sizes.append(progress[-1]["stateOperators"][0]["numRowsTotal"])
    assert spark.read.parquet(out).count() == 6000
    assert max(sizes) <= 400 and max(sizes[3:]) <= max(sizes[:3])  # of 2,000 rows that each slice adds


def test_csv_rejects_say_why(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,amount,note\n1,0.5,a\n2,abc,b\n3,,c\n,1.0,d\n5,1\n6,2.0,e\n6,3.0,f\n7,4.0,\n8,1.5,x,extra\n6,abc,g\n")
    schema = StructType([StructField("id", LongType(), False), StructField("amount", DoubleType()), StructField("note", StringType())])
    got = FS.read_csv_flagged(spark, str(tmp_path / "t.csv"), schema, ["id"]).collect()
    why = {(r.id, r.note): (r.reason or "").split(":")[0] for r in got}
    assert len(got) == 10 and why[(1, "a")] == why[(3, "c")] == why[(7, None)] == ""
    assert why[(2, "b")] == why[(5, None)] == why[(6, "g")] == "doesn't fit" and why[(None, "d")] == "id is null"
    assert why[(6, "e")] == why[(6, "f")] == "repeated key" and why[(8, "x")] == "doesn't fit"
    good, rejects = FS.read_csv_table(spark, str(tmp_path / "t.csv"), schema, ["id"])
    assert sorted(r.id for r in good.select("id").collect()) == [1, 3, 7] and rejects.count() == 7
    assert good.select("note").count() == 3  # the same rows, whichever columns are read


def test_histogram_with_total_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 2.0), ("a", "y", None), (None, "x", 4.0), (None, None, 1.0)], "k string, v string, m double")
    got = sorted((tuple(r) for r in A.histogram_with_total(df, "k", "v", "m").collect()), key=str)
    assert got == sorted([("a", "x", 2, 3.0), ("a", "y", 1, 3.0), (None, "x", 1, 5.0), (None, None, 1, 5.0)], key=str)
