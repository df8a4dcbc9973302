"""Late rows as an output of their own.

The engine drops rows that come after the watermark has passed them, and can
only count them after partial aggregation. Here every row is compared with the
watermark of its own micro-batch (the latest event time of all batches before,
less the delay): rows at or after it go on, earlier ones are written to a topic
or folder of late rows. Nothing is dropped, so on-time and late rows together
are the input.

The mark before each batch is stored under the batch's id, next to what the
batch wrote, before the next one starts; a batch that runs again reads the mark
it had and replaces its own output.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from eventloom.session import _fs
from eventloom.streaming.sinks import for_each_batch

LATE = "is_late"


def _mark(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The latest event time (microseconds) of the batches before this one."""
    p, fs = _fs(spark, f"{path}/_marks/{batch_id}.json")
    if batch_id == 0 or not fs.exists(p):
        return None
    return json.loads("".join(r[0] for r in spark.read.text(str(p)).collect()))["latest"]


def _store(spark: SparkSession, path: str, batch_id: int, latest: int | None) -> None:
    aside, fs = _fs(spark, f"{path}/_marks/.{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps({"latest": latest}).encode()))
    out.close()
    final, _ = _fs(spark, f"{path}/_marks/{batch_id}.json")
    fs.delete(final, False)
    if not fs.rename(aside, final):
        raise RuntimeError(f"cannot store the mark of batch {batch_id} in {path}")


def route_late(df: DataFrame, ts: str, delay_seconds: int, query_name: str, path: str, **run_kw) -> tuple[str, list]:
    """Run a stream and write its rows to ``path``, split by the column
    ``is_late`` (read them with :func:`read_routed`). Rows without an event time
    are never late."""
    spark = df.sparkSession

    def route(batch: DataFrame, batch_id: int) -> None:
        before = _mark(spark, path, batch_id)
        at = F.unix_micros(F.col(ts).cast("timestamp"))
        late = F.lit(False) if before is None else F.coalesce(at < before - delay_seconds * 1_000_000, F.lit(False))
        out = f"{path}/batch_id={batch_id}"
        batch.withColumn(LATE, late).write.mode("overwrite").partitionBy(LATE).parquet(out)
        written = spark.read.schema(batch.schema).parquet(out)
        here = written.agg(F.max(at)).first()[0]
        _store(spark, path, batch_id + 1, max([x for x in (before, here) if x is not None], default=None))

    return for_each_batch(df, query_name, route, **run_kw)


def read_routed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows with ``is_late`` and ``batch_id``."""
    fields = [*schema.fields, StructField(LATE, BooleanType()), StructField("batch_id", LongType())]
    return spark.read.schema(StructType(fields)).parquet(path)
