"""Latest-value tables materialised from streams.

A stream of changes is merged into a parquet table cut by a hash of the key.
Each micro-batch reads only the buckets its keys fall in, keeps the latest row
per key (``max_by`` on the order columns) and writes those buckets as a new
version. Nothing is changed in place: a numbered manifest names the folder of
every bucket, and the rename that publishes it is the only switch. A reader
takes the newest manifest and sees all of a batch or none of it; a crash
before the switch leaves the old version as it was, and the replayed batch
writes a version of its own. The manifest also holds each query's last merged
batch, so a batch that was published is not merged twice.

With ``deleted`` (a column whose null marks a deletion) a deleted key leaves the
table that readers see, but its row stays as a tombstone, so that an older
value that arrives late, after a restart or once the buckets were dealt anew,
doesn't bring it back. Tombstones older than ``retention_seconds`` before the
newest event merged so far are removed when their bucket is next written.

Buckets are counted by the data: when they hold more than ``BUCKET_ROWS`` rows
on average, the next merge writes the whole table with twice as many.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from eventloom.operators.tables import latest
from eventloom.session import _fs
from eventloom.streaming.runner import run_available

BUCKET = "_bucket"
#: Rows per bucket at which the number of buckets doubles.
BUCKET_ROWS = 1_000_000
#: Manifests (and the folders they name) that stay for readers that opened them.
KEPT_VERSIONS = 3


def _bucket_of(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _manifests(spark: SparkSession, path: str) -> list[int]:
    root, fs = _fs(spark, f"{path}/_manifests")
    if not fs.exists(root):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(root)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def _load(spark: SparkSession, path: str, number: int) -> dict:
    # one small file: a folder name per bucket
    return json.loads("".join(r[0] for r in spark.read.text(f"{path}/_manifests/{number}.json").collect()))


def _publish(spark: SparkSession, path: str, number: int, manifest: dict) -> None:
    """Write the manifest under a private name, then rename it to its number."""
    tmp, fs = _fs(spark, f"{path}/_manifests/.{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    final, _ = _fs(spark, f"{path}/_manifests/{number}.json")
    if fs.exists(final) or not fs.rename(tmp, final):
        raise RuntimeError(f"another writer published version {number} of {path}")


def _buckets_written(spark: SparkSession, folder: str) -> list[int]:
    root, fs = _fs(spark, folder)
    names = [f.getPath().getName() for f in fs.listStatus(root)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}="))


def merge_batch(spark: SparkSession, batch: DataFrame, keys: Sequence[str], order: Sequence[str],
                path: str, buckets: int, batch_id: int, query: str = "batch", deleted: str | None = None,
                retention_seconds: int | None = None) -> None:
    """Merge one batch of changes into the table at ``path``. ``buckets`` is
    the number a new table starts with. ``retention_seconds`` needs the first
    of ``order`` to be the event time."""
    cols = list(batch.columns)
    numbers = _manifests(spark, path)
    now = _load(spark, path, numbers[-1]) if numbers else {"buckets": buckets, "folders": {}, "rows": {}, "merged": {}}
    if now["merged"].get(query, -1) >= batch_id:
        return
    n = now["buckets"]
    if sum(now["rows"].values()) > BUCKET_ROWS * n:
        n *= 2
    version = f"{path}/v{(numbers[-1] if numbers else 0) + 1}-{uuid.uuid4().hex[:8]}"
    # the batch is evaluated once; its folders tell which buckets it touches
    staged = f"{version}/in"
    batch.withColumn(BUCKET, _bucket_of(keys, n)).write.partitionBy(BUCKET).parquet(staged)
    touched = _buckets_written(spark, staged)
    if not touched:
        return
    schema = StructType([*batch.schema.fields, StructField(BUCKET, IntegerType())])
    changes = spark.read.schema(schema).parquet(staged)
    old = [now["folders"][str(b)] for b in touched if str(b) in now["folders"]] if n == now["buckets"] \
        else list(now["folders"].values())
    if old:
        current = spark.read.schema(batch.schema).parquet(*old).withColumn(BUCKET, _bucket_of(keys, n))
        changes = current.select(*cols, BUCKET).unionByName(changes.select(*cols, BUCKET))
    out = f"{version}/rows"
    rows_ = latest(changes, list(keys), list(order), [c for c in cols if c not in keys] + [BUCKET])
    newest = now.get("newest")
    if deleted is not None and retention_seconds is not None:
        seen = spark.read.schema(schema).parquet(staged).agg(F.max(F.unix_micros(F.col(order[0]).cast("timestamp")))).first()[0]
        newest = max([x for x in (newest, seen) if x is not None], default=None)
        if newest is not None:
            old_ = F.unix_micros(F.col(order[0]).cast("timestamp")) < newest - retention_seconds * 1_000_000
            rows_ = rows_.filter(~(F.col(deleted).isNull() & F.coalesce(old_, F.lit(False))))
    rows_.write.partitionBy(BUCKET).parquet(out)
    written = _buckets_written(spark, out)
    # one number per bucket written
    rows = {str(r[BUCKET]): r["n"] for r in spark.read.schema(schema).parquet(out)
            .groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}
    fresh = {str(b): f"{out}/{BUCKET}={b}" for b in written}
    keep = now if n == now["buckets"] else {"folders": {}, "rows": {}}
    if n == now["buckets"]:  # a bucket of which nothing is left has no folder
        keep = {k: {b: v for b, v in now[k].items() if int(b) not in touched} for k in ("folders", "rows")}
    _publish(spark, path, (numbers[-1] if numbers else 0) + 1, {
        "buckets": n, "folders": {**keep["folders"], **fresh}, "rows": {**keep["rows"], **rows},
        "merged": {**now["merged"], query: batch_id}, "deleted": deleted, "newest": newest,
        "schema": batch.schema.jsonValue()})
    _drop_old(spark, path)


def _drop_old(spark: SparkSession, path: str) -> None:
    """Remove manifests but the last few, and version folders that none of
    those names. Folders of a version that is being written are newer."""
    numbers = _manifests(spark, path)
    if len(numbers) <= KEPT_VERSIONS:
        return
    named = {f.rsplit("/", 3)[1] for n in numbers[-KEPT_VERSIONS:] for f in _load(spark, path, n)["folders"].values()}
    root, fs = _fs(spark, path)
    for f in fs.listStatus(root):
        name = f.getPath().getName()
        if name.startswith("v") and name not in named and int(name[1:].split("-")[0]) <= numbers[-KEPT_VERSIONS]:
            fs.delete(f.getPath(), True)
    for n in numbers[:-KEPT_VERSIONS]:
        p, _ = _fs(spark, f"{path}/_manifests/{n}.json")
        fs.delete(p, False)


def upsert_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], path: str,
                  query_name: str, buckets: int = 8, deleted: str | None = None,
                  retention_seconds: int | None = None, **run_kw):
    """Run a change stream into a latest-value table at ``path``."""
    spark = df.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(spark, batch, keys, order, path, buckets, batch_id, query_name, deleted, retention_seconds)

    return run_available(df, query_name, foreach_batch=merge, **run_kw)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest published version."""
    numbers = _manifests(spark, path)
    if not numbers:
        raise FileNotFoundError(f"no table at {path}")
    now = _load(spark, path, numbers[-1])
    if not now["folders"]:
        return spark.createDataFrame([], StructType.fromJson(now["schema"]))
    rows = spark.read.parquet(*now["folders"].values())
    return rows if now.get("deleted") is None else rows.filter(F.col(now["deleted"]).isNotNull())
