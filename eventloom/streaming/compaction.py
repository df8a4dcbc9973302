"""Compaction of file-backed topics.

A topic folder grows by files of messages. Compaction rewrites what is there so
that of every key only the last message stays; a last message without a value
(a tombstone) deletes its key, and is itself removed once it is older than the
delete retention. Messages without a key are kept.

Nothing is changed in place: the kept messages are written to a folder of their
own, and a numbered manifest, published by one rename, names that folder and
the files it stands for. Readers take the newest manifest's folder and the
topic's files that it doesn't name, so they see every message once, before,
while and after a compaction runs; a compaction that fails leaves the manifest
as it was. Files that an older manifest stood for are removed one compaction
later, when readers that had opened them are done.

The keys are found by a keyed aggregate (``max_by`` over the offset, combined
before the shuffle), so a key that holds most of the topic is no burden.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.schemas import ENVELOPE
from eventloom.session import _fs
from eventloom.sources.topics import ENVELOPE_COLUMNS
from eventloom.streaming.tables import _load, _manifests, _publish


def _home(path: str, topic: str) -> str:
    # names that start with "_" are no part of the topic to its other readers
    return f"{path}/_compacted/{topic}"


def _topic_files(spark: SparkSession, path: str, topic: str) -> list[str]:
    folder, fs = _fs(spark, f"{path}/topic={topic}")
    if not fs.exists(folder):
        return []
    names = (f.getPath() for f in fs.listStatus(folder) if f.isFile())
    return sorted(str(p) for p in names if not p.getName().startswith(("_", ".")))


def _read(spark: SparkSession, topic: str, files: list[str]) -> DataFrame:
    rows = spark.read.schema(ENVELOPE).parquet(*files) if files else spark.createDataFrame([], ENVELOPE)
    return rows.withColumn("topic", F.lit(topic)).select(*ENVELOPE_COLUMNS)


def read_log(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """The topic's messages: the compacted part and what came since."""
    numbers = _manifests(spark, _home(path, topic))
    now = _load(spark, _home(path, topic), numbers[-1]) if numbers else {"folder": None, "files": []}
    files = [f for f in _topic_files(spark, path, topic) if f not in set(now["files"])]
    return _read(spark, topic, files + ([now["folder"]] if now["folder"] else []))


def compact_topic(spark: SparkSession, path: str, topic: str, retention_seconds: int | None = None) -> int:
    """Compact what the topic holds now; returns the version that was published.
    ``retention_seconds``: tombstones stay until the topic's newest message is
    that much younger; None: for good."""
    home = _home(path, topic)
    numbers = _manifests(spark, home)
    before = _load(spark, home, numbers[-1]) if numbers else {"folder": None, "files": []}
    there = _topic_files(spark, path, topic)
    merged = set(before["files"])
    files = [f for f in there if f not in merged]
    if not files:
        return numbers[-1] if numbers else 0
    log = _read(spark, topic, files + ([before["folder"]] if before["folder"] else []))
    message = F.struct(*[c for c in ENVELOPE_COLUMNS if c != "key"])
    last = (log.filter("key is not null").groupBy("key").agg(F.max_by(message, F.struct("offset", "partition")).alias("m"))
            .select("key", "m.*").select(*ENVELOPE_COLUMNS))
    if retention_seconds is not None:
        newest = log.agg(F.max("timestamp")).first()[0]
        if newest is not None:
            old = F.col("timestamp") < F.lit(newest) - F.make_dt_interval(secs=F.lit(retention_seconds))
            last = last.filter(F.col("value").isNotNull() | ~F.coalesce(old, F.lit(False)))
    number = (numbers[-1] if numbers else 0) + 1
    folder = f"{home}/v{number}-{uuid.uuid4().hex[:8]}"
    last.unionByName(log.filter("key is null")).write.parquet(folder)
    # files that are still there are named until they are gone, should the removal below not be reached
    done = [f for f in there if f in merged]
    _publish(spark, home, number, {"folder": folder, "files": files + done})
    # what the version before stood for: its readers have had a compaction's time
    for gone in [*done, *_older(spark, home, number)]:
        p, fs = _fs(spark, gone)
        fs.delete(p, True)
    return number


def _older(spark: SparkSession, home: str, number: int) -> list[str]:
    """Folders of versions before the last one."""
    root, fs = _fs(spark, home)
    names = [str(f.getPath()) for f in fs.listStatus(root) if f.getPath().getName().startswith("v")]
    number_of = lambda p: int(p.rsplit("/", 1)[1][1:].split("-")[0])
    return [p for p in names if number_of(p) < number - 1]
