"""Named streams and persistent queries that outlive the driver.

Every statement is logged as a small file below the checkpoint root before it
takes effect: a stream's topic, columns and format, a query's SQL and the topic
it writes. A new session restores them: streams are declared again, queries
resume from their checkpoints. Creating the same thing twice changes nothing; a
name can't get another meaning while it is in use. A stream that a logged query
reads can't be dropped, whether that query runs in this session, or in none.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eventloom.plans.catalog import CatalogError, declare, views_of
from eventloom.session import _checkpoint_root, _fs
from eventloom.sources.topics import read_topic
from eventloom.streaming import runner, sinks


class Catalog:
    """The log in ``folder`` (one per application by default)."""

    def __init__(self, spark: SparkSession, folder: str | None = None, state_partitions: int | None = None):
        self.spark, self.state_partitions = spark, state_partitions
        self.folder = folder or f"{_checkpoint_root(spark)}/eventloom/catalog"

    # -- the log

    def _names(self, kind: str) -> list[str]:
        p, fs = _fs(self.spark, f"{self.folder}/{kind}")
        if not fs.exists(p):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return sorted(n[:-5] for n in names if n.endswith(".json") and not n.startswith("."))

    def _logged(self, kind: str, name: str) -> dict | None:
        p, fs = _fs(self.spark, f"{self.folder}/{kind}/{name}.json")
        return json.loads("\n".join(r[0] for r in self.spark.read.text(str(p)).collect())) if fs.exists(p) else None

    def _log(self, kind: str, name: str, statement: dict) -> bool:
        """Whether the statement is new."""
        if not name or "/" in name or name.startswith("."):
            raise CatalogError(f"not a name: {name!r}")
        known = self._logged(kind, name)
        if known is not None:
            if known != statement:
                raise CatalogError(f"{name} already stands for something else; drop it first")
            return False
        aside, fs = _fs(self.spark, f"{self.folder}/{kind}/.{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps(statement).encode()))
        out.close()
        final, _ = _fs(self.spark, f"{self.folder}/{kind}/{name}.json")
        if fs.exists(final) or not fs.rename(aside, final):
            fs.delete(aside, False)
            return self._log(kind, name, statement)  # another driver was first
        return True

    def _forget(self, kind: str, name: str) -> bool:
        p, fs = _fs(self.spark, f"{self.folder}/{kind}/{name}.json")
        return fs.delete(p, False)

    # -- streams

    def create_stream(self, name: str, path: str, topic: str, schema: StructType) -> DataFrame:
        """Declare a stream over a file-backed topic with JSON values."""
        self._log("streams", name, {"path": path, "topic": topic, "schema": schema.jsonValue()})
        return self._declare(name)

    def _declare(self, name: str) -> DataFrame:
        s = self._logged("streams", name)
        env = read_topic(self.spark, s["path"], topics=s["topic"], stream=True)
        return declare(self.spark, name, env, StructType.fromJson(s["schema"]))

    def drop_stream(self, name: str) -> bool:
        users = [q for q in self._names("queries") if name.lower() in self._logged("queries", q)["reads"]]
        if users:
            raise CatalogError(f"cannot drop {name}: read by queries {users}; terminate them first")
        self.spark.catalog.dropTempView(name)
        return self._forget("streams", name)

    # -- queries

    def create_query(self, name: str, sql: str, key: str, topic: str, path: str, offset: str) -> StreamingQuery:
        """CREATE STREAM … AS SELECT: run ``sql`` over declared streams into a
        topic, keyed by one of its columns, and keep it running."""
        reads = sorted(views_of(self.spark.sql(sql)._jdf.queryExecution().analyzed()))
        self._log("queries", name, {"sql": sql, "key": key, "topic": topic, "path": path, "offset": offset, "reads": reads})
        return self._start(name)

    def _start(self, name: str) -> StreamingQuery:
        running = self._running(name)
        if running is not None:
            return running
        s = self._logged("queries", name)
        env = sinks.keyed_json(self.spark.sql(s["sql"]), s["key"], s["topic"], offset=s["offset"])
        return runner.start(env, name, path=s["path"], partition_by=("topic",), trigger={"processingTime": "1 second"},
                            state_partitions=self.state_partitions)

    def _running(self, name: str) -> StreamingQuery | None:
        return next((q for q in self.spark.streams.active if q.name == name), None)

    def restore(self) -> dict[str, StreamingQuery]:
        """Declare all logged streams and resume all logged queries."""
        for name in self._names("streams"):
            self._declare(name)
        return {name: self._start(name) for name in self._names("queries")}

    def terminate(self, name: str) -> bool:
        """Stop a query for good; what it wrote stays. False if there is none."""
        running = self._running(name)
        if running is not None:
            running.stop()
        return self._forget("queries", name)

    def listing(self) -> list[tuple[str, str, str, str]]:
        """(kind, name, state, statement) of everything logged."""
        out = [("stream", n, "declared", self._logged("streams", n)["topic"]) for n in self._names("streams")]
        return out + [("query", n, "stopped" if self._running(n) is None else "running", self._logged("queries", n)["sql"])
                      for n in self._names("queries")]
