"""Topics as DataFrames of message envelopes.

A topic is read either from Kafka (``format="kafka"``, needs the Kafka
package on the cluster) or from parquet files holding envelope rows, which is
what the tests use. Files are partitioned by ``topic`` so subscribing to a
topic or a topic pattern prunes whole directories instead of scanning them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventloom.schemas import ENVELOPE
from eventloom.session import _fs

ENVELOPE_COLUMNS = [f.name for f in ENVELOPE.fields]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _as_binary(c: Column, df: DataFrame) -> Column:
    # binary values (e.g. Avro) pass through; anything else is sent as text
    probe = df.select(c.alias("_v")).schema["_v"].dataType
    return c if probe.typeName() == "binary" else c.cast("string").cast("binary")


def to_envelope(df: DataFrame, topic, value, key=None, timestamp=None,
                offset=None, partitions: int = 8) -> DataFrame:
    """Produce rows of ``df`` as messages of ``topic``.

    ``key``/``value`` are columns (cast to binary); ``topic`` a name or a
    column (routing by content); ``offset`` a column that increases with the
    message order of the source, since messages with one key go to one
    partition and offsets order them there. The partition is a hash of the key.
    """
    key_c = _col(key).cast("string") if key is not None else F.lit(None).cast("string")
    topic_c = F.lit(topic) if isinstance(topic, str) else topic
    ts_c = (_col(timestamp).cast("timestamp") if timestamp is not None
            else F.lit(None).cast("timestamp"))
    off_c = _col(offset).cast("long") if offset is not None else F.monotonically_increasing_id()
    part_c = (F.pmod(F.hash(key_c), F.lit(partitions)) if key is not None
              else F.pmod(off_c, F.lit(partitions))).cast("int")
    return df.select(
        key_c.cast("binary").alias("key"),
        _as_binary(_col(value), df).alias("value"),
        topic_c.alias("topic"),
        part_c.alias("partition"),
        off_c.alias("offset"),
        ts_c.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def subscribe(envelopes: DataFrame, topics: str | Iterable[str] | None = None,
              pattern: str | None = None) -> DataFrame:
    """Keep messages of the named topics, or of topics matching a regex."""
    if topics is not None and pattern is not None:
        raise ValueError("give topics or pattern, not both")
    if topics is not None:
        names = [topics] if isinstance(topics, str) else list(topics)
        return envelopes.filter(F.col("topic").isin(names))
    if pattern is not None:
        return envelopes.filter(F.col("topic").rlike(pattern))
    return envelopes


def start_at(envelopes: DataFrame, starting="earliest") -> DataFrame:
    """Apply a start position to a batch read of a topic.

    ``"earliest"`` keeps all; ``"latest"`` keeps none (a batch read has
    nothing after its own end); a mapping ``{topic: {partition: offset}}``
    starts each listed partition at its offset (-2 earliest, -1 latest, as in
    Kafka); a timestamp keeps messages stamped at or after it.
    """
    if starting is None or starting == "earliest":
        return envelopes
    if starting == "latest":
        return envelopes.filter(F.lit(False))
    if isinstance(starting, Mapping):
        cond = None
        for topic, parts in starting.items():
            for part, off in parts.items():
                if int(off) == -2:
                    c = F.lit(True)
                elif int(off) == -1:
                    c = F.lit(False)
                else:
                    c = F.col("offset") >= F.lit(int(off))
                term = (F.col("topic") == topic) & (F.col("partition") == int(part)) & c
                cond = term if cond is None else cond | term
        listed = None
        for topic, parts in starting.items():
            t = (F.col("topic") == topic) & F.col("partition").isin([int(p) for p in parts])
            listed = t if listed is None else listed | t
        # Partitions not listed start at the earliest offset.
        return envelopes.filter(cond | ~listed)
    return envelopes.filter(F.col("timestamp") >= F.lit(starting).cast("timestamp"))


def _epoch_millis(ts: str) -> int:
    import datetime as dt
    t = dt.datetime.fromisoformat(ts)
    if t.tzinfo is None:
        t = t.replace(tzinfo=dt.timezone.utc)
    return int(t.timestamp() * 1000)


def read_topic(spark: SparkSession, path: str | None = None, topics=None, pattern=None,
               starting="earliest", stream: bool = False,
               max_files_per_trigger: int | None = None,
               max_offsets_per_trigger: int | None = None,
               kafka_options: Mapping[str, str] | None = None) -> DataFrame:
    """Read a topic as a batch or streaming DataFrame of envelopes.

    With ``kafka_options`` (``kafka.bootstrap.servers`` …) the Kafka source
    is used and subscription, start offsets and rate limits become its own
    options. Otherwise ``path`` holds envelope parquet files; in streaming
    mode new files are picked up in arrival order, and a start given as
    offsets or a time filters the messages before it.
    """
    if kafka_options is not None:
        reader = spark.readStream if stream else spark.read
        r = reader.format("kafka").options(**dict(kafka_options))
        if topics is not None:
            r = r.option("subscribe", topics if isinstance(topics, str) else ",".join(topics))
        if pattern is not None:
            r = r.option("subscribePattern", pattern)
        if starting in ("earliest", "latest"):
            r = r.option("startingOffsets", starting)
        elif isinstance(starting, str):  # a time: first offset stamped at or after it
            r = r.option("startingTimestamp", str(_epoch_millis(starting)))
        elif isinstance(starting, Mapping):
            import json
            r = r.option("startingOffsets", json.dumps(
                {t: {str(p): int(o) for p, o in ps.items()} for t, ps in starting.items()}))
        if stream and max_offsets_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        return r.load()
    if stream:
        if starting == "latest":
            raise ValueError("file-backed streams cannot start at 'latest'; give offsets or a time")
        r = spark.readStream.format("parquet")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        if isinstance(topics, str):
            # One topic: follow only its own folder.
            no_topic = StructType([f for f in ENVELOPE.fields if f.name != "topic"])
            df = r.schema(no_topic).load(f"{path}/topic={topics}") \
                .withColumn("topic", F.lit(topics))
            # offsets and times are fixed filters, so they hold on every restart
            return start_at(df, starting).select(*ENVELOPE_COLUMNS)
        df = start_at(r.schema(ENVELOPE).load(path), starting)
    else:
        df = spark.read.schema(ENVELOPE).parquet(path)
        df = start_at(df, starting)
    return subscribe(df, topics, pattern).select(*ENVELOPE_COLUMNS)


def write_topic(envelopes: DataFrame, path: str, mode: str = "append") -> None:
    """Batch-produce envelopes into a file-backed topic."""
    envelopes.select(*ENVELOPE_COLUMNS).write.mode(mode).partitionBy("topic").parquet(path)


def replay_slices(envelopes: DataFrame, staging: str, pieces: int) -> list[DataFrame]:
    """A topic cut into ``pieces`` slices by message time, oldest first.

    Bounds are quantiles computed by Spark (bounded memory); the topic is
    written once, a folder per slice. Messages without a time go first."""
    envelopes.withColumn("_slice", time_slices(envelopes, pieces)).write.mode("overwrite").partitionBy("_slice").parquet(staging)
    spark = envelopes.sparkSession
    cut = spark.read.parquet(staging)
    return [cut.filter(F.col("_slice") == i).select(*ENVELOPE_COLUMNS) for i in range(pieces)]


def replay(slices: Iterable[DataFrame], path: str, step) -> None:
    """Append one slice after the other to a file-backed topic and call
    ``step()`` after each, which runs a stream over what is new.

    A stream whose checkpoint outlives the steps takes a whole slice as one
    micro-batch, whatever its number of files, so its watermark only moves
    between slices and nothing that is in time order counts as late."""
    for one in slices:
        write_topic(one, path)
        step()


def stage_slices(envelopes: DataFrame, staging: str, slice_no: Column) -> None:
    """Write a topic once, apart by slice; :func:`publish_slice` puts the slices
    into a topic folder one by one, by renaming their files."""
    (envelopes.select(*ENVELOPE_COLUMNS, slice_no.alias("_slice"))
     .write.mode("overwrite").partitionBy("_slice", "topic").parquet(staging))


def publish_slice(spark: SparkSession, staging: str, number: int, path: str) -> None:
    """Move one staged slice's files into a topic folder (no file is copied)."""
    root, fs = _fs(spark, f"{staging}/_slice={number}")
    if not fs.exists(root):
        return
    for topic in fs.listStatus(root):
        target, _ = _fs(spark, f"{path}/{topic.getPath().getName()}")
        fs.mkdirs(target)
        for f in fs.listStatus(topic.getPath()):
            name = f.getPath().getName()
            if not name.startswith(("_", ".")) and not fs.rename(f.getPath(), _fs(spark, f"{target}/{number}-{name}")[0]):
                raise RuntimeError(f"cannot publish {f.getPath()}")


def time_slices(envelopes: DataFrame, pieces: int) -> Column:
    """A message's slice when the topic is cut by message time into about equal
    ``pieces`` (quantiles computed by Spark); messages without a time go first."""
    at = F.col("timestamp").cast("double")
    bounds = envelopes.select(at.alias("t")).approxQuantile("t", [i / pieces for i in range(1, pieces)], 0.001)
    slice_no = F.lit(0)
    for b in sorted(set(bounds)):
        slice_no = slice_no + F.when(at >= b, 1).otherwise(0)
    return slice_no
