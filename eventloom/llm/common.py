"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom import session

#: Text handled at once by a numpy step: bounds a worker's memory whatever the
#: Arrow batch holds. One longer text is still processed whole.
CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    session._ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` (its own only if unset)."""
    return session.scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write below the shared folder, read back."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int | None = None, max_bytes: int | None = None):
    """Jobs run inside send Python at most ``rows`` rows or ``max_bytes`` (and the
    row that passes them) at once: a batch stands in the executor's memory and
    again in its worker's."""
    before = {k: (spark.conf.get(k), n) for k, n in ((BATCH_ROWS, rows), (BATCH_BYTES, max_bytes)) if n}
    for k, (old, n) in before.items():
        held = int(old.rstrip("bB"))
        spark.conf.set(k, str(min(n, held) if held > 0 else n))
    try:
        yield
    finally:
        for k, (old, _) in before.items():
            spark.conf.set(k, old)


def input_bytes(df: DataFrame) -> int:
    """Size of the files behind a DataFrame, from the file listing alone."""
    spark = df.sparkSession
    total = 0
    for f in df.inputFiles():
        p, fs = session._fs(spark, f)
        total += int(fs.getFileStatus(p).getLen())
    return total


def chunks(batch: pa.RecordBatch, text: str, max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts sum to ``max_bytes``, or one longer text."""
    col = batch.column(batch.schema.get_field_index(text))
    n = len(col)
    if not n:
        return
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64))
    at = 0
    while at < n:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
        yield batch.slice(at, to - at)
        at = to


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column, one after another, and their offsets; null is empty."""
    col = pc.fill_null(col.cast(pa.large_binary()), b"")
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[off[0]:off[-1]] if raw is not None else np.empty(0, np.uint8)
    return data, off - off[0]


def per_chunk(fn: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]], text: str = "text",
              max_bytes: int = CHUNK_BYTES):
    """A mapInArrow function that applies ``fn`` to bounded slices."""
    def run(batches):
        for batch in batches:
            for part in chunks(batch, text, max_bytes):
                out = fn(part)
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield from out
    return run


class RowIds:
    """Row numbers unique over a job: the partition's number in the high bits.

    The inputs are file scans, whose partitions hold the same rows in the same
    order when a lost task runs again, so the numbers are repeatable."""

    def __init__(self) -> None:
        from pyspark import TaskContext
        self.next = TaskContext.get().partitionId() << 40

    def take(self, n: int) -> np.ndarray:
        self.next += n
        return np.arange(self.next - n, self.next, dtype=np.int64)


def sha256_hex(data: bytes) -> str:
    import hashlib
    return hashlib.sha256(data).hexdigest()


def row_key(docs: DataFrame) -> Column:
    """The document's id; for a null id a hash of its text."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))


#: Bits of a bitmap of ids: a prime near 2^23, so 1 MB whatever the data.
BITMAP = 8_388_593


def bitmap(df: DataFrame, col: str) -> np.ndarray:
    """Which remainders mod BITMAP occur in a column. At most BITMAP/64 rows
    reach the driver."""
    bit = F.pmod(F.col(col), F.lit(BITMAP))
    words = (df.select((bit / 64).cast("long").alias("w"), F.expr(f"shiftleft(1L, cast(pmod({col}, {BITMAP}) % 64 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    out = np.zeros(BITMAP // 64 + 1, np.int64)
    for r in words.collect():
        out[r["w"]] = r["b"]
    return out


def in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values.astype(np.int64) % BITMAP
    return (bits[at >> 6] >> (at & 63) & 1).astype(bool)


def wrapped(docs: DataFrame) -> DataFrame:
    """(row, key, doc_id, text): the whole row in one column, so that no other
    column's name can clash with those an operator adds."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       row_key(docs).alias("key"), F.col("doc_id"), F.col("text"))
