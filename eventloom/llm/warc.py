"""WARC archives in seekable Zstandard bundles.

A bundle is one file of independent Zstandard frames, each holding whole WARC
records of about ``FRAME_BYTES``, followed by a skippable frame with the seek
table of the public seekable format: compressed and decompressed size of each
frame, their number, and a magic number. Ordinary tools decompress the file;
a reader that wants one record opens its frame alone.

Writers return an index row per record: bundle, frame, offset inside the
frame, and length. The index is written by Spark, whose commit keeps only the
rows of tasks that succeeded; bundle names hold a random part of their own, so
what a lost or repeated task leaves behind is in no index and never read.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, the one with
the smallest id is the response and the others revisit it. Equal payloads are
found by digest: only ids and digests are aggregated, map-side first, so a
payload shared by a third of all rows is one row per task there. The join that
brings the first id back is on the digest, where the engine splits a hot one.

Null payloads are empty. A null id is written as an empty WARC-Record-ID part
and never stands for others: among equal payloads those with an id come
first, and if no row has one, all are responses. Rows that repeat the smallest
id are all responses. Long payloads make a frame of their own. Tables with
other columns are fine: only id, url and payload are read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import materialise, shared_folder
from eventloom.session import _fs

FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 64 << 20
MIN_REVISIT = 100
LEVEL = 3
#: Magic numbers of the public seekable format (fixed values).
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "2000-01-01T00:00:00Z"  # the tables have no fetch time


# --- records -------------------------------------------------------------

def record(key: str, url: str, payload: bytes, digest: str, size: int, refers_to: str | None) -> bytes:
    """One WARC/1.1 record; a revisit has no block but keeps digest and size."""
    kind = "response" if refers_to is None else "revisit"
    block = payload if refers_to is None else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{key}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {size}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``."""
    body = data.index(b"\r\n\r\n", at) + 4
    lines = data[at:body - 4].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record at {at}")
    head = dict(line.split(": ", 1) for line in lines[1:])
    end = body + int(head["Content-Length"])
    if data[end:end + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {at} is cut off")
    return head, data[body:end], end + 4


def _key(uri: str | None) -> str | None:
    return uri[len("<urn:page:"):-1] or None if uri else None


# --- bundles -------------------------------------------------------------

def filesystem(path: str):
    """The file system and path inside it of a local or remote URI."""
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path[len("file:"):])
    return fs.LocalFileSystem(), path


class BundleWriter:
    """Writes records into frames, and the seek table at the end."""

    def __init__(self, folder: str, frame_bytes: int = FRAME_BYTES):
        import zstandard
        self._frame_bytes = frame_bytes
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        self._fs, inner = filesystem(self.path)
        self._out = self._fs.open_output_stream(inner, compression=None)  # the name must not add a second layer
        self._zstd = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self._frame: list[bytes] = []
        self._held = self.written = 0
        self._table: list[tuple[int, int]] = []

    def add(self, rec: bytes) -> tuple[int, int, int]:
        """Frame, offset and length of the record."""
        if self._held and self._held + len(rec) > self._frame_bytes:
            self._flush()
        place = (len(self._table), self._held, len(rec))
        self._frame.append(rec)
        self._held += len(rec)
        return place

    def _flush(self) -> None:
        if self._held:
            packed = self._zstd.compress(b"".join(self._frame))
            self._out.write(packed)
            self._table.append((len(packed), self._held))
            self.written += len(packed)
            self._frame, self._held = [], 0

    def close(self) -> None:
        self._flush()
        entries = b"".join(struct.pack("<II", *e) for e in self._table)
        foot = struct.pack("<IBI", len(self._table), 0, SEEKABLE)
        self._out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(foot)) + entries + foot)
        self._out.close()


class BundleReader:
    """Frames of a bundle by number, found from the seek table alone."""

    def __init__(self, path: str):
        import zstandard
        fs, inner = filesystem(path)
        self._in = fs.open_input_file(inner)
        size = self._in.size()
        frames, flags, magic = struct.unpack("<IBI", self._in.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        width = 12 if flags & 0x80 else 8
        table = self._in.read_at(frames * width, size - 9 - frames * width)
        at, self.frames = 0, []
        for i in range(frames):
            packed, plain = struct.unpack_from("<II", table, i * width)
            self.frames.append((at, packed, plain))
            at += packed
        self._zstd = zstandard.ZstdDecompressor()

    def frame(self, i: int) -> bytes:
        at, packed, plain = self.frames[i]
        return self._zstd.decompress(self._in.read_at(packed, at), max_output_size=max(plain, 1))

    def close(self) -> None:
        self._in.close()


# --- Spark ---------------------------------------------------------------

INDEX = "page_id long, bundle string, frame int, offset long, length long"
_INDEX = pa.schema([("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()),
                    ("offset", pa.int64()), ("length", pa.int64())])


def planned(pages: DataFrame) -> DataFrame:
    """Pages with payload, size, digest, and the response a revisit refers to."""
    base = pages.select(F.col("page_id").cast("long"), F.coalesce("url", F.lit("")).alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    base = base.withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                             "payload_digest": F.sha2("payload", 256)})
    firsts = (base.filter(F.col("payload_bytes") >= MIN_REVISIT)
              .groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .filter((F.col("n") > 1) & F.col("first").isNotNull()).drop("n"))
    refers = F.when((F.col("payload_bytes") >= MIN_REVISIT) & ~F.col("page_id").eqNullSafe(F.col("first")),
                    F.col("first"))
    return base.join(firsts, "payload_digest", "left").withColumn("refers_to", refers).drop("first")


def write_bundles(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write all pages as bundles below ``folder``; the index, one row a record."""
    spark = pages.sparkSession
    path, fs = _fs(spark, folder)
    fs.mkdirs(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, rows = None, []

        def close():
            nonlocal bundle, rows
            bundle.close()
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _INDEX)], schema=_INDEX)
            bundle, rows = None, []
            return out

        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for i in range(len(batch)):
                v = {n: c[i].as_py() for n, c in col.items()}
                if bundle is None:
                    bundle = BundleWriter(folder, frame_bytes)
                key, ref = v["page_id"], v["refers_to"]
                url = v["url"].replace("\r", "%0D").replace("\n", "%0A")
                place = bundle.add(record("" if key is None else str(key), url, v["payload"], v["payload_digest"],
                                          v["payload_bytes"], None if ref is None else str(ref)))
                rows.append((key, bundle.path, *place))
                if bundle.written >= BUNDLE_BYTES:
                    yield close()
        if bundle is not None:
            yield close()

    return materialise(planned(pages).mapInArrow(run, INDEX), "warc-index")


RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, payload binary")


def _read(head: dict[str, str], block: bytes) -> dict:
    kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(head["WARC-Payload-Length"])
    if kind == "response" and (hashlib.sha256(block).hexdigest() != digest or len(block) != size):
        raise ValueError(f"payload of {head['WARC-Record-ID']} differs from its digest")
    key, ref = _key(head["WARC-Record-ID"]), _key(head.get("WARC-Refers-To"))
    return {"page_id": None if key is None else int(key), "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": None if ref is None else int(ref),
            "payload": block if kind == "response" else None}


_RECORD_TYPES = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
                 "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}


def _batch(rows: list[dict], payload: bool) -> pa.RecordBatch:
    kept = {n: t for n, t in _RECORD_TYPES.items() if payload or n != "payload"}
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in kept.items()], names=list(kept))


#: Tasks that read bundles, at most.
TASKS = 20_000


def read_bundles(index: DataFrame, payload: bool = True) -> DataFrame:
    """All records of the bundles named in an index, frame by frame."""
    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                reader = BundleReader(path)
                for i in range(len(reader.frames)):
                    data, at, rows = reader.frame(i), 0, []
                    while at < len(data):
                        head, block, at = parse(data, at)
                        rows.append(_read(head, block))
                    yield _batch(rows, payload)
                reader.close()

    schema = RECORDS if payload else RECORDS.removesuffix(", payload binary")
    bundles = index.select("bundle").distinct()
    # about one task a bundle (a bundle's size is bounded, their number grows with the
    # data); a stated number of partitions is not merged for being a few bytes of names
    tasks = max(1, min(bundles.count(), TASKS))
    return bundles.repartition(tasks, "bundle").mapInArrow(run, schema)


def lookup(index: DataFrame, ids: DataFrame) -> DataFrame:
    """Records of the ids in ``ids.page_id``, opening only the frames that hold them."""
    def run(batches):
        for batch in batches:
            rows, path, reader, frame, data = [], None, None, None, b""
            for r in sorted(batch.to_pylist(), key=lambda r: (r["bundle"], r["frame"], r["offset"])):
                if r["bundle"] != path:
                    path, reader, frame = r["bundle"], BundleReader(r["bundle"]), None
                if r["frame"] != frame:
                    frame, data = r["frame"], reader.frame(r["frame"])
                head, block, _ = parse(data[r["offset"]:r["offset"] + r["length"]])
                rows.append(_read(head, block))
            yield _batch(rows, True)

    return (index.join(ids.select("page_id").distinct(), "page_id", "left_semi")
            .select("bundle", "frame", "offset", "length")
            .repartition("bundle").sortWithinPartitions("bundle", "frame", "offset")
            .mapInArrow(run, RECORDS))


def archive(pages: DataFrame) -> DataFrame:
    """The contract's rows: write ``pages`` as bundles, read the bundles back."""
    index = write_bundles(pages, shared_folder(pages.sparkSession, "warc"))
    return read_bundles(index, payload=False)


REPORT_SQL = f"""
SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha256(b) AS payload_digest,
       CASE WHEN octet_length(b) >= {MIN_REVISIT} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(b) >= {MIN_REVISIT} AND page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, CAST(encode(coalesce(html, '')) AS BLOB) AS b,
             min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)"""
