"""Streaming sources whose offset is a position inside files that grow.

Three Python data sources, registered with :func:`register`:

``eventloom-lines``
    the lines of text files that others append to. The offset is a byte
    position per file, always after a line end, so a line that is half written
    waits. A file is known by what it holds: its first bytes and those before
    the position. So a rotated file (``app.log`` to ``app.log.1``) is followed
    under its new name, and one that was truncated or replaced is read from the
    start.

``eventloom-messages``
    a file-backed topic, at most ``messages`` per micro-batch. The offset is the
    number of rows taken from each file; what is left is known from the files'
    footers, so a batch holds exactly that many as long as there are enough,
    also when one file holds many batches.

``eventloom-increments``
    the rows of several tables above the last mark of an increasing column, as
    messages of one topic per table. The offset is a mark per table; the rows
    between two marks are read in ranges, one task for each file that has some
    (by its footers). As with any such column, a row that is committed late
    with a mark below the last one is not seen.

The offset of a micro-batch is logged in the query's checkpoint before the
batch runs, and the batch that failed is read again from the same positions, so
each line, message or row arrives once in a sink that is idempotent per batch.

Paths are folders or files that pyarrow's file systems know (local, HDFS, S3,
GCS). Files are listed on the driver, read by tasks; names that start with
``_`` or ``.`` are not read. An offset holds about a hundred bytes per file.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from eventloom.schemas import ENVELOPE

#: Bytes and rows of one task, and bytes by which a file is recognised.
SPLIT_BYTES, SPLIT_ROWS, KNOWN_BY = 64 << 20, 1 << 20, 256


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def files_below(path: str) -> list[pafs.FileInfo]:
    fs, root = filesystem(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [info]
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    hidden = lambda f: any(p[:1] in "._" for p in f.path[len(root):].split("/") if p)
    return sorted((f for f in found if f.type == pafs.FileType.File and not hidden(f)), key=lambda f: f.path)


class _Reader(DataSourceStreamReader):
    """A reader whose offset is ``{"of": what it reads, "at": {...}}``.

    Spark asks for the latest offset without saying where the stream stands.
    The reader knows that from the last planned batch and, in the first batch
    after a restart, from the offset log of the checkpoint that the option
    ``checkpoint`` names (needed for a limit per batch, and to recognise files
    again after a restart)."""

    def __init__(self, options: dict, of: str):
        self.options, self.of, self.last = dict(options), of, None

    def initialOffset(self) -> dict:
        return {"of": self.of, "at": {}}

    def _logged(self) -> dict | None:
        folder = self.options.get("checkpoint")
        if not folder:
            return None
        fs, root = filesystem(f"{folder}/offsets")
        names = [f for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if f.base_name.isdigit()]
        if not names:
            return None
        with fs.open_input_file(max(names, key=lambda f: int(f.base_name)).path) as f:
            lines = f.read().decode().splitlines()
        found = [json.loads(x) for x in lines if x.startswith("{") and f'"of"' in x]
        return next((x["at"] for x in found if x.get("of") == self.of), None)

    def stands(self) -> dict:
        if self.last is None:
            self.last = self._logged() or {}
        return self.last

    def latestOffset(self) -> dict:
        return {"of": self.of, "at": self.ahead(self.stands())}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.last = end["at"]
        return [InputPartition(p) for p in self.ranges(start["at"], end["at"])]

    def ahead(self, at: dict) -> dict:
        raise NotImplementedError

    def ranges(self, start: dict, end: dict) -> list[tuple]:
        raise NotImplementedError


# ---------------------------------------------------------------- lines

def _digest(data: bytes) -> str:
    return hashlib.sha1(data).hexdigest()[:16]


def _bytes(fs: pafs.FileSystem, path: str, start: int, end: int) -> bytes:
    with fs.open_input_file(path) as f:
        return f.read_at(end - start, start) if end > start else b""


def _line_end(fs: pafs.FileSystem, path: str, start: int, size: int) -> int:
    """The position after the last line end between two positions, or the first."""
    at = size
    with fs.open_input_file(path) as f:
        while at > start:
            low = max(start, at - (1 << 16))
            found = f.read_at(at - low, low).rfind(b"\n")
            if found >= 0:
                return low + found + 1
            at = low
    return start


class _Lines(_Reader):
    """``at``: {number: [name, position, digests of the first bytes and of those before the position]}."""

    def _entry(self, fs: pafs.FileSystem, path: str, pos: int) -> list:
        head = min(pos, KNOWN_BY)
        return [path, pos, _digest(_bytes(fs, path, 0, head)), _digest(_bytes(fs, path, pos - head, pos))]

    def _same(self, fs: pafs.FileSystem, path: str, size: int, entry: list) -> bool:
        _, pos, first, before = entry
        return size >= pos and self._entry(fs, path, pos)[2:] == [first, before]

    def _found(self, at: dict) -> tuple[pafs.FileSystem, dict, list]:
        """Files of the entries (number: file), and files that are new."""
        fs, _ = filesystem(self.of)
        new = {f.path: f for f in files_below(self.of)}
        known = {}
        for n, entry in at.items():  # under its name, else under another one
            f = new.get(entry[0])
            if f is not None and self._same(fs, f.path, f.size, entry):
                known[n] = new.pop(entry[0])
        for n, entry in at.items():
            if n not in known and entry[1]:
                moved = next((p for p, f in new.items() if self._same(fs, p, f.size, entry)), None)
                if moved is not None:
                    known[n] = new.pop(moved)
        return fs, known, list(new.values())

    def ahead(self, at: dict) -> dict:
        fs, known, new = self._found(at)
        out, number = {}, max([int(n) for n in at], default=-1)
        for n, f in known.items():
            pos = _line_end(fs, f.path, at[n][1], f.size)
            out[n] = at[n] if (f.path, pos) == (at[n][0], at[n][1]) else self._entry(fs, f.path, pos)
        for f in new:
            pos = _line_end(fs, f.path, 0, f.size)
            if pos:
                number += 1
                out[str(number)] = self._entry(fs, f.path, pos)
        if at:  # no number is given twice: the largest stays even if its file went
            top = max(at, key=int)
            out.setdefault(top, at[top])
        return dict(sorted(out.items(), key=lambda x: int(x[0])))

    def ranges(self, start: dict, end: dict) -> list[tuple]:
        _, known, _ = self._found({n: e for n, e in end.items() if e[1] > (start[n][1] if n in start else 0)})
        split = int(self.options.get("split", SPLIT_BYTES))
        out = []
        for n, e in end.items():
            a = start[n][1] if n in start else 0
            if e[1] > a:
                if n not in known:
                    raise FileNotFoundError(f"{e[0]} went before its lines up to byte {e[1]} were read")
                cuts = [*range(a, e[1], split), e[1]]
                out += [(known[n].path, a, low, high, e[1]) for low, high in zip(cuts, cuts[1:])]
        return out

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        """The lines that start in ``low:high``."""
        path, first, low, high, last = partition.value
        fs, _ = filesystem(self.of)
        with fs.open_input_file(path) as f:
            if low > first:  # lines that start before belong to the range before
                f.seek(low - 1)
                low = low - 1 + len(_upto_line_end(f, last - low + 1))
            f.seek(low)
            while low < high:
                data = f.read(min(4 << 20, last - low))
                cut = data.rfind(b"\n") + 1
                if not cut:
                    data += _upto_line_end(f, last - low - len(data))
                    cut = len(data)
                lines = data[:cut].split(b"\n")[:-1]
                starts, at = [], low
                for x in lines:
                    starts.append(at)
                    at += len(x) + 1
                keep = sum(s < high for s in starts)
                text = [x[:-1] if x.endswith(b"\r") else x for x in lines[:keep]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.decode("utf-8", "replace") for x in text], pa.string()),
                     pa.array([path] * keep, pa.string()), pa.array(starts[:keep], pa.int64())],
                    names=["value", "file", "position"])
                low += cut
                f.seek(low)


def _upto_line_end(f, most: int) -> bytes:
    out = b""
    while len(out) < most:
        part = f.read(min(1 << 16, most - len(out)))
        if not part:
            break
        end = part.find(b"\n")
        if end >= 0:
            return out + part[:end + 1]
        out += part
    return out


class Lines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "eventloom-lines"

    def schema(self) -> str:
        return "value string, file string, position long"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Lines(self.options, self.options["path"])


# ---------------------------------------------------------------- messages

class _Parquet:
    """Row counts of parquet files by their footers, each read once."""

    def __init__(self):
        self.rows: dict[str, tuple[int, int]] = {}

    def count(self, fs: pafs.FileSystem, f: pafs.FileInfo) -> int:
        if self.rows.get(f.path, (-1, 0))[0] != f.size:
            with fs.open_input_file(f.path) as raw:
                self.rows[f.path] = (f.size, pq.ParquetFile(raw).metadata.num_rows)
        return self.rows[f.path][1]


def _row_range(fs: pafs.FileSystem, path: str, low: int, high: int, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows low..high of a parquet file; only the row groups that hold them are read."""
    with fs.open_input_file(path) as raw:
        file, at = pq.ParquetFile(raw), 0
        have = [c for c in columns if c in file.schema_arrow.names]
        for g in range(file.num_row_groups):
            n = file.metadata.row_group(g).num_rows
            if at < high and at + n > low:
                seen = at
                for batch in file.iter_batches(1 << 14, row_groups=[g], columns=have):
                    a, b = max(low - seen, 0), min(high - seen, len(batch))
                    if a < b:
                        yield batch.slice(a, b - a)
                    seen += len(batch)
            at += n


class _Messages(_Reader):
    """``at``: {file below the path: rows taken}."""

    def __init__(self, options: dict, of: str):
        super().__init__(options, of)
        self.footers = _Parquet()

    def ahead(self, at: dict) -> dict:
        fs, root = filesystem(self.of)
        left = int(self.options["messages"])
        out = dict(at)
        for f in files_below(self.of):
            if left <= 0:
                break
            name = f.path[len(root):].lstrip("/")
            n = min(left, self.footers.count(fs, f) - at.get(name, 0))
            if n > 0:
                out[name] = at.get(name, 0) + n
                left -= n
        return out

    def ranges(self, start: dict, end: dict) -> list[tuple]:
        return [(name, low, min(low + SPLIT_ROWS, high)) for name, high in end.items()
                for low in range(start.get(name, 0), high, SPLIT_ROWS)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        name, low, high = partition.value
        fs, root = filesystem(self.of)
        folder = next((p[6:] for p in name.split("/") if p.startswith("topic=")), self.options.get("topic"))
        names = [f.name for f in ENVELOPE.fields]
        for batch in _row_range(fs, f"{root}/{name}" if name else root, low, high, names):
            cols = []
            for f in names:
                if f == "topic" and f not in batch.schema.names:
                    cols.append(pa.array([folder] * len(batch), pa.string()))
                else:
                    cols.append(batch.column(batch.schema.get_field_index(f)))
                if f in ("timestamp",):
                    cols[-1] = cols[-1].cast(pa.timestamp("us", "UTC"))
            yield pa.RecordBatch.from_arrays(cols, names=names)


class Messages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "eventloom-messages"

    def schema(self) -> StructType:
        return ENVELOPE

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        if int(self.options["messages"]) < 1:
            raise ValueError("messages must be 1 or more")
        return _Messages(self.options, self.options["path"])


# ---------------------------------------------------------------- increments

class _Increments(_Reader):
    """``at``: {table: the largest mark read}. Marks are integers."""

    def __init__(self, options: dict, of: str):
        super().__init__(options, of)
        # {table: [path, column]}: the whitelist
        self.tables = json.loads(options["tables"])
        self.seen: dict[str, tuple] = {}

    def _marks(self, fs: pafs.FileSystem, f: pafs.FileInfo, column: str) -> tuple | None:
        """The least and greatest mark of a file, from its footer."""
        if self.seen.get(f.path, (None,))[0] != f.size:
            with fs.open_input_file(f.path) as raw:
                file = pq.ParquetFile(raw)
                at = file.schema_arrow.names.index(column)
                low, high = [], []
                for g in range(file.num_row_groups):
                    s = file.metadata.row_group(g).column(at).statistics
                    if s is None or not s.has_min_max:
                        part = file.read_row_group(g, columns=[column]).column(0)
                        mm = pc.min_max(part).as_py()
                        low.append(mm["min"]), high.append(mm["max"])
                    else:
                        low.append(s.min), high.append(s.max)
                low, high = [x for x in low if x is not None], [x for x in high if x is not None]
                self.seen[f.path] = (f.size, (min(low), max(high)) if low else None)
        return self.seen[f.path][1]

    def _files(self, table: str) -> Iterator[tuple]:
        path, column = self.tables[table]
        fs, _ = filesystem(path)
        for f in files_below(path):
            marks = self._marks(fs, f, column)
            if marks is not None:
                yield f, marks

    def ahead(self, at: dict) -> dict:
        out = dict(at)
        for table in self.tables:
            top = max([m[1] for _, m in self._files(table)], default=None)
            if top is not None and (table not in at or top > at[table]):
                out[table] = top
        return out

    def ranges(self, start: dict, end: dict) -> list[tuple]:
        return [(table, f.path, start.get(table), end[table]) for table in self.tables if table in end and end[table] != start.get(table)
                for f, (low, high) in self._files(table)
                if low <= end[table] and (table not in start or high > start[table])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        table, path, low, high = partition.value
        column = self.tables[table][1]
        fs, _ = filesystem(self.tables[table][0])
        with fs.open_input_file(path) as raw:
            for batch in pq.ParquetFile(raw).iter_batches(1 << 14):
                mark = batch.column(batch.schema.get_field_index(column)).cast(pa.int64())
                keep = pc.less_equal(mark, high) if low is None else pc.and_(pc.greater(mark, low), pc.less_equal(mark, high))
                batch = batch.filter(pc.fill_null(keep, False))
                mark = batch.column(batch.schema.get_field_index(column)).cast(pa.int64())
                n = len(batch)
                rows = [json.dumps(r, default=_plain, ensure_ascii=False, separators=(",", ":")).encode() for r in batch.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [mark.cast(pa.string()).cast(pa.binary()), pa.array(rows, pa.binary()),
                     pa.array([self.options.get("prefix", "") + table] * n, pa.string()), pa.array([0] * n, pa.int32()), mark,
                     pa.nulls(n, pa.timestamp("us", "UTC")), pa.array([0] * n, pa.int32())],
                    names=[f.name for f in ENVELOPE.fields])


def _plain(x):
    return x.isoformat(timespec="microseconds") if hasattr(x, "hour") else str(x)


class Increments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "eventloom-increments"

    def schema(self) -> StructType:
        return ENVELOPE

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Increments(self.options, self.options["tables"])


# ---------------------------------------------------------------- streams

def register(spark: SparkSession) -> None:
    for source in (Lines, Messages, Increments):
        spark.dataSource.register(source)


def _stream(spark: SparkSession, source: type[DataSource], checkpoint: str | None, **options) -> DataFrame:
    register(spark)
    given = {**options, "checkpoint": checkpoint}
    return spark.readStream.format(source.name()).options(**{k: str(v) for k, v in given.items() if v is not None}).load()


def follow_lines(spark: SparkSession, path: str, checkpoint: str | None = None, split: int | None = None) -> DataFrame:
    """(value, file, position): the lines of growing files; ``position``: a
    line's first byte. ``checkpoint``: the query's checkpoint folder, by which
    files are known again after a restart."""
    return _stream(spark, Lines, checkpoint, path=path, split=split)


def publish_files(spark: SparkSession, source: str, target: str, share: float = 1.0) -> None:
    """Put the first ``share`` of the bytes of every file below ``source`` into
    ``target``, under the same names, a task per file. A file is written aside
    and moved into place, so a follower sees it grow at once, and a task that
    runs again does no harm."""
    paths = [f.path for f in files_below(source)]

    def copy(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, _ = filesystem(source)
                out, folder = filesystem(target)
                out.create_dir(folder, recursive=True)
                name = path.rsplit("/", 1)[1]
                aside = f"{folder}/.{name}.{uuid.uuid4().hex[:8]}"
                left = int(fs.get_file_info(path).size * share)
                with fs.open_input_stream(path) as f, out.open_output_stream(aside) as g:
                    while left and (data := f.read(min(4 << 20, left))):
                        g.write(data)
                        left -= len(data)
                out.move(aside, f"{folder}/{name}")
            yield batch
    if paths:
        (spark.createDataFrame([(p,) for p in paths], "path string").repartition(len(paths))
         .mapInArrow(copy, "path string").write.format("noop").mode("overwrite").save())


def pull_messages(spark: SparkSession, path: str, messages: int, checkpoint: str, topic: str | None = None) -> DataFrame:
    """Envelopes of a file-backed topic, at most ``messages`` per micro-batch.
    Run it with a ``processingTime`` trigger (an ``availableNow`` run takes one batch)."""
    return _stream(spark, Messages, checkpoint, path=path if topic is None else f"{path}/topic={topic}", messages=messages, topic=topic)


def follow_tables(spark: SparkSession, tables: dict[str, tuple[str, str]], checkpoint: str | None = None,
                  prefix: str = "") -> DataFrame:
    """Envelopes (topic ``prefix`` + table, the mark as key and offset, the row
    as JSON) of new rows of the whitelisted tables ``{name: (path, column)}``."""
    return _stream(spark, Increments, checkpoint, tables=json.dumps(tables, sort_keys=True), prefix=prefix)
