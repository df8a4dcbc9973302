"""Phrase collocation mining by dynamic itemset counting.

The texts are dealt to ``SHARDS`` shards, which are scanned one after another,
again and again. The first cycle counts single words. After each scan, a
phrase whose count so far has reached ``LEAST`` becomes a part of longer ones:
a phrase of two (three) words is counted from the scan after both its words
(both its two-word parts) got there, for one full cycle, so that it has met
every shard once. Lengths interleave: pairs of the words that are frequent
from the start are counted while other words still are. The scans end when no
phrase is left whose cycle isn't full.

Scans count 64-bit hashes, and tell which are due by an activation map:
``CELLS`` cells, each the set of scans after which some phrase hashed to it
became frequent; a phrase's set is what its two cells share. Phrases that share
cells or a hash may be counted too early or too often, never too seldom. The
counts are sorted arrays, a row for each range of hashes that a task met; they
are summed up per range and stand in a table bucketed by it, so that no
activation shuffles them again. A last scan of all texts counts, as text, the
phrases whose hash was found frequent, and those alone: so the frequencies are
exact for all that reach LEAST. A map has ``PER`` cells a phrase, up to the fixed ``CELLS``; with
more frequent phrases than that more is counted than is due, and the results
stay the same.

Words are lower-cased (A-Z only), divided by blanks and tabs inside pieces,
which end at ``.,;:!?`` and line ends; phrases stay inside a piece. Counts are
per language. A candidate's score is that of its worst cut into two parts, in
exact integers (decimals of 38 digits). Candidates that mostly stand inside a
longer one are dropped.

Null and empty texts have no words; a null language is ``und``. Repeated rows
count each. Long texts are scanned whole. An empty table gives no rows. Only
doc_id (which deals rows to shards, and may be null), lang and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventloom.llm.common import chunks, input_bytes, per_chunk, shared_folder, small_batches, text_buffer
from eventloom.llm.words import LOWER, Words, mix

#: Times a phrase must occur, words of the longest, and rows reported per language.
LEAST, LONGEST, TOP = 10, 3, 2000
#: A candidate is dropped if a longer one has this percentage of its occurrences.
COVERED = 50
SHARDS = 2
#: Bits of a cell's number, and cells of an activation map: at most (two bytes each), and per phrase.
BITS = 23
CELLS, PER = 1 << BITS, 8
#: Bytes of the texts' files per task, counts that a task sums up before it gives
#: them out, and named phrases likewise.
TASK_BYTES, HELD, NAMED = 1 << 30, 1 << 20, 1 << 19
#: Rows that a worker is sent and gives, and bytes of text that it handles, at once (one
#: longer text is handled whole): two workers and a full heap share an executor's memory.
SENT_ROWS, GIVEN_ROWS, TEXT_BYTES = 1000, 1 << 16, 1 << 20
#: Ranges of hashes, at least (a range is what a step holds at once); as many as
#: shuffle partitions if those are more.
RANGES = 256

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
_WORD = ~_BREAK
_WORD[list(b" \t")] = False
_PART = np.ones(256, bool)
_PART[0x20] = False

NAMES = "lang string, len int, phrase string, n long"
_NAMES = pa.schema([("lang", pa.string()), ("len", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])
#: Sorted hashes of one length and range, and their counts, as arrays of 64-bit integers.
PACKED = "len int, part int, h binary, n binary"
_PACKED = pa.schema([("len", pa.int32()), ("part", pa.int32()), ("h", pa.binary()), ("n", pa.binary())])


def _lang_hashes(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs],
                    np.uint64)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + b)


class Map:
    """An activation map, kept as the cells that are not empty."""

    def __init__(self, cell: np.ndarray, acts: np.ndarray):
        size = 1 << max(6, int(len(cell) * PER // 2 - 1).bit_length())
        self.size = min(CELLS, size)
        self.cell, self.acts = cell.astype(np.int32) & (self.size - 1), acts.astype(np.uint16)

    def cells(self) -> np.ndarray:
        out = np.zeros(self.size, np.uint16)
        np.bitwise_or.at(out, self.cell, self.acts)
        return out


def _sets(cells: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The activation sets of hashes: what their two cells share."""
    low = np.uint64(len(cells) - 1)
    return cells[h & low] & cells[h >> np.uint64(64 - BITS) & low]


def _opened(maps: dict) -> Iterator[tuple[int, np.ndarray]]:
    return ((k, maps[k].cells()) for k in sorted(maps))


def _due(a: np.ndarray, b: np.ndarray, scan: int, shards: int) -> np.ndarray:
    """Whether a phrase of parts with these activation sets can be in its cycle."""
    return (a != 0) & (b != 0) & ((a | b) >> np.uint16(max(0, scan - shards + 1)) != 0)


class _Chunk:
    """Words of a run of texts: ``ids`` into ``names``, their language, and
    whether each is followed by a word of the same piece."""

    def __init__(self, part: pa.RecordBatch):
        col = lambda c: part.column(part.schema.get_field_index(c))
        data, off = text_buffer(col("text"))
        w = Words(data, off, _WORD)
        size = np.concatenate([[0], np.cumsum(w.ends - w.starts)])
        low = LOWER[data[_WORD[data]]]
        names = pa.LargeStringArray.from_buffers(len(w), pa.py_buffer(size.astype(np.int64)), pa.py_buffer(low))
        coded = names.dictionary_encode()
        self.ids = np.asarray(coded.indices).astype(np.int64)
        self.names = coded.dictionary
        langs = pc.fill_null(col("lang"), "und").dictionary_encode()
        self.langs = langs.dictionary
        doc = w.doc_of()
        self.lang = np.asarray(langs.indices).astype(np.int64)[doc]
        piece = np.cumsum(_BREAK[data])[w.starts] if len(w) else np.empty(0, np.int64)
        self.joined = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])
        own = Words(*text_buffer(self.names), np.ones(256, bool)).hashes
        self.hashes = mix(own[self.ids] ^ _lang_hashes(self.langs.to_pylist())[self.lang]) if len(w) else own

    def phrases(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Start words and hashes of all phrases of a length."""
        ok = np.ones(max(0, len(self.ids) - length + 1), bool)
        for j in range(length - 1):
            ok &= self.joined[j:j + len(ok)]
        at = np.flatnonzero(ok)
        h = self.hashes[at]
        for j in range(1, length):
            h = _pair(h, self.hashes[at + j])
        return at, h

    def rows(self, at: np.ndarray, length: int) -> pa.RecordBatch:
        """Counts, as text, of the phrases that start at the given words."""
        v, key = max(1, len(self.names)), self.ids[at] * len(self.langs) + self.lang[at]
        for j in range(1, length):
            key = np.unique(key, return_inverse=True)[1] * v + self.ids[at + j]
        _, first, times = np.unique(key, return_index=True, return_counts=True)
        at = at[first]
        parts = [self.names.take(pa.array(self.ids[at + j])) for j in range(length)]
        phrase = parts[0] if length == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
        return pa.RecordBatch.from_arrays(
            [self.langs.take(pa.array(self.lang[at])).cast(pa.string()), pa.array(np.full(len(at), length, np.int32)),
             phrase.cast(pa.string()), pa.array(times.astype(np.int64))], schema=_NAMES)


def summed(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and the sums of their counts."""
    h, n = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(h, kind="stable")
    h, n = h[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
    return h[first], np.add.reduceat(n, first) if len(first) else n


class _Sums:
    """Counts by hash of one length, summed over a task's chunks."""

    def __init__(self, length: int, ranges: int):
        self.length, self.ranges, self.held, self.size = length, ranges, ([], []), 0

    def add(self, h: np.ndarray) -> Iterator[pa.RecordBatch]:
        for to, x in zip(self.held, np.unique(h, return_counts=True)):
            to.append(x)
        self.size += len(self.held[0][-1])
        if self.size > HELD:
            yield from self.flush(HELD // 2)

    def flush(self, most: int = 0) -> Iterator[pa.RecordBatch]:
        """Sum up what is held, and give it out if that leaves more than ``most``."""
        if not self.size:
            return
        h, n = summed(*self.held)
        self.held, self.size = ([h], [n]), len(h)
        if len(h) <= most:
            return
        self.held, self.size = ([], []), 0
        part = _range_of(h, self.ranges)
        at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        rows = [(part[i], h[i:j].tobytes(), n[i:j].astype(np.int64).tobytes()) for i, j in zip(at, [*at[1:], len(h)])]
        for i in range(0, len(rows), 256):
            some = rows[i:i + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.length] * len(some), pa.int32()), pa.array([int(r[0]) for r in some], pa.int32()),
                 pa.array([r[1] for r in some], pa.binary()), pa.array([r[2] for r in some], pa.binary())], schema=_PACKED)


def _range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    """The range a hash falls in: ranges are equal parts of the 32 highest bits."""
    return ((h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _arrays(rows: pd.DataFrame) -> tuple[list[np.ndarray], list[np.ndarray]]:
    return [np.frombuffer(x, np.uint64) for x in rows["h"]], [np.frombuffer(x, np.int64) for x in rows["n"]]


def _summed_range(rows: pd.DataFrame) -> pd.DataFrame:
    h, n = summed(*_arrays(rows))
    return pd.DataFrame({"len": rows["len"].iloc[:1], "part": rows["part"].iloc[:1], "h": [h.tobytes()], "n": [n.tobytes()]})


#: Cells of a map that travel in one row.
BLOCK = 1 << 12
CELL_ROWS = "len int, block int, cell binary, acts binary"


def _cell_rows(length: int, cell: np.ndarray, acts: np.ndarray) -> pd.DataFrame:
    """Cells in order, with the union of their sets, a row a block."""
    order = np.argsort(cell, kind="stable")
    cell, acts = cell[order], acts[order]
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.empty(0, np.int64)
    cell, acts = cell[first], np.bitwise_or.reduceat(acts, first) if len(first) else acts
    block = cell // BLOCK
    at = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(cell) else np.empty(0, np.int64)
    to = [*at[1:], len(cell)]
    return pd.DataFrame({"len": np.full(len(at), length, np.int32), "block": block[at].astype(np.int32),
                         "cell": [cell[i:j].astype(np.int32).tobytes() for i, j in zip(at, to)],
                         "acts": [acts[i:j].astype(np.uint16).tobytes() for i, j in zip(at, to)]})


def _united(rows: pd.DataFrame) -> pd.DataFrame:
    return _cell_rows(int(rows["len"].iloc[0]), np.concatenate([np.frombuffer(x, np.int32) for x in rows["cell"]]),
                      np.concatenate([np.frombuffer(x, np.uint16) for x in rows["acts"]]))


def _activation(least: int):
    """The cells of a range's phrases that are frequent, and after which scan they became so."""
    def activate(rows: pd.DataFrame) -> pd.DataFrame:
        hashes, counts = _arrays(rows)
        h, _ = summed(hashes, counts)
        so_far, act = np.zeros(len(h), np.int64), np.zeros(len(h), np.uint16)
        for scan, some, n in sorted(zip(rows["scan"], hashes, counts), key=lambda x: x[0]):
            so_far[np.searchsorted(h, some)] += n
            act[(act == 0) & (so_far >= least)] = scan + 1
        h, act = h[act > 0], act[act > 0]
        cells = np.concatenate([h & np.uint64(CELLS - 1), h >> np.uint64(64 - BITS) & np.uint64(CELLS - 1)]).astype(np.int64)
        return _cell_rows(int(rows["len"].iloc[0]), cells, np.tile(np.left_shift(np.uint16(1), act), 2))
    return activate


def _scanner(scan: int, shards: int, maps: dict, ranges: int):
    """Counts, by hash, of the phrases that are due in a scan."""
    def run(batches):
        opened = list(_opened(maps))
        sums = {k: _Sums(k, ranges) for k in range(1, LONGEST + 1)}

        def count(part: pa.RecordBatch):
            c = _Chunk(part)
            if scan < shards:
                yield from sums[1].add(c.hashes)
            for k, cells in opened:
                # a phrase of k + 1 words has two parts of k words, one word apart
                at, h = c.phrases(k)
                sets = np.zeros(len(c.ids) + 1, np.uint16)
                sets[at] = _sets(cells, h)
                at, h = c.phrases(k + 1)
                yield from sums[k + 1].add(h[_due(sets[at], sets[at + 1], scan, shards)])
        yield from per_chunk(count, max_bytes=TEXT_BYTES)(batches)
        for s in sums.values():
            yield from s.flush()
    return run


def _merged(rows: list) -> pa.Table:
    """Equal phrases as one row each."""
    tables = [pa.Table.from_batches([x]) if isinstance(x, pa.RecordBatch) else x for x in rows]
    whole = pa.concat_tables(tables).group_by(["lang", "len", "phrase"], use_threads=False).aggregate([("n", "sum")])
    return whole.select(["lang", "len", "phrase", "n_sum"]).rename_columns(_NAMES.names).cast(_NAMES).combine_chunks()


def _namer(maps: dict):
    """Counts, as text, of the phrases whose hash was found frequent; and of all words per language (length 0)."""
    def count(part: pa.RecordBatch, opened: list):
        c = _Chunk(part)
        n = np.bincount(c.lang, minlength=len(c.langs))
        yield pa.RecordBatch.from_arrays([c.langs.cast(pa.string()), pa.array(np.zeros(len(n), np.int32)),
                                          pa.array([""] * len(n), pa.string()), pa.array(n.astype(np.int64))], schema=_NAMES)
        for k, cells in opened:
            at, h = c.phrases(k)
            yield c.rows(at[_sets(cells, h) != 0], k)

    def run(batches):
        opened = list(_opened(maps))
        held, size = [], 0
        for batch in batches:
            for part in chunks(batch, "text", TEXT_BYTES):
                for rows in count(part, opened):
                    held.append(rows)
                    size += len(rows)
                if size > NAMED:
                    held, size = [whole := _merged(held)], len(whole)
                    if size > NAMED // 2:
                        yield from whole.to_batches(GIVEN_ROWS)
                        held, size = [], 0
        if held:
            yield from _merged(held).to_batches(GIVEN_ROWS)
    return run


class Counter:
    """Frequencies of phrases by scans over shards of the texts."""

    def __init__(self, docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS):
        # activation sets have a bit per scan: 16 hold the cycles of three lengths
        if not 2 <= longest <= 3 or not 1 <= shards <= 5:
            raise ValueError("phrases of 2 or 3 words, 1 to 5 shards")
        self.spark, self.least, self.longest, self.shards = docs.sparkSession, least, longest, shards
        self.folder = shared_folder(self.spark, "phrases")
        self.table = "phrases_" + self.folder.rsplit("-", 1)[1]
        shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int")
        docs.select("lang", "text", "doc_id").withColumn("shard", shard).drop("doc_id") \
            .write.partitionBy("shard").parquet(f"{self.folder}/texts")
        self.texts = self.spark.read.schema("lang string, text string, shard int").parquet(f"{self.folder}/texts")
        # large tasks, as each gives a phrase that it meets often once
        self.tasks = max(2 * self.spark.sparkContext.defaultParallelism, input_bytes(self.texts) // TASK_BYTES)
        self.scans = 0
        self.last = {1: 0, 2: 0}  # the last scan after which a phrase of a length became frequent
        with small_batches(self.spark, SENT_ROWS):
            self._count()
        self.named = self.spark.read.schema("lang string, len int, phrase string, f long").parquet(f"{self.folder}/named")

    def _count(self) -> None:
        maps: dict = {}
        try:
            while self.scans < self.shards or any(a and self.scans < a + self.shards for a in self.last.values()):
                self._scan(maps)
                # words are counted after one cycle, pairs one cycle after the last word got frequent
                open_ = [k for k in range(1, self.longest) if self.scans <= self.shards + (self.last[1] if k > 1 else 0)]
                maps = {**maps, **self._activate(open_)}
            found = {**maps, **self._activate([self.longest])}
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        named = self.texts.select("lang", "text").coalesce(self.tasks).mapInArrow(_namer(found), NAMES)
        (named.groupBy("lang", "len", "phrase").agg(F.sum("n").alias("f"))
         .filter((F.col("len") == 0) | (F.col("f") >= self.least)).write.parquet(f"{self.folder}/named"))

    def _scan(self, maps: dict) -> None:
        texts = self.texts.filter(F.col("shard") == self.scans % self.shards).select("lang", "text")
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        ranges = max(buckets, RANGES)
        found = texts.coalesce(self.tasks).mapInArrow(_scanner(self.scans, self.shards, maps, ranges), PACKED)
        (found.groupBy("part", "len").applyInPandas(_summed_range, PACKED).withColumn("scan", F.lit(self.scans))
         .write.mode("append").partitionBy("len").bucketBy(buckets, "part").option("path", f"{self.folder}/counts")
         .saveAsTable(self.table))
        self.scans += 1

    def _activate(self, lengths: list[int]) -> dict:
        """The activation maps of these lengths: at most CELLS cells a length reach the driver."""
        if not lengths:
            return {}
        cells = (self.spark.table(self.table).filter(F.col("len").isin(lengths)).groupBy("part", "len")
                 .applyInPandas(_activation(self.least), CELL_ROWS)
                 .groupBy("len", "block").applyInPandas(_united, CELL_ROWS).toArrow().to_pandas())
        maps = {}
        for k, rows in cells.groupby("len"):
            cell = np.concatenate([np.frombuffer(x, np.int32) for x in rows["cell"]])
            acts = np.concatenate([np.frombuffer(x, np.uint16) for x in rows["acts"]])
            maps[int(k)] = Map(cell, acts)
            if k in self.last:
                self.last[int(k)] = int(np.bitwise_or.reduce(acts)).bit_length() - 1
        return maps

    def frequencies(self) -> DataFrame:
        """(lang, len, phrase, f): every phrase with f >= ``least``."""
        return self.named.filter("len > 0")

    def totals(self) -> DataFrame:
        """(lang, n): all word occurrences."""
        return self.named.filter("len = 0").select("lang", F.col("f").alias("n"))


def candidates(frequencies: DataFrame) -> DataFrame:
    """(lang, phrase, len, a, l, r, score): each phrase by its worst cut, without those that longer ones cover."""
    word = F.split("phrase", " ")
    cut = lambda k: F.struct(F.lit(k).alias("k"), F.concat_ws(" ", F.slice(word, 1, k)).alias("left"),
                             F.concat_ws(" ", F.expr(f"slice(split(phrase, ' '), {k + 1}, len - {k})")).alias("right"))
    long = frequencies.filter("len > 1").withColumnRenamed("f", "a")
    cuts = (long.withColumn("cut", F.explode(F.when(F.col("len") == 2, F.array(cut(1))).otherwise(F.array(cut(1), cut(2)))))
            .select("lang", "phrase", "len", "a", "cut.*"))
    part = lambda side, f: frequencies.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    cuts = (cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
            .withColumn("top", (wide("a") * wide("a")).cast("decimal(31,0)") * F.lit(1000000).cast("decimal(7,0)"))
            .withColumn("below", wide("l") * wide("r")).withColumn("score", F.expr("cast(top div below as long)")))
    worst = (cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "len")).alias("w"))
             .select("lang", "phrase", "w.*"))
    inner = (long.filter("len = 3").select("lang", F.col("a").alias("longer"), F.explode(F.array(
        F.concat_ws(" ", F.slice(word, 1, 2)), F.concat_ws(" ", F.slice(word, 2, 2)))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    return (worst.join(inner, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (100 * F.col("longer") < COVERED * F.col("a"))))


def report(docs: DataFrame, top: int = TOP) -> DataFrame:
    """The contract's columns: each language's ``top`` phrases."""
    counter = Counter(docs)
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = (candidates(counter.frequencies()).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))
    # one row per language
    return (best.join(counter.totals(), "lang")
            .select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score"))


REPORT_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words, (SELECT unnest([1, 2, 3]) AS k)),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
long AS (SELECT lang, k AS len, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT lang, len, phrase, a, c, array_to_string(w[1:c], ' ') AS lp, array_to_string(w[c + 1:], ' ') AS rp
  FROM long, (SELECT unnest([1, 2]) AS c) WHERE c < len),
scored AS (
  SELECT cuts.lang, cuts.len, cuts.phrase, a, c, x.f AS l, y.f AS r, (1000000 * a * a) // (x.f * y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lp JOIN f y ON y.lang = cuts.lang AND y.phrase = rp),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inside AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a AS longer
  FROM long WHERE len = 3),
covered AS (SELECT lang, phrase, max(longer) AS longer FROM inside GROUP BY ALL),
kept AS (
  SELECT worst.* FROM worst LEFT JOIN covered USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
