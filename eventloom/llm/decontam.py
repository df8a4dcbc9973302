"""Benchmark decontamination by winnowing.

A window is ten consecutive item words; an item with fewer is one window.
Winnowing keeps, for each window of ``LENGTH`` words, the smallest of its
``GRAM``-word hashes: equal windows have equal minima, so every shared span of
ten words or more meets in the join of test and training fingerprints. Joined
windows are confirmed word by word, and hits that touch are extended to
maximal spans.

Documents are scanned once. So that only promising windows leave the scan, the
test fingerprints are also folded into a bitmap of a fixed 2^22 bits; a window
whose bit is clear matches no item. The bitmap drops nothing that would join.

Each document also leaves one marker row with a join key of its own, so that
documents without a hit stay in the outer join.

Nulls and empty texts have no words and no hits. Items without words have no
windows. Repeated items count once by their id; items without an id hit like
others and count as one, but aren't in the list of ids. Repeated documents each
give a row. Long texts are scanned whole. Tables with other
columns are fine: only doc_id, item_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import RowIds, chunks, input_bytes, materialise, per_chunk, text_buffer, wrapped
from eventloom.llm.words import ALNUM, LOWER, Words, gram_hashes, mix, within

#: Words of a window, and of the grams whose minimum stands for it.
LENGTH, GRAM = 10, 6
#: Bits of the fingerprint bitmap (fixed, so its broadcast is 512 KB).
BITS = 1 << 22
#: Chance at which a short window's words meet in a document of mean length, from
#: which on the window condemns no document.
CHANCE = 0.01
#: The test side is broadcast when its files are smaller than this.
BROADCAST_BYTES = 2 << 20


def window_minima(hashes: np.ndarray) -> np.ndarray:
    """The smallest gram hash of the window that starts at each word."""
    grams = gram_hashes(hashes, GRAM)
    n = len(hashes) - LENGTH + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = grams[:n].copy()
    for j in range(1, LENGTH - GRAM + 1):
        np.minimum(out, grams[j:j + n], out=out)
    return out


def _window_texts(w: Words, at: np.ndarray, n: int) -> list[str]:
    low = LOWER[w.data].tobytes()
    starts, ends = w.starts, w.ends
    return [b" ".join([low[starts[i]:ends[i]] for i in range(a, a + n)]).decode() for a in at.tolist()]


_WINDOWS = pa.schema([("item_id", pa.string()), ("n", pa.int32()), ("fp", pa.int64()), ("window", pa.string())])


def _item_windows(part: pa.RecordBatch) -> pa.RecordBatch:
    ids = part.column(part.schema.get_field_index("item_id")).to_pylist()
    w = Words(*text_buffer(part.column(part.schema.get_field_index("text"))), ALNUM)
    rows = ([], [], [], [])
    minima = window_minima(w.hashes)
    for d, (a, b) in enumerate(zip(w.bounds, w.bounds[1:])):
        if a == b:
            continue
        n = min(LENGTH, int(b - a))
        at = np.arange(a, b - n + 1)
        fp = minima[at] if n == LENGTH else gram_hashes(w.hashes[a:b], n)
        rows[0].extend([ids[d]] * len(at))
        rows[1].extend([n] * len(at))
        rows[2].extend(fp.view(np.int64).tolist())
        rows[3].extend(_window_texts(w, at, n))
    return pa.RecordBatch.from_arrays([pa.array(r, f.type) for r, f in zip(rows, _WINDOWS)], schema=_WINDOWS)


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, n, fp, window): the distinct windows of each item."""
    return (items.select(F.col("item_id").cast("string"), "text")
            .mapInArrow(per_chunk(_item_windows), "item_id string, n int, fp long, window string").distinct())


def fingerprint_bitmap(windows: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The bitmap of all fingerprints, and the window lengths that occur.

    At most BITS/64 words reach the driver, however many items there are."""
    bit = F.col("fp").bitwiseAND(F.lit(BITS - 1))
    words = (windows.select(F.shiftright(bit, 6).alias("w"), F.expr(f"shiftleft(1L, cast((fp & {BITS - 1}) & 63 as int))").alias("b"),
                            "n")
             .groupBy("w").agg(F.bit_or("b").alias("b"), F.expr("bit_or(shiftleft(1, n))").alias("lengths")))
    bits = np.zeros(BITS // 64, np.int64)
    lengths = 0
    for r in words.toLocalIterator():
        bits[r["w"]] = r["b"]
        lengths |= r["lengths"]
    return bits.view(np.uint64), [n for n in range(1, LENGTH) if lengths >> n & 1]


_HITS = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                   ("start", pa.int64()), ("n", pa.int32()), ("fp", pa.int64()), ("window", pa.string())])


def _marker_rows(rid: np.ndarray, ids: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    n, null = len(rid), pa.nulls
    own = mix(rid.view(np.uint64) + np.uint64(1)).view(np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(rid), ids.cast(pa.int64()), pa.array(counts.astype(np.int64)), null(n, pa.int64()),
        pa.array(np.zeros(n, np.int32)), pa.array(own), null(n, pa.string())], schema=_HITS)


def _window_rows(w: Words, rid: np.ndarray, at: np.ndarray, n: int, fp: np.ndarray) -> pa.RecordBatch:
    doc = np.searchsorted(w.bounds, at, "right") - 1
    null = pa.nulls
    return pa.RecordBatch.from_arrays([
        pa.array(rid[doc]), null(len(at), pa.int64()), null(len(at), pa.int64()), pa.array(at - w.bounds[doc]),
        pa.array(np.full(len(at), n, np.int32)), pa.array(fp.view(np.int64)),
        pa.array(_window_texts(w, at, n), pa.string())], schema=_HITS)


def promising(fp: np.ndarray, bits: np.ndarray) -> np.ndarray:
    low = fp & np.uint64(BITS - 1)
    return (bits[low >> np.uint64(6)] >> (low & np.uint64(63)) & np.uint64(1)).astype(bool)


def _scanner(shared):
    def run(batches):
        rows = RowIds()
        bits, lengths = shared.value
        for batch in batches:
            for part in chunks(batch, "text"):
                rid = rows.take(len(part))
                w = Words(*text_buffer(part.column(part.schema.get_field_index("text"))), ALNUM)
                yield _marker_rows(rid, part.column(part.schema.get_field_index("doc_id")), w.counts)
                for n in [LENGTH, *lengths]:
                    fp = window_minima(w.hashes) if n == LENGTH else gram_hashes(w.hashes, n)
                    if len(fp):
                        at = np.flatnonzero(promising(fp, bits) & within(w.bounds, n, len(fp)))
                        for i in range(0, len(at), 20_000):
                            some = at[i:i + 20_000]
                            yield _window_rows(w, rid, some, n, fp[some])
    return run


def covered(spans: Column) -> Column:
    """Words inside the union of (start, n) spans: hits that touch are extended."""
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("words"))
    def step(acc, s):
        end = F.greatest(acc["end"], s["start"] + s["n"])
        return F.struct(end.alias("end"), (acc["words"] + F.greatest(
            F.lit(0).cast("long"), end - F.greatest(acc["end"], s["start"]))).alias("words"))
    return F.aggregate(F.sort_array(spans), zero, step, lambda acc: acc["words"])


def scan(docs: DataFrame, items: DataFrame, windows: DataFrame | None = None) -> DataFrame:
    """Per document: doc_id, n_words, and the confirmed ``spans`` (array of start,
    n), ``items`` (sorted array of item ids) and ``nameless`` (1 if an item
    without an id is among them). ``windows``: those of the items
    that count, if not all."""
    spark = docs.sparkSession
    # Both uses of the windows recompute them: the test side is small next to the documents.
    windows = item_windows(items) if windows is None else windows
    shared = spark.sparkContext.broadcast(fingerprint_bitmap(windows))
    fields = "rid long, doc_id long, n_words long, start long, n int, fp long, window string"
    hits = docs.select("doc_id", "text").mapInArrow(_scanner(shared), fields)
    test = windows.select("item_id", "n", "fp", "window", F.lit(True).alias("hit"))
    if input_bytes(items) <= BROADCAST_BYTES:
        test = F.broadcast(test)
    met = hits.join(test, ["n", "fp", "window"], "left").filter("n = 0 or hit")
    return met.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.collect_set(F.when(F.col("n") > 0, F.struct("start", "n"))).alias("spans"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
        F.coalesce(F.max(F.when(F.col("hit") & F.col("item_id").isNull(), 1)), F.lit(0)).alias("nameless"))


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The contract's counts and digest, from the operator's spans and items."""
    return scan(docs, items).select(
        "doc_id", "n_words", covered(F.col("spans")).alias("n_hit"),
        (F.size("items") + F.col("nameless")).cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def report_sql(length: int = LENGTH) -> str:
    """The same result in DuckDB SQL: all windows of items and documents joined as texts."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
b AS (SELECT item_id, {words} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), {length}) AS n,
       array_to_string(w[i:i + least(len(w), {length}) - 1], ' ') AS win
       FROM b, unnest(range(1, greatest(len(w) - {length} + 2, 2))) AS r(i) WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM d, lens, unnest(range(1, len(w) - n + 2)) AS r(i)),
hit AS (SELECT doc_id, item_id, i, bw.n FROM dw JOIN bw ON bw.win = dw.win AND bw.n = dw.n),
pos AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM hit),
        unnest(range(0, n)) AS r(j) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON pos.doc_id IS NOT DISTINCT FROM d.doc_id
LEFT JOIN its ON its.doc_id IS NOT DISTINCT FROM d.doc_id"""


def _window_words(part: pa.RecordBatch) -> pa.RecordBatch:
    """Each window with the hash of each of its words."""
    text = part.column(part.schema.get_field_index("window"))
    w = Words(*text_buffer(text), ALNUM)
    return pa.RecordBatch.from_arrays(
        [text.take(pa.array(w.doc_of())), pa.array(w.hashes.view(np.int64))], names=["window", "h"])


def by_chance(docs: DataFrame, short: DataFrame) -> DataFrame:
    """The windows of ``short`` that a document of mean length would hold with a
    chance of ``CHANCE`` or more if words were dealt out at random: mean words
    times the product of the words' shares in all documents. Neither depends on
    the number of documents, so copies of a corpus excuse the same windows."""
    of = short.select("window").distinct().mapInArrow(per_chunk(_window_words, "window"), "window string, h long")
    shared = docs.sparkSession.sparkContext.broadcast(
        fingerprint_bitmap(of.select(F.col("h").alias("fp"), F.lit(1).alias("n")))[0])

    def count(part: pa.RecordBatch) -> pa.RecordBatch:
        """Uses of the words whose bit is set; the number of all words under null."""
        h = Words(*text_buffer(part.column(0)), ALNUM).hashes
        some, uses = np.unique(h[promising(h, shared.value)], return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([None, *some.view(np.int64).tolist()], pa.int64()), pa.array([len(h), *uses.tolist()], pa.int64()),
             pa.array([len(part), *[0] * len(some)], pa.int64())], names=["h", "uses", "docs"])

    counts = materialise(docs.select("text").mapInArrow(per_chunk(count), "h long, uses long, docs long")
                         .groupBy("h").agg(F.sum("uses").alias("uses"), F.sum("docs").alias("docs")), "word-uses")
    total, rows = counts.filter("h is null").agg(F.sum("uses"), F.sum("docs")).first()
    total, rows = max(float(total or 0), 1.0), max(float(rows or 0), 1.0)
    share = F.coalesce(F.log(F.col("uses") / F.lit(total)), F.lit(-1e9))
    return (of.join(counts, "h", "left").groupBy("window").agg(F.sum(share).alias("share"))
            .filter(F.col("share") + float(np.log(total / rows)) >= float(np.log(CHANCE))).select("window"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that hold no window of an item; the same columns.

    An item shorter than a window condemns a document like any other, unless
    its words would meet by chance in a document (``by_chance``), as a single
    word always does. Rows are judged by their id and text (a 64-bit hash of
    both), so a clean text keeps its row though it shares its id with another."""
    rows = wrapped(docs).withColumn("key", F.xxhash64("doc_id", "text"))
    windows = item_windows(items)
    short = windows.filter(F.col("n") < LENGTH)
    if not short.isEmpty():
        excused = by_chance(docs, short)
        windows = materialise(windows.join(excused, (windows["window"] == excused["window"]) & (F.col("n") < LENGTH),
                                           "left_anti"), "decontam-windows")
    found = scan(rows.select(F.col("key").alias("doc_id"), "text"), items, windows)
    bad = found.filter(F.size("spans") > 0).select(F.col("doc_id").alias("key")).distinct()
    return rows.select("row", "key").join(bad, "key", "left_anti").select("row.*")
