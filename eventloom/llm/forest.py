"""Approximate nearest neighbours by inner product: a hash-prefix forest.

Each tree hashes a vector to a string of 64 bits, the signs of its products
with random directions, and is the sorted array of these strings. A query
descends in every tree to the entries that share its longest prefix, then all
trees ascend together, one prefix length at a time, until the different rows
under the prefixes are ``REACH`` of all rows (and twice the neighbours wanted
at least). Those rows are scored exactly, in double precision. A segment of at
most ``SMALL`` rows is scored whole: that costs no more than hashing a query.

Inner product becomes angle by one more coordinate, which pads every vector to
the largest length in the table.

The index is cut, per vector length, into segments of ``SEGMENT`` distinct
vectors, so that each tree's arrays stay small; every segment holds a forest over its own rows, and
the stated query set (rows whose id is divisible by ``EVERY``) is put to every
segment in groups of ``GROUP``. Per query and segment at most TOP + 1 rows
leave a task. All rows are indexed; directions are fixed by a seed.

Equal vectors are indexed once, with their TOP + 1 smallest ids: no query can
report more of them. Vectors that are null, zero, or hold null or non-finite
components take no part, nor do rows without an id; of rows that repeat an id
the smallest vector counts. Queries meet vectors of their own length only.
Ties go to the smaller id, also where a segment's best are cut. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventloom.llm.common import materialise

TOP, EVERY = 20, 20
TREES, BITS, REACH = 64, 64, 0.9
SEGMENT, GROUP = 8192, 1024
SEED = 20
#: Rows of a segment that is scored whole; a query's strings take as many products.
SMALL = TREES * BITS
#: Prefix lengths that the ascent visits.
DEPTHS = (64, 48, 32, 24, 20, *range(18, -1, -1))


def directions(d: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((d + 1, TREES * BITS)).astype(np.float32)


def strings(x: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """One 64-bit string per vector and tree, first bit highest."""
    out = np.empty((len(x), TREES), np.uint64)
    for at in range(0, len(x), 512):
        signs = (x[at:at + 512].astype(np.float32) @ planes) > 0
        packed = np.packbits(signs.reshape(len(signs), TREES, BITS), axis=2)
        out[at:at + 512] = packed.view(">u8")[:, :, 0]
    return out


class Forest:
    """Sorted hash strings of one segment, per tree."""

    def __init__(self, x: np.ndarray, longest: float, ids: np.ndarray | None = None):
        """``ids``: what decides between rows that score alike (else their place)."""
        self.x, self.order = x, None
        self.ids = np.arange(len(x)) if ids is None else ids
        if len(x) <= SMALL:
            return
        self.planes = directions(x.shape[1])
        pad = np.sqrt(np.maximum(longest ** 2 - (x * x).sum(1), 0.0))
        codes = strings(np.concatenate([x, pad[:, None]], 1) / longest, self.planes)
        self.order = np.argsort(codes, axis=0, kind="stable").astype(np.int32)
        self.codes = np.take_along_axis(codes, self.order.astype(np.int64), 0)

    def ranges(self, q: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Per query and tree, the entries that share the first ``depth`` bits."""
        rest = np.uint64((1 << (BITS - depth)) - 1)
        low, high = q & ~rest, q | rest
        lo = np.stack([np.searchsorted(self.codes[:, t], low[:, t], "left") for t in range(TREES)], 1)
        hi = np.stack([np.searchsorted(self.codes[:, t], high[:, t], "right") for t in range(TREES)], 1)
        return lo, hi

    def candidates(self, queries: np.ndarray, k: int):
        """The rows to score of each query, in turn."""
        n, m = len(self.x), len(queries)
        if self.order is None:
            yield from (np.arange(n) for _ in range(m))
            return
        unit = queries / np.sqrt((queries * queries).sum(1))[:, None]
        q = strings(np.concatenate([unit, np.zeros((m, 1))], 1), self.planes)
        order = [np.ascontiguousarray(self.order[:, t]) for t in range(TREES)]
        need = min(n, max(REACH * n, 2 * k))
        found: list[np.ndarray | None] = [None] * m
        waiting = np.arange(m)
        for depth in DEPTHS:
            a, b = self.ranges(q[waiting], depth)
            # the trees repeat rows, so only as many entries can be as many rows
            for at in np.flatnonzero((b - a).sum(1) >= need).tolist():
                seen = np.zeros(n, bool)
                for t, lo, hi in zip(range(TREES), a[at].tolist(), b[at].tolist()):
                    seen[order[t][lo:hi]] = True
                if np.count_nonzero(seen) >= need:
                    found[waiting[at]] = np.flatnonzero(seen)
            waiting = waiting[[found[i] is None for i in waiting]]
            if not len(waiting):
                break
        yield from found

    def search(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of the k best candidates of each query."""
        out = ([], [], [])
        length = lambda x: np.sqrt((x * x).sum(1))
        slack = 4 * queries.shape[1] * np.finfo(float).eps * length(self.x).max() * length(queries)
        for i, rows in enumerate(self.candidates(queries, k)):
            near = self.x[rows] @ queries[i]
            if len(rows) > k:  # all that tie with the last, as products in blocks round differently
                rows = rows[near >= np.partition(near, -k)[-k] - slack[i]]
            # summed in one fixed order, so that equal vectors score alike everywhere
            near = (self.x[rows] * queries[i]).sum(1)
            best = np.lexsort((self.ids[rows], -near))[:k]
            out[0].append(np.full(len(best), i))
            out[1].append(rows[best])
            out[2].append(near[best])
        return tuple(np.concatenate(o) if o else np.empty(0) for o in out)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, k1, k2, d): one valid vector per id, with a 128-bit key of its value."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = F.col("v")
    return (vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0))
            .groupBy("vec_id").agg(F.min("v").alias("v"))
            .withColumns({"k1": F.xxhash64(v), "k2": F.xxhash64(F.lit(1), v), "d": F.size(v)}))


def _blocks(vectors: DataFrame, size: int, what: str) -> tuple[DataFrame, DataFrame]:
    """One row per block of about ``size`` vectors of one length, however the
    rows are partitioned: keys, components and smallest ids side by side. And the number of
    blocks of each length (few rows: so many lengths take the square in components)."""
    blocks = vectors.groupBy("d").agg(F.ceil(F.count("*") / size).alias(f"{what}s"))
    cut = (vectors.join(F.broadcast(blocks), "d")
           .withColumn(what, F.pmod(F.xxhash64("k1"), F.col(f"{what}s")).cast("int"))
           .groupBy(what, "d").agg(F.collect_list(F.struct("k1", "k2", "v", "id")).alias("x"))
           .select(what, "d", *[F.col(f"x.{c}").alias(f"{what}_{c}") for c in ("k1", "k2", "v", "id")]))
    return cut, blocks


def _cell(batch: pa.RecordBatch, i: int, name: str) -> np.ndarray:
    return np.asarray(batch.column(batch.schema.get_field_index(name))[i].values)


def _matrix(batch: pa.RecordBatch, i: int, name: str, d: int) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(name))[i].values
    return np.asarray(values.flatten(), np.float64).reshape(-1, d)


def neighbours(vectors: DataFrame, top: int = TOP, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest of every query found."""
    rows = materialise(usable(vectors), "vectors")
    longest = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()[0]
    longest = float(longest or 1.0) ** 0.5
    by = W.partitionBy("k1", "k2").orderBy("vec_id")
    distinct = materialise(
        rows.withColumn("nth", F.row_number().over(by)).filter(F.col("nth") <= top + 1)
        .groupBy("k1", "k2").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.first("v").alias("v"),
                                 F.first("d").alias("d")), "distinct-vectors")
    asked = rows.filter(F.col("vec_id") % every == 0)
    queries = asked.groupBy("k1", "k2").agg(F.first("v").alias("v"), F.first("d").alias("d"), F.min("vec_id").alias("id"))

    segments, _ = _blocks(distinct.select("k1", "k2", "v", "d", F.col("ids")[0].alias("id")), SEGMENT, "segment")
    groups, slots = _blocks(queries, GROUP, "slot")
    # the query set against all rows, in blocks: each segment goes to every slot of its length
    every_slot = F.explode(F.sequence(F.lit(0), (F.col("slots") - 1).cast("int")))
    met = (segments.join(F.broadcast(slots), "d").withColumn("slot", every_slot).drop("slots")
           .join(groups, ["slot", "d"]).repartition(F.col("segment"), F.col("slot"), F.col("d")))

    def search(batches):
        for batch in batches:
            for i in range(len(batch)):
                d = batch.column(batch.schema.get_field_index("d"))[i].as_py()
                s1, s2, q1, q2 = (_cell(batch, i, c) for c in ("segment_k1", "segment_k2", "slot_k1", "slot_k2"))
                index = Forest(_matrix(batch, i, "segment_v", d), longest, _cell(batch, i, "segment_id"))
                q, s, score = index.search(_matrix(batch, i, "slot_v", d), top + 1)
                q, s = q.astype(np.int64), s.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q1[q]), pa.array(q2[q]), pa.array(s1[s]), pa.array(s2[s]), pa.array(score.astype(float))],
                    names=["q1", "q2", "k1", "k2", "score"])

    found = met.drop("slot", "segment").mapInArrow(search, "q1 long, q2 long, k1 long, k2 long, score double")
    ids = distinct.select("k1", "k2", "ids")
    found = found.join(ids, ["k1", "k2"]).withColumn("first", F.col("ids")[0])
    best = W.partitionBy("q1", "q2").orderBy(F.desc("score"), "first")
    best = (found.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= top + 1)
            .select("q1", "q2", "score", "ids"))
    names = asked.select(F.col("vec_id").alias("query_id"), F.col("k1").alias("q1"), F.col("k2").alias("q2"))
    pairs = (names.join(best, ["q1", "q2"])
             .select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id != query_id"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))
