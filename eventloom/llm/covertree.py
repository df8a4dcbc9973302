"""Hard-negative mining by inner product: cover trees over norm-augmented candidates.

Every candidate gets one more coordinate, which gives all vectors of a segment
the same length M; a query's is zero. So inner products stay what they are,
and become angles: a node whose descendants lie within the angle R of its
centre can't hold a score above ``|q| M cos(angle(q, centre) - R)`` or below
``|q| M cos(angle(q, centre) + R)``.

A cover tree holds the nested nets of one segment of ``SEGMENT`` rows. Its
points are put in farthest-first order, so the points further than
``r0 / BASE**l`` from all before them are the net of level l: they stand that
far apart and cover all others as closely. A point's parent is the nearest one
in the net above. Every node keeps, for each level with children, the largest
angle to a descendant from there on.

A search is best-first: it opens the ``BATCH`` nodes with the highest upper
bounds, scores their children exactly, in integers, and drops nodes that lie
outside all windows, or below the k-th best that a window already has. Nothing
that belongs to the result is dropped, so results equal brute force; how much
is skipped depends on how the vectors cluster.

Two passes over the same trees: an anchor's ``POSITIVES`` best rows of its
label, then, for each, the best ``NEGATIVES`` rows of other labels between
``LOW`` and ``HIGH`` percent of the positive's score. Rows are dealt to
segments by a hash, whatever their label; anchors meet every segment in groups
of ``GROUP``, and a tree is built once and read once per ``SLOTS`` groups. Per
anchor and segment only the best few leave a task.

Rows with a null id, label or vector, or with a null or non-finite component
take no part. Of rows that repeat an id the one with the smallest label, then
vector, counts. Vectors meet those of their own length only (the empty one
scores 0). Ties go to the smaller id. An anchor without positives gives no
rows, nor does an empty table; other columns are not read. A score that passes
64 bits is an error.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventloom.llm.common import materialise

EVERY, POSITIVES, NEGATIVES, LOW, HIGH = 50, 5, 3, 50, 95
SEGMENT, GROUP, SLOTS = 4096, 256, 64
BASE, LEVELS, BATCH = 1.3, 36, 256
#: Shuffle partitions of a pass, at most; a tree and its groups are never split.
PARTITIONS = 10_000


def _exact(x: np.ndarray, other: float) -> np.ndarray:
    """Integers as doubles where all sums of products with ``other`` at most are exact, else as Python integers."""
    top = float(np.abs(x.astype(float)).max(initial=0.0))
    return x.astype(np.float64) if top * max(top, other) * x.shape[1] < 2.0 ** 52 else x.astype(object)


class CoverTree:
    """Fields: rows in level order (``x``, ``ids``, ``labels``), ``first``: a
    row's first node or -1; nodes: ``row``, ``start:end`` of the children,
    ``next``: the row's node further down or -1, ``cos``: of the largest angle
    to a descendant from this node on."""

    FIELDS = ("x", "ids", "labels", "first", "row", "start", "end", "next", "cos")

    def __init__(self, **fields: np.ndarray):
        for name in self.FIELDS:
            setattr(self, name, fields[name])
        self.top = float(np.abs(self.x.astype(float)).max(initial=0.0))
        self.vectors = _exact(self.x, 0.0)
        self.length = np.sqrt((self.x.astype(float) ** 2).sum(1).max(initial=0.0))
        self.sin = np.sqrt(np.maximum(0.0, 1 - self.cos ** 2))

    @classmethod
    def build(cls, x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> CoverTree:
        n = len(x)
        real = x.astype(float)
        square = (real ** 2).sum(1)
        scale = np.sqrt(square.max(initial=0.0)) or 1.0
        y = np.concatenate([real, np.sqrt(np.maximum(0.0, square.max(initial=0.0) - square))[:, None]], 1) / scale
        order, level = cls._nets(y)
        y = y[order]
        parent = np.zeros(n, np.int64)
        place = np.arange(n)  # from farthest-first to final order
        bounds = np.searchsorted(level, np.arange(1, LEVELS + 2))
        for a, b in zip(bounds, bounds[1:]):
            for at in range(a, b, 512):
                to = min(at + 512, b)
                parent[at:to] = place[(y[at:to] @ y[:a].T).argmax(1)]
            by = a + np.argsort(parent[a:b], kind="stable")
            place[by] = np.arange(a, b)
            parent[a:b] = parent[by]
        final = np.argsort(place)
        y, order = y[final], order[final]
        # a node per parent and level: its children stand side by side
        edge = np.flatnonzero(np.concatenate([[True], (parent[2:] != parent[1:-1]) | (level[2:] != level[1:-1])])) + 1 \
            if n > 1 else np.empty(0, np.int64)
        row, start, end = parent[edge], edge, np.append(edge[1:], n)[:len(edge)]
        node_of = np.searchsorted(edge, np.arange(n), "right") - 1
        cos = np.ones(len(edge))
        child = np.arange(1, n)
        below = child.copy()
        while len(child):  # each row tells all nodes above it how far off it lies
            up = parent[child]
            np.minimum.at(cos, node_of[child], (y[below] * y[up]).sum(1))
            child, below = up[up > 0], below[up > 0]
        first, further = np.full(n, -1), np.full(len(edge), -1)
        for j in range(len(edge) - 1, -1, -1):
            further[j] = first[row[j]]
            if further[j] >= 0:
                cos[j] = min(cos[j], cos[further[j]])
            first[row[j]] = j
        return cls(x=x[order], ids=ids[order], labels=labels[order], first=first, row=row, start=start, end=end,
                   next=further, cos=np.maximum(-1.0, cos - 1e-12))

    @staticmethod
    def _nets(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Farthest-first order, and the level at which each row enters."""
        n = len(y)
        order, far = np.arange(n), np.zeros(n)
        near = np.full(n, -np.inf)  # the largest product with a row taken
        p = int((y @ y.mean(0)).argmax()) if n else 0
        left = np.ones(n, bool)
        for k in range(n):
            order[k], left[p] = p, False
            np.maximum(near, y @ y[p], out=near)
            near[p] = np.inf
            p = int(near.argmin())
            if k + 1 < n:
                far[k + 1] = np.sqrt(max(0.0, 2 - 2 * near[p]))
                if far[k + 1] <= far[1] * BASE ** -LEVELS:
                    order[k + 1:] = np.flatnonzero(left)
                    break
        if n < 2 or far[1] == 0:
            level = np.ones(n, np.int64)
        else:
            with np.errstate(divide="ignore"):
                level = np.minimum(LEVELS, np.floor(np.log(far[1] / far) / np.log(BASE)) + 1).astype(np.int64)
        level[:1] = 0
        return order, level

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f: _small(getattr(self, f)) for f in self.FIELDS})
        return out.getvalue()

    def search(self, q: np.ndarray, own: int, label: int, low: list, high: list, k: int, same: bool) -> tuple[list, int]:
        """Per window ``low <= score <= high`` its best k (score, id), and how many rows were scored."""
        exact = self.top * float(np.abs(q.astype(float)).max(initial=0.0)) * max(1, len(q)) < 2.0 ** 52
        x, q = (self.vectors, q.astype(np.float64)) if exact and self.vectors.dtype != object \
            else (self.x.astype(object), q.astype(object))
        reach = float(np.sqrt((q.astype(float) ** 2).sum())) * self.length or 1.0
        floors, found, scored = list(low), [[] for _ in low], 0

        def verify(at: np.ndarray) -> np.ndarray:
            s = x[at] @ q
            alike = self.labels[at] == label
            fits = alike & (self.ids[at] != own) if same else ~alike
            for w, top in enumerate(high):
                hits = np.flatnonzero(fits & (s >= floors[w]) & (s <= top))
                if len(hits):
                    best = sorted(found[w] + [(-int(a), int(b)) for a, b in zip(s[hits], self.ids[at[hits]])])[:k] \
                        if len(hits) <= 4 * k else self._best(found[w], s[hits], self.ids[at[hits]], k)
                    found[w] = best
                    if len(best) == k:
                        floors[w] = max(floors[w], -best[-1][0])
            return s

        def bounds(node: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            c = np.clip(s.astype(float) / reach, -1.0, 1.0)
            a, b = c * self.cos[node], np.sqrt(1 - c * c) * self.sin[node]
            up = np.where(c >= self.cos[node], 1.0, a + b)
            down = np.where(c <= -self.cos[node], -1.0, a - b)
            return (up + 1e-6) * reach, (down - 1e-6) * reach

        def inside(up: np.ndarray, down: np.ndarray) -> np.ndarray:
            keep = np.zeros(len(up), bool)
            for w, top in enumerate(high):
                keep |= (up >= float(floors[w])) & (down <= float(top))
            return keep

        s = verify(np.zeros(1, np.int64))
        scored = 1
        node, at = self.first[:1], s
        node, at = node[node >= 0], at[node >= 0]
        up, down = bounds(node, at)
        while len(node):
            keep = inside(up, down)
            node, at, up, down = node[keep], at[keep], up[keep], down[keep]
            if not len(node):
                break
            if len(node) > BATCH:
                cut = np.argpartition(-up, BATCH)
                now, later = cut[:BATCH], cut[BATCH:]
            else:
                now, later = np.arange(len(node)), np.empty(0, np.int64)
            opened, centre = node[now], at[now]
            count = self.end[opened] - self.start[opened]
            rows = np.arange(count.sum()) + np.repeat(self.start[opened] - (np.cumsum(count) - count), count)
            s = verify(rows)
            scored += len(rows)
            deeper, on = self.first[rows], self.next[opened]
            new = np.concatenate([deeper[deeper >= 0], on[on >= 0]])
            new_at = np.concatenate([s[deeper >= 0], centre[on >= 0]])
            u, d = bounds(new, new_at)
            node, at = np.concatenate([node[later], new]), np.concatenate([at[later], new_at])
            up, down = np.concatenate([up[later], u]), np.concatenate([down[later], d])
        return [[(-s, i) for s, i in f] for f in found], scored

    @staticmethod
    def _best(found: list, s: np.ndarray, ids: np.ndarray, k: int) -> list:
        order = np.lexsort((ids, -s))[:k] if s.dtype != object else sorted(range(len(s)), key=lambda i: (-s[i], ids[i]))[:k]
        return sorted(found + [(-int(s[i]), int(ids[i])) for i in order])[:k]


def _small(x: np.ndarray) -> np.ndarray:
    """Integers in four bytes where they fit."""
    fits = x.dtype == np.int64 and (not x.size or (x.min() >= -2 ** 31 and x.max() < 2 ** 31))
    return x.astype(np.int32) if fits else x


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v, d): one row per id, labels shifted and components as integers."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    label = F.col("label").cast("long")
    v = F.col("v")
    return (vectors.select(F.col("vec_id").cast("long"), label.alias("label"), F.col("embedding").cast("array<double>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & ~F.exists(v, bad))
            .select("vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
                    F.transform("v", lambda x: F.floor(x * 256).cast("long")).alias("v"))
            .groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
            .withColumn("d", F.size("v")))


def _matrix(cell: pa.ListScalar, d: int) -> np.ndarray:
    x = np.asarray(cell.values.flatten(), np.int64).reshape(len(cell.values), d)
    if len(x) and d and (x.max() >= 2 ** 62 or x.min() <= -2 ** 62):
        raise OverflowError("a component passes 64 bits")
    return x


def _cells(batch: pa.RecordBatch, *names: str):
    for i in range(len(batch)):
        yield [batch.column(batch.schema.get_field_index(n))[i] for n in names]


PACK = "d int, block int, pack binary"


def _packs(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                       pa.array([r[2] for r in rows], pa.binary())], names=["d", "block", "pack"])


def _build(batches):
    for batch in batches:
        for d, block, ids, labels, v in _cells(batch, "d", "block", "vec_id", "label", "v"):
            tree = CoverTree.build(_matrix(v, d.as_py()), np.asarray(ids.values), np.asarray(labels.values))
            yield _packs([(d.as_py(), block.as_py(), tree.pack())])


def _group(batches):
    for batch in batches:
        extra = [n for n in ("positive", "score") if n in batch.schema.names]
        for d, block, ids, labels, v, *more in _cells(batch, "d", "block", "vec_id", "label", "v", *extra):
            out = io.BytesIO()
            fields = {"ids": np.asarray(ids.values), "labels": np.asarray(labels.values), "v": _small(_matrix(v, d.as_py()))}
            for name, cell in zip(extra, more):
                fields[name] = np.asarray(cell.values.flatten())
                fields["many"] = np.diff(np.asarray(cell.values.offsets))
            np.savez(out, **fields)
            yield _packs([(d.as_py(), block.as_py(), out.getvalue())])


def _blocks(rows: DataFrame, sizes: DataFrame, blocks: str) -> DataFrame:
    """One row per block of rows of one length, dealt by a hash of the id."""
    cols = [c for c in rows.columns if c != "d"]
    return (rows.join(F.broadcast(sizes.select("d", F.col(blocks).alias("_n"))), "d")
            .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("_n")).cast("int"))
            .groupBy("d", "block").agg(F.collect_list(F.struct(*cols)).alias("x"))
            .select("d", "block", *[F.col(f"x.{c}").alias(c) for c in cols]))


class Index:
    """Cover trees over a table of vectors, and the anchors that search them."""

    def __init__(self, vectors: DataFrame, every: int = EVERY):
        self.rows = materialise(usable(vectors), "hard-negatives")
        self.anchors = self.rows.filter(F.col("vec_id") % every == 0)
        # one row per vector length that has anchors: so many lengths take the square in components
        anchor = (F.col("vec_id") % every == 0).cast("long")
        self.sizes = materialise(
            self.rows.groupBy("d").agg(F.count("*").alias("n"), F.sum(anchor).alias("a")).filter("a > 0")
            .select("d", F.ceil(F.col("n") / SEGMENT).alias("segments"), F.ceil(F.col("a") / GROUP).alias("slots"))
            .withColumn("parts", F.ceil(F.col("slots") / SLOTS)), "hard-negative-sizes")
        self.trees = materialise(_blocks(self.rows, self.sizes, "segments").mapInArrow(_build, PACK), "cover-trees")
        self.pairs = int(self.sizes.agg(F.sum(F.col("segments") * F.col("parts"))).first()[0] or 0)

    def _meet(self, anchors: DataFrame, search, schema: str) -> DataFrame:
        """Every group of anchors with every tree of its length, a tree first, then its groups one by one."""
        sizes = F.broadcast(self.sizes)
        upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c).cast("int") - 1))
        trees = (self.trees.join(sizes, "d").withColumn("part", upto("parts"))
                 .select("d", "parts", F.col("block").alias("segment"), "part", F.lit(-1).alias("slot"), "pack"))
        groups = (_blocks(anchors, self.sizes, "slots").mapInArrow(_group, PACK).join(sizes, "d")
                  .withColumn("segment", upto("segments"))
                  .select("d", "parts", "segment", (F.col("block") / SLOTS).cast("int").alias("part"),
                          F.col("block").alias("slot"), "pack"))
        n = max(1, min(self.pairs, PARTITIONS))
        turn = F.pmod(F.xxhash64("d") + F.col("segment") * F.col("parts") + F.col("part"), F.lit(n)).cast("int")
        met = (trees.unionByName(groups).withColumn("turn", turn).repartitionById(n, "turn")
               .sortWithinPartitions("d", "segment", "part", "slot").select("slot", "pack"))

        def run(batches):
            tree = None
            for batch in batches:
                for slot, pack in _cells(batch, "slot", "pack"):
                    fields = np.load(io.BytesIO(pack.as_py()))
                    if slot.as_py() < 0:
                        tree = CoverTree(**{f: fields[f] for f in CoverTree.FIELDS})
                    else:
                        yield search(tree, {f: fields[f] for f in fields.files})
        return met.mapInArrow(run, schema)

    def positives(self, k: int = POSITIVES) -> DataFrame:
        """(anchor_id, positive_id, score, nth): each anchor's best other rows of its label."""
        def search(tree: CoverTree, g: dict) -> pa.RecordBatch:
            rows = []
            for own, label, q in zip(g["ids"].tolist(), g["labels"].tolist(), g["v"]):
                (best,), _ = tree.search(q, own, label, [-np.inf], [np.inf], k, True)
                rows += [(own, i, s) for s, i in best]
            return _batch(rows, ("anchor_id", "positive_id", "score"))
        found = self._meet(self.anchors, search, "anchor_id long, positive_id long, score long")
        best = W.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
        return found.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k)

    def negatives(self, positives: DataFrame, k: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
        """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
        def search(tree: CoverTree, g: dict) -> pa.RecordBatch:
            rows, at = [], 0
            for own, label, q, m in zip(g["ids"].tolist(), g["labels"].tolist(), g["v"], g["many"].tolist()):
                pairs = [(p, s, -(-low * s // 100), high * s // 100)
                         for p, s in zip(g["positive"][at:at + m].tolist(), g["score"][at:at + m].tolist())]
                at += m
                pairs = [p for p in pairs if p[2] <= p[3]]
                if pairs:
                    found, _ = tree.search(q, own, label, [p[2] for p in pairs], [p[3] for p in pairs], k, False)
                    rows += [(own, p[0], p[1], i, s) for p, f in zip(pairs, found) for s, i in f]
            return _batch(rows, ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"))
        known = positives.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "score")).alias("p"))
        anchors = (self.anchors.join(known, F.col("vec_id") == F.col("anchor_id"))
                   .select("vec_id", "label", "v", "d", F.col("p.positive_id").alias("positive"), F.col("p.score").alias("score")))
        found = self._meet(anchors, search, "anchor_id long, positive_id long, positive_score long, "
                                            "negative_id long, negative_score long")
        best = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
        return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
                .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def _batch(rows: list, names: tuple) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], names=list(names))


def mine(vectors: DataFrame) -> DataFrame:
    """The contract's columns."""
    index = Index(vectors)
    return index.negatives(materialise(index.positives(), "positives"))


REPORT_SQL = f"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM r a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % {EVERY} = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
