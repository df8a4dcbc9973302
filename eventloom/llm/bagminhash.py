"""Near-duplicates by BagMinHash.

A text is the multiset of its five-word shingles (of all its words, if fewer).
Weights are discretised to whole numbers and laid out in dyadic blocks, [0,1),
[1,2), [2,4), [4,8) ... Each element has a Poisson process per block that is
the same in every text: its points, ascending in time, carry a signature
component and, by splitting the block down to one cell, a place on the weight
axis. A point counts in a text if its place lies below the element's weight
there. A component's value is the earliest counting point, so two texts agree
in a component with the probability of their weighted Jaccard similarity.
Points are drawn for all elements at once, round by round, and an element
stops once its next point comes after all of its text's values.

Texts with the same words in the same order are one node, collapsed before
anything else. Signatures are cut into bands; nodes meet in buckets of equal
bands. Each node of a bucket is paired with the bucket's hub (its smallest node
by hash), pairs are verified exactly on their shingle multisets, and verified
pairs joined to classes. Buckets that then still hold several classes go on,
with a count of how many elements each node shares with any other of them: a
pair that can't reach the threshold with those, or by its sizes, is left out at
once. They get a second hub per bucket, and at last every other pair of a
bucket whose two nodes still lie in different classes is verified. So no link
that a bucket holds is lost, while pairs inside a class, which can't change it,
are never listed.

Null and empty texts have no shingles and are near nothing: each id is a class
of its own. Rows with a null id stand under a hash of their text. Repeated rows
each give a row, and so do rows that share an id but not the text. Long texts are taken whole. Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import bitmap, in_bitmap, materialise, per_chunk, row_key, text_buffer, wrapped
from eventloom.llm.words import ALNUM, Words, gram_hashes, mix, within

SHINGLE, THRESHOLD = 5, 0.8
#: Texts meet in a band with the probability s^ROWS: of pairs at the threshold
#: 0.06 % share none of the bands, while texts that only share a passage (0.3)
#: meet in 0.3 % of pairs, so that a frequent passage fills no buckets.
COMPONENTS, ROWS = 320, 8
BANDS = COMPONENTS // ROWS
_GOLD, _OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
NEVER = np.iinfo(np.int64).max


def shingles(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in order, and the text of each."""
    n = len(w.hashes) - SHINGLE + 1
    doc = w.doc_of()
    if n > 0:
        inside = np.flatnonzero(within(w.bounds, SHINGLE, n))
        h, d = gram_hashes(w.hashes, SHINGLE)[inside], doc[inside]
    else:
        h, d = np.empty(0, np.uint64), np.empty(0, np.int64)
    short = np.flatnonzero((w.counts > 0) & (w.counts < SHINGLE))
    if len(short):
        one = [gram_hashes(w.hashes[w.bounds[i]:w.bounds[i + 1]], int(w.counts[i]))[0] for i in short]
        h, d = np.concatenate([h, np.array(one, np.uint64)]), np.concatenate([d, short])
        order = np.argsort(d, kind="stable")
        h, d = h[order], d[order]
    return h, d


def weighted(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements per text: (text, 44-bit element, weight)."""
    key = np.sort(doc.astype(np.uint64) << np.uint64(44) | h >> np.uint64(20))
    if not len(key):
        return np.empty(0, np.int64), key, np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    weight = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key >> np.uint64(44)).astype(np.int64), key & np.uint64((1 << 44) - 1), weight


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """One row of COMPONENTS values per text; texts without elements have NEVER."""
    # an element's blocks: lower bound 0, 1, 2, 4 ... below its weight
    parts = [(np.arange(len(doc)), 0, 1)]
    low = 1
    while len(weight) and low < weight.max():
        parts.append((np.flatnonzero(weight > low), low, low))
        low *= 2
    at = np.concatenate([p[0] for p in parts])
    lower = np.concatenate([np.full(len(p[0]), p[1], np.int64) for p in parts])
    width = np.concatenate([np.full(len(p[0]), p[2], np.int64) for p in parts])
    d, w = doc[at], weight[at]
    seed = mix(element[at] * _GOLD + lower.astype(np.uint64))
    time = np.zeros(len(at), np.int64)
    sig = np.full(n * COMPONENTS, NEVER, np.int64)
    turn = np.zeros(1, np.uint64)
    while len(d):
        u = mix(seed + turn * _OTHER)
        # waiting times in whole steps of 2^-40, so that all machines agree
        wait = -np.log(((u >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
        time += np.maximum(1, (wait * 2.0 ** 40 / width).astype(np.int64))
        v = mix(u ^ _GOLD)
        cell = (v >> np.uint64(16)) % width.astype(np.uint64)
        counts = lower + cell.astype(np.int64) < w
        part = d * COMPONENTS + (v % np.uint64(COMPONENTS)).astype(np.int64)
        np.minimum.at(sig, part[counts], time[counts])
        latest = sig.reshape(n, COMPONENTS).max(1)
        on = time < latest[d]
        d, w, seed, time, lower, width = d[on], w[on], seed[on], time[on], lower[on], width[on]
        turn += np.uint64(1)
    return sig.reshape(n, COMPONENTS)


def band_hashes(sig: np.ndarray) -> np.ndarray:
    """One hash per text and band, different between bands."""
    rows = sig.view(np.uint64).reshape(len(sig), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for j in range(ROWS):
        out = mix(out * _OTHER + rows[:, :, j])
    return out


def _sign(part: pa.RecordBatch) -> pa.RecordBatch:
    """Per text: key and id, a 128-bit hash of its words, shingle count, bands."""
    n = len(part)
    w = Words(*text_buffer(part.column(2)), ALNUM)
    h, d = shingles(w)
    bands = band_hashes(signatures(*weighted(h, d), n)).view(np.int64)
    size = np.bincount(d, minlength=n)
    # order-dependent sums of the words; two independent ones make 128 bits
    place = (np.arange(len(w)) - np.repeat(w.bounds[:-1], w.counts)).astype(np.uint64)
    keys = []
    for salt in (_GOLD, _OTHER):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(w.hashes ^ mix(place * salt + salt)))])
        keys.append(mix(total[w.bounds[1:]] - total[w.bounds[:-1]] + w.counts.astype(np.uint64)).view(np.int64))
    ends = np.concatenate([[0], np.cumsum(np.where(size > 0, BANDS, 0))]).astype(np.int32)
    flat = pa.ListArray.from_arrays(pa.array(ends), pa.array(bands[size > 0].ravel()))
    return pa.RecordBatch.from_arrays(
        [part.column(0), part.column(1), pa.array(keys[0]), pa.array(keys[1]), pa.array(size.astype(np.int64)), flat],
        names=["key", "doc_id", "k1", "k2", "n", "bands"])


def sign(docs: DataFrame) -> DataFrame:
    """(key, doc_id, k1, k2, n, bands) per document."""
    return (docs.select(row_key(docs).alias("key"), F.col("doc_id").cast("long"), "text")
            .mapInArrow(per_chunk(_sign), "key long, doc_id long, k1 long, k2 long, n long, bands array<long>"))


def _numbered(h: np.ndarray) -> np.ndarray:
    """A multiset as a sorted set: the i-th copy of an element becomes its own element."""
    h = np.sort(h)
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
    nth = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
    return np.sort(mix(h + nth.astype(np.uint64) * _GOLD))


def multisets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, bag): the shingle multisets of the documents in ``nodes.node``.

    A bitmap of a fixed size keeps most other documents from being split into
    words and shuffled; the join decides."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(nodes.select("node"), "node"))

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(shared.value, np.asarray(batch.column(0)))))
            yield from _bags([batch])

    def bag(part: pa.RecordBatch) -> pa.RecordBatch:
        h, d = shingles(Words(*text_buffer(part.column(1)), ALNUM))
        cut = np.searchsorted(d, np.arange(len(part) + 1))
        bags = [_numbered(h[a:b]).tobytes() for a, b in zip(cut, cut[1:])]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(bags, pa.binary())], names=["node", "bag"])

    _bags = per_chunk(bag)
    return (docs.select(row_key(docs).alias("node"), "text").mapInArrow(run, "node long, bag binary")
            .join(nodes, "node", "left_semi"))


def _overlap(batches):
    for batch in batches:
        a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        near = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(x) + len(y)
            at = np.searchsorted(x, y)
            met = int((x[np.minimum(at, len(x) - 1)] == y).sum()) if len(x) else 0
            near.append(met >= THRESHOLD * (both - met) and met > 0)
        kept = batch.select([0, 1]).filter(pa.array(near, pa.bool_()))
        if len(kept):
            yield kept


def verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """Pairs (a, b) whose weighted Jaccard similarity reaches the threshold."""
    one = bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b"))
    two = bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a"))
    return (pairs.select("a", "b").join(one, "b").join(two, "a").select("a", "b", "bag_a", "bag_b")
            .mapInArrow(_overlap, "a long, b long").distinct())


def classes(edges: DataFrame, name: str) -> DataFrame:
    """(node, class): each linked node with the smallest node of its component.

    Alternating star contraction: every node hangs its larger neighbours, then
    its smaller ones, on the smallest; each round is written and read back."""
    pairs = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), name)
    state = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        pairs = materialise(
            hung.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u > v").distinct(), name)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if now == state:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("class"))
        state = now


def _fits(a: str, b: str):
    """Whether sizes allow the threshold."""
    return F.least(a, b) >= THRESHOLD * F.greatest(a, b)


def _may_share(n_a: str, n_b: str, s_a: str, s_b: str):
    """Whether two multisets can overlap enough: near ones share at least
    t / (1 + t) of their sizes' sum, and none shares more than its shareable part."""
    return F.least(s_a, s_b) >= THRESHOLD / (1 + THRESHOLD) * (F.col(n_a) + F.col(n_b)) - 1e-6


def _hubs(place: DataFrame, order) -> DataFrame:
    """Each bucket of two or more nodes with its first node by ``order``."""
    kept = [c for c in ("node", "n", "s", "class") if c in place.columns]
    return (place.groupBy("bucket")
            .agg(F.min(F.struct(order.alias("h"), *kept)).alias("hub"), F.count("*").alias("size"))
            .filter("size > 1")
            .select("bucket", *[F.col(f"hub.{c}").alias("hub" if c == "node" else f"hub_{c}") for c in kept]))


def _to_hubs(joined: DataFrame) -> DataFrame:
    """(a, b), smaller first: each node with the hubs of its buckets."""
    return (joined.filter((F.col("hub") != F.col("node")) & _fits("n", "hub_n") & _may_share("n", "hub_n", "s", "hub_s"))
            .select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct())


def _mixed(shared: DataFrame, label: DataFrame, name: str) -> DataFrame:
    """(bucket, node, n, class) of the buckets that hold several classes."""
    held = (shared.join(label, "node", "left")
            .withColumn("class", F.coalesce("class", "node")))
    several = held.groupBy("bucket").agg(F.min("class").alias("x"), F.max("class").alias("y")).filter("x < y")
    return materialise(held.join(several.select("bucket"), "bucket"), name)


def shareable(bags: DataFrame) -> DataFrame:
    """(node, s): how many of a node's elements occur in another of ``bags``."""
    def elements(batches):
        for batch in batches:
            for i in range(len(batch)):
                bag = np.frombuffer(batch.column(1)[i].as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(bag), batch.column(0)[i].as_py(), np.int64)), pa.array(bag)],
                    names=["node", "element"])

    own = (bags.mapInArrow(elements, "node long, element long")
           .groupBy("element").agg(F.count("*").alias("texts"), F.min("node").alias("node"))
           .filter("texts = 1").groupBy("node").agg(F.count("*").alias("own")))
    size = (F.octet_length("bag") / 8).cast("long")
    return bags.join(own, "node", "left").select("node", (size - F.coalesce("own", F.lit(0))).alias("s"))


def near_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, key, node, class_id, n): one row per document. ``node`` is the
    smallest id of equal texts, ``class_id`` that of the near-duplicate class."""
    signed = materialise(sign(docs), "signed")
    # equal texts: the copies of a third of all rows leave one row per map task
    nodes = materialise(
        signed.filter("n > 0").groupBy("k1", "k2")
        .agg(F.min("key").alias("node"), F.max("n").alias("n"), F.first("bands").alias("bands")), "nodes")
    # s: how much of a node others may share; all of it, until that is counted
    place = nodes.select("n", F.col("n").alias("s"), "node", F.explode("bands").alias("bucket"))
    shared = materialise(place.join(_hubs(place, F.xxhash64("node")), "bucket"), "buckets")
    star = materialise(_to_hubs(shared), "star")
    first = materialise(verified(star, multisets(docs, shared.select("node").distinct())), "links1")

    mixed = _mixed(shared.select("bucket", "node", "n"), classes(first, "classes1"), "mixed1")
    bags = materialise(multisets(docs, mixed.select("node").distinct()), "mixed-bags")
    able = materialise(shareable(bags), "shareable")
    mixed = mixed.join(able, "node").filter(F.col("s") >= THRESHOLD * F.col("n"))
    # other hubs: an order of each bucket's own, so that a node meets many
    hubs = _hubs(mixed, F.xxhash64("node", "bucket"))
    again = _to_hubs(mixed.join(hubs, "bucket").filter(F.col("class") != F.col("hub_class"))).join(star, ["a", "b"], "left_anti")
    again = materialise(again, "star2")
    second = materialise(first.union(verified(again, bags)), "links2")

    mixed = _mixed(mixed.drop("class"), classes(second, "classes2"), "mixed2")
    # a pair that shares several buckets is listed in the first of them; a node is in BANDS buckets at most
    own = mixed.groupBy("node").agg(F.collect_set("bucket").alias("in"))
    mixed = mixed.join(own, "node")
    left, right = (mixed.select("bucket", F.col("node").alias(x), *[F.col(c).alias(x + c) for c in ("n", "s", "class", "in")])
                   for x in "ab")
    across = (left.join(right, "bucket")
              .filter((F.col("aclass") != F.col("bclass")) & (F.col("a") < F.col("b")) & _fits("an", "bn")
                      & _may_share("an", "bn", "as", "bs")
                      & (F.array_min(F.array_intersect("ain", "bin")) == F.col("bucket")))
              .select("a", "b").distinct().join(star.union(again), ["a", "b"], "left_anti"))
    across = materialise(across, "across")
    label = classes(second.union(verified(across, bags)), "classes")
    return (signed.select("doc_id", "key", "k1", "k2", "n")
            .join(nodes.select("k1", "k2", "node"), ["k1", "k2"], "left")
            .withColumn("node", F.when(F.col("n") > 0, F.col("node")).otherwise(F.col("key")))
            .join(label, "node", "left")
            .select("doc_id", "key", "node", F.coalesce("class", "node").alias("class_id"), "n"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: its id, its class, the node of its equal texts, its shingles."""
    return near_classes(docs).select("doc_id", "class_id", F.col("node").alias("text_id"), F.col("n").alias("n_shingles"))


def clean(docs: DataFrame) -> DataFrame:
    """One document of each class, that with the smallest id; the same columns.
    Rows that repeat an id stay or go together."""
    kept = near_classes(docs).filter("key = class_id").select("key").distinct()
    return wrapped(docs).select("row", "key").join(kept, "key", "left_semi").select("row.*")
