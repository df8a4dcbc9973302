"""Text quality: a generalised additive model with pairwise interactions.

Each document becomes a few counts and shares of its bytes, words and lines.
A feature's values fall into quantile bins, and the model is a lookup table
per feature plus one per chosen pair of features: cyclic boosting visits the
features in turn and adds a shallow tree, fitted to the current residuals, to
that feature's table. Pairs are chosen by how much of the remaining residual a
tree on both explains, then boosted alike. Scoring adds up table entries by
bin, for a whole slice of documents at once.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows outside the
held-out fold (a parameter), whose features are computed on the executors and
collected: rows times features bounds that. Scoring covers all documents,
whole texts. Labels, lang, source and doc_id are no inputs.

Nulls and empty texts have all features 0 and are scored like any text.
Without labels the score is 0.5, with one class the share of that class
(within 0.01 of 0 or 1). Repeated rows each give a row; long texts are read
whole; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import per_chunk, text_buffer
from eventloom.llm.toxicity import fold, training_rows
from eventloom.llm.words import ALNUM, Words

TRAIN_ROWS = 20_000
BINS, PAIR_BINS, ROUNDS, RATE, LEAVES, PAIRS = 32, 8, 150, 0.15, 3, 6

_LINES = np.ones(256, bool)
_LINES[0x0A] = False


def _byte_classes() -> dict[str, np.ndarray]:
    b = np.arange(256)
    upper, digit = (b >= 65) & (b <= 90), (b >= 48) & (b <= 57)
    letter = upper | (b >= 97) & (b <= 122) | (b >= 128)
    space = np.isin(b, [32, 9, 10, 11, 12, 13])
    prose = np.isin(b, [ord(c) for c in ".,;:'\"-?()"])
    return {"upper": upper, "digit": digit, "space": space, "symbol": ~(letter | digit | space | prose),
            "prose_mark": prose, "newline": b == 10, "bang": b == 33, "bar": b == 124, "high": b >= 128}


CLASSES = _byte_classes()
FEATURES = ["log_bytes", "log_words", "word_bytes", "distinct_words", "distinct_pairs", "repeats",
            "distinct_lines", "line_words", "long_word", "short_words", *CLASSES]


def _sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _distinct(hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes per text: one sort of (text number, 44 hash bits)."""
    key = np.sort(doc.astype(np.uint64) << np.uint64(44) | hashes >> np.uint64(20))
    if not len(key):
        return np.zeros(n)
    new = np.concatenate([[True], key[1:] != key[:-1]])
    return np.bincount((key[new] >> np.uint64(44)).astype(np.int64), minlength=n).astype(float)


def features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES per text."""
    data, off = text_buffer(texts)
    n, size = len(texts), np.diff(off).astype(float)
    w, lines = Words(data, off, ALNUM), Words(data, off, _LINES)
    words, rows = w.counts.astype(float), lines.counts.astype(float)
    some = lambda x: np.maximum(x, 1.0)
    doc = w.doc_of()
    length = (w.ends - w.starts).astype(float)
    pair, inside = w.grams(2)
    same = np.flatnonzero(inside)
    out = {
        "log_bytes": np.log1p(size), "log_words": np.log1p(words),
        "word_bytes": np.bincount(doc, weights=length, minlength=n) / some(words),
        "distinct_words": _distinct(w.hashes, doc, n) / some(words),
        "distinct_pairs": _distinct(pair[same], doc[same], n) / some(words - 1),
        "repeats": np.bincount(doc[same], weights=w.hashes[same] == w.hashes[same + 1], minlength=n) / some(words),
        "distinct_lines": _distinct(lines.hashes, lines.doc_of(), n) / some(rows),
        "line_words": words / some(rows),
        "long_word": np.bincount(doc, weights=length > 20, minlength=n) / some(words),
        "short_words": np.bincount(doc, weights=length <= 3, minlength=n) / some(words),
    }
    out |= {name: _sums(mask[data], off) / some(size) for name, mask in CLASSES.items()}
    return np.stack([out[f] for f in FEATURES], 1) if n else np.empty((0, len(FEATURES)))


class Additive:
    """Lookup tables over binned features and pairs."""

    def __init__(self, edges: list[np.ndarray], base: float):
        self.edges, self.base = edges, base
        self.tables = [np.zeros(len(e) + 1) for e in edges]
        self.pairs: list[tuple[int, int]] = []
        self.pair_edges = [e[:: max(1, -(-len(e) // (PAIR_BINS - 1)))] for e in edges]
        self.pair_tables: list[np.ndarray] = []

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], 1)

    def pair_bins(self, x: np.ndarray, pair: tuple[int, int]) -> np.ndarray:
        a, b = (np.searchsorted(self.pair_edges[j], x[:, j], "right") for j in pair)
        return a * (len(self.pair_edges[pair[1]]) + 1) + b

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        bins = self.bins(x)
        for j, t in enumerate(self.tables):
            out += t[bins[:, j]]
        for pair, t in zip(self.pairs, self.pair_tables):
            out += t[self.pair_bins(x, pair)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _gain(g, h):
    return g * g / (h + 1.0)


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Step function over bins with ``leaves`` pieces, split greedily by Newton gain."""
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    cuts = [0, len(g)]
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            m = np.arange(a + 1, b)
            if len(m):
                gain = (_gain(cg[m] - cg[a], ch[m] - ch[a]) + _gain(cg[b] - cg[m], ch[b] - ch[m])
                        - _gain(cg[b] - cg[a], ch[b] - ch[a]))
                i = int(np.argmax(gain))
                best = max(best, (float(gain[i]), int(m[i])), key=lambda v: v[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + 1.0)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Two cuts on a grid (rows, then columns on each side): cell values and gain."""
    out, best = np.zeros(g.shape), 0.0
    whole = _gain(g.sum(), h.sum())
    for r in range(1, g.shape[0]):
        gain, value = -whole, np.zeros(g.shape)
        for part in (slice(0, r), slice(r, None)):
            cg, ch = np.cumsum(g[part].sum(0)), np.cumsum(h[part].sum(0))
            split = _gain(cg[:-1], ch[:-1]) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1])
            c = int(np.argmax(split)) + 1 if len(split) else g.shape[1]
            gain += split[c - 1] if len(split) else _gain(cg[-1], ch[-1])
            value[part, :c] = cg[c - 1] / (ch[c - 1] + 1.0)
            value[part, c:] = (cg[-1] - cg[c - 1]) / (ch[-1] - ch[c - 1] + 1.0)
        if gain > best:
            out, best = value, gain
    return out, best


def fit_model(x: np.ndarray, y: np.ndarray) -> Additive:
    share = min(max(float(y.mean()), 0.01), 0.99) if len(y) else 0.5
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.empty(0)
             for j in range(len(FEATURES))]
    model = Additive(edges, float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    bins, margin = model.bins(x), np.full(len(y), model.base)

    def residual():
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, t in enumerate(model.tables):
            g, h = residual()
            step = RATE * shallow_tree(np.bincount(bins[:, j], g, len(t)), np.bincount(bins[:, j], h, len(t)))
            t += step
            margin += step[bins[:, j]]
    g, h = residual()
    grids = {}
    for a in range(len(FEATURES)):
        for b in range(a + 1, len(FEATURES)):
            shape = (len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)
            at = model.pair_bins(x, (a, b))
            size = shape[0] * shape[1]
            gain = pair_tree(np.bincount(at, g, size).reshape(shape), np.bincount(at, h, size).reshape(shape))[1]
            grids[a, b] = (gain, shape)
    for pair in sorted(grids, key=lambda p: -grids[p][0])[:PAIRS]:
        if grids[pair][0] > 0:
            model.pairs.append(pair)
            model.pair_tables.append(np.zeros(grids[pair][1][0] * grids[pair][1][1]))
    at = [model.pair_bins(x, p) for p in model.pairs]
    for _ in range(ROUNDS // 3):
        for p, t, i in zip(model.pairs, model.pair_tables, at):
            g, h = residual()
            shape = grids[p][1]
            step = RATE * pair_tree(np.bincount(i, g, len(t)).reshape(shape),
                                    np.bincount(i, h, len(t)).reshape(shape))[0].ravel()
            t += step
            margin += step[i]
    return model


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Additive:
    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        x = features(part.column(0))
        return pa.RecordBatch.from_arrays(
            [part.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["y", "x"])

    got = training_rows(docs, labels, "quality", rows).mapInArrow(per_chunk(run), "y int, x array<double>").collect()
    x = np.array([r["x"] for r in got], float).reshape(len(got), len(FEATURES))
    order = np.lexsort(x.T)  # the fit does not depend on the order of collected rows
    return fit_model(x[order], np.array([float(r["y"]) for r in got])[order])


def score(docs: DataFrame, model: Additive, text: str = "text") -> DataFrame:
    """Add ``quality``, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        q = shared.value.score(features(part.column(part.schema.get_field_index(text))))
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(q)], names=[*part.schema.names, "quality"])

    return docs.mapInArrow(per_chunk(run, text), docs.withColumn("quality", F.lit(0.0)).schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels)).drop("text")
    return scored.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), F.col("quality").alias("score"),
        (F.col("quality") >= 0.3).cast("int").alias("predicted"))
