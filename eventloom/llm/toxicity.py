"""Toxic passages by maximum-scoring segment search.

Token scores are log-odds of toxic against clean use under an informative
Dirichlet prior (the pooled token shares, worth ``PRIOR`` tokens), for tokens
whose log-odds are at least ``LEAST`` (20 times likelier in toxic texts) and
whose root log-likelihood ratio is at least ``Z``: that grows with every use in
toxic texts only, and with clean text that does without the token. Every word
pays ``DRIFT``. Tokens are
words and, as insults are inflected, the first bytes of longer words
(``STEMS``); a word scores as the best of its tokens. All maximal-scoring
segments of a text are found in one pass over the words that score above zero,
as the rest only adds drift between them.

Segments are calibrated by extreme-value theory: with lambda the positive root
of E[exp(lambda s)] = 1 over clean tokens and K fitted on clean documents, a
text of n tokens is expected to hold K n exp(-lambda S) segments of score S or
more by chance. A document's evidence is the sum, over its segments expected
less than once, of -log10 of that number; a logistic curve fitted on the
training documents turns it into the score.

The classifier is fitted on at most ``TRAIN_ROWS`` labelled rows (the bound is
a parameter; the rows with the smallest hash of their id, never those held
out). Scoring covers all documents, whole.

Nulls and empty texts have no segments and get the score of no evidence.
Labels that are null are no labels; a doc_id labelled twice counts as toxic if
any label says so. Without labels, or with one class only, no token scores and
every score is the share of toxic labels (0 without any). Repeated rows each
give a row. Only doc_id, text, toxic are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import materialise, per_chunk, text_buffer
from eventloom.llm.words import ALNUM, Words

TRAIN_ROWS = 20_000
PRIOR, Z, LEAST, DRIFT, CLIP = 5_000.0, 4.0, 3.0, 0.5, 6.0
#: Prefix lengths, in bytes, that are tokens besides the words.
STEMS = (4, 6)
#: Tokens that a model holds at most: those with the largest ratio (bounds its broadcast).
MODEL_TOKENS = 100_000


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int, folds: int = 5) -> DataFrame:
    """(text, y) of at most ``rows`` labelled documents outside the held-out fold."""
    chosen = (labels.select("doc_id", F.col(label).cast("int").alias("y"))
              .filter(F.col("y").isNotNull() & (fold(F.col("doc_id"), folds) != 0))
              .groupBy("doc_id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # at most ``rows`` rows of two numbers
    return materialise(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
                       .select("text", "y"), f"train-{label}")


def _tokens(w: Words):
    """(hashes, word number) of each kind of token."""
    yield w.hashes, np.arange(len(w))
    for k in STEMS:
        h, longer = w.prefixes(k)
        at = np.flatnonzero(longer)
        yield h[at], at


def _counts(part: pa.RecordBatch) -> pa.RecordBatch:
    """Per slice: token hash, uses in toxic and in clean texts."""
    w = Words(*text_buffer(part.column(0)), ALNUM)
    y = np.asarray(part.column(1).to_numpy(zero_copy_only=False), np.int64)[w.doc_of()]
    kinds = list(_tokens(w))
    h, at = np.unique(np.concatenate([k[0] for k in kinds]), return_inverse=True)
    toxic = np.bincount(at, weights=np.concatenate([y[k[1]] for k in kinds]), minlength=len(h)).astype(np.int64)
    both = np.bincount(at, minlength=len(h))
    return pa.RecordBatch.from_arrays(
        [pa.array(h.view(np.int64)), pa.array(toxic), pa.array(both - toxic)], names=["h", "toxic", "clean"])


class Model:
    """Token scores, sorted by hash, and the calibration."""

    def __init__(self, hashes: np.ndarray, scores: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.scores = hashes[order], scores[order]
        self.rate, self.k, self.curve = 1.0, 1.0, (0.0, 0.0)

    def word_scores(self, w: Words) -> np.ndarray:
        """The best listed token of each word; 0 without one (it only pays drift)."""
        out = np.zeros(len(w))
        if len(self.hashes):
            for h, word in _tokens(w):
                at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                hit = np.flatnonzero(self.hashes[at] == h)
                out[word[hit]] = np.maximum(out[word[hit]], self.scores[at[hit]])
        return out


def segments(place: list[int], score: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments of tokens at ``place`` (ascending) with
    positive ``score``, every other token scoring -DRIFT: (start, end, score)."""
    found: list[list[float]] = []  # start, end, sum before, sum after
    total, last = 0.0, -1
    for p, s in zip(place, score):
        total -= DRIFT * (p - last - 1)
        cur = [p, p + 1, total, total + s]
        total, last = cur[3], p
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= cur[2]:
                j -= 1
            if j < 0 or found[j][3] >= cur[3]:
                found.append(cur)
                break
            # the earlier segment and all after it grow into one
            cur = [found[j][0], cur[1], found[j][2], cur[3]]
            del found[j:]
    return [(int(a), int(b), after - before) for a, b, before, after in found]


def _doc_segments(model: Model, w: Words):
    """(text number, segments) of the texts that have any."""
    s = model.word_scores(w)
    at = np.flatnonzero(s > 0)
    if len(at):
        doc = np.searchsorted(w.bounds, at, "right") - 1
        cut = np.flatnonzero(np.diff(doc)) + 1
        for some, value in zip(np.split(at, cut), np.split(s[at], cut)):
            d = int(np.searchsorted(w.bounds, some[0], "right") - 1)
            yield d, segments((some - w.bounds[d]).tolist(), value.tolist())


def evidence(model: Model, n: int, segs: list[tuple[int, int, float]]) -> float:
    """Sum of -log10 of the expected number, over segments expected less than once."""
    return sum(max(0.0, (model.rate * s - math.log(model.k * max(n, 1))) / math.log(10)) for _, _, s in segs)


def likelihood_ratio(n_t: float, n_c: float) -> Column:
    """G-squared of a token's uses: how much likelier they are by shares of their
    own in the ``n_t`` toxic and ``n_c`` clean tokens than by one share in both."""
    uses = F.col("toxic") + F.col("clean")
    total = F.lit(0.0)
    for name, n in (("toxic", n_t), ("clean", n_c)):
        expected = uses * (n / (n_t + n_c))
        for seen, due in ((F.col(name), expected), (n - F.col(name), n - expected)):
            total = total + F.when(seen > 0, seen * F.log(seen / due)).otherwise(0.0)
    return 2 * total


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    sample = training_rows(docs, labels, "toxic", rows)
    counts = materialise(
        # a text that was copied many times is one witness
        sample.dropDuplicates(["text", "y"]).select("text", "y")
        .mapInArrow(per_chunk(_counts), "h long, toxic long, clean long")
        .groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "toxic-counts")
    n_t, n_c = counts.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum("clean"), F.lit(0))).first()
    n_t, n_c = float(n_t), float(n_c)
    if not n_t or not n_c:
        model = Model(np.empty(0, np.uint64), np.empty(0))
        share = sample.agg(F.avg("y")).first()[0] or 0.0
        model.curve = (_logit(min(max(share, 1e-6), 1 - 1e-6)), 0.0)
        return model
    prior = (F.col("toxic") + F.col("clean")) * (PRIOR / (n_t + n_c))
    with_prior = counts.withColumns({"a": F.col("toxic") + prior, "b": F.col("clean") + prior})
    odds = (F.log(F.col("a") / (n_t + PRIOR - F.col("a"))) - F.log(F.col("b") / (n_c + PRIOR - F.col("b"))))
    scored = with_prior.withColumn("odds", odds).withColumn("ratio", likelihood_ratio(n_t, n_c))
    top = (scored.filter((F.col("ratio") >= Z * Z) & (F.col("odds") >= LEAST))
           .orderBy(F.desc("ratio"), "h").limit(MODEL_TOKENS).select("h", "odds", "b").toPandas())
    model = Model(top["h"].to_numpy(np.int64).view(np.uint64),
                  np.minimum(top["odds"].to_numpy(float), CLIP) - DRIFT)
    share = top["b"].to_numpy(float)[np.argsort(top["h"].to_numpy(np.int64).view(np.uint64))] / (n_c + PRIOR)
    model.rate = _positive_root(share, model.scores)
    _calibrate(model, sample)
    return model


def _positive_root(share: np.ndarray, scores: np.ndarray) -> float:
    """Lambda > 0 with E[exp(lambda s)] = 1 over clean tokens."""
    def excess(x: float) -> float:
        return float(share @ np.exp(x * scores) + (1 - share.sum()) * math.exp(-x * DRIFT) - 1)
    if not len(scores):
        return 1.0
    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def _calibrate(model: Model, sample: DataFrame) -> None:
    """K by maximum likelihood on clean documents, then the logistic curve.
    The sample has a bounded number of rows; three numbers of each are collected."""
    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        w = Words(*text_buffer(part.column(0)), ALNUM)
        segs = [[] for _ in range(len(part))]
        for d, found in _doc_segments(model, w):
            segs[d] = [s for _, _, s in found]
        return pa.RecordBatch.from_arrays(
            [part.column(1), pa.array(w.counts.astype(np.int64)), pa.array(segs, pa.list_(pa.float64()))],
            names=["y", "n", "s"])

    rows = sample.mapInArrow(per_chunk(run), "y int, n long, s array<double>").collect()
    clean = [(r["n"], max(r["s"], default=0.0)) for r in rows if r["y"] == 0]
    model.k = len(clean) / max(1e-9, sum(n * math.exp(-model.rate * m) for n, m in clean))
    x = np.array([evidence(model, r["n"], [(0, 0, s) for s in r["s"]]) for r in rows])
    y = np.array([float(r["y"]) for r in rows])
    model.curve = fit_logistic(_squash(x), y)


def _squash(x):
    return np.log1p(x)


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Intercept and slope (not negative) by Newton's method with a small ridge."""
    beta, a = np.zeros(2), np.stack([np.ones_like(x), x], 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        g = a.T @ (y - p) - 1e-3 * beta
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(h, g), -2, 2)
    return float(beta[0]), float(max(beta[1], 0.0))


def probability(model: Model, evidence_: float) -> float:
    a, b = model.curve
    return 1 / (1 + math.exp(-min(max(a + b * math.log1p(evidence_), -30), 30)))


def detect(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``toxicity`` (0 to 1) and ``passages``: every segment expected less than
    once by chance, as (start word, end word, score, expected)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())])

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        w = Words(*text_buffer(part.column(part.schema.get_field_index(text))), ALNUM)
        n = w.counts
        score = np.full(len(part), probability(m, 0.0))
        found: list[list[dict]] = [[] for _ in range(len(part))]
        for d, segs in _doc_segments(m, w):
            score[d] = probability(m, evidence(m, int(n[d]), segs))
            for a, b, s in segs:
                expected = m.k * int(n[d]) * math.exp(-m.rate * s)
                if expected < 1:
                    found[d].append({"start": a, "end": b, "score": s, "expected": expected})
        return pa.RecordBatch.from_arrays(
            [*part.columns, pa.array(score), pa.array(found, pa.list_(passage))],
            names=[*part.schema.names, "toxicity", "passages"])

    out = docs.withColumns({"toxicity": F.lit(0.0), "passages": F.lit(None).cast(
        "array<struct<start:bigint,end:bigint,score:double,expected:double>>")}).schema
    return docs.mapInArrow(per_chunk(run, text), out)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns, and how many passages were found."""
    scored = detect(docs.select("doc_id", "text"), fit(docs, labels)).drop("text")
    return scored.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


def clean(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """Documents that score below ``limit``; the same columns."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    at = docs.columns.index("text")

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        w = Words(*text_buffer(part.column(at)), ALNUM)
        n, keep = w.counts, np.full(len(part), probability(m, 0.0) < limit)
        for d, segs in _doc_segments(m, w):
            keep[d] = probability(m, evidence(m, int(n[d]), segs)) < limit
        return part.filter(pa.array(keep))

    return docs.mapInArrow(per_chunk(run), docs.schema)
