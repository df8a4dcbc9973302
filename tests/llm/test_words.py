"""Vectorised word splitting against the plain rule."""

import random
import re

import numpy as np
import pyarrow as pa

from eventloom.llm.common import chunks, text_buffer
from eventloom.llm.words import ALNUM, NONSPACE, Words, gram_hashes, within
from llm.data import words


def texts():
    r = random.Random(4)
    out = [None, "", " ", "A", "a", "Éa éA", "x\x00y", "tail "]
    return out + ["".join(r.choice("aB1 .é中\x1c\n_") for _ in range(r.randint(0, 40))) for _ in range(500)]


def spans(w):
    return [[bytes(w.data[s:e]).decode() for s, e in zip(w.starts[a:b], w.ends[a:b])]
            for a, b in zip(w.bounds, w.bounds[1:])]


def test_words_and_hashes_follow_the_rules():
    t = texts()
    w = Words(*text_buffer(pa.array(t)), ALNUM)
    low = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s)
    assert [[low(x) for x in d] for d in spans(w)] == [words(x) for x in t]
    seen = {}
    for d, (a, b) in zip([words(x) for x in t], zip(w.bounds, w.bounds[1:])):
        for x, h in zip(d, w.hashes[a:b]):
            assert seen.setdefault(x, h) == h
    assert len(set(seen.values())) == len(seen)
    w = Words(*text_buffer(pa.array(t)), NONSPACE)
    assert spans(w) == [re.findall(r"[^\x20\x09-\x0D]+", x or "") for x in t]


def test_grams_stay_inside_texts():
    w = Words(*text_buffer(pa.array(["a b c", "a", None, "a b c d"])), ALNUM)
    h, inside = w.grams(3)
    assert list(np.flatnonzero(inside)) == [0, 4, 5] and h[0] == h[4] and h[4] != h[5]
    assert len(gram_hashes(w.hashes, 20)) == 0 and within(w.bounds, 8, 1).tolist() == [False]


def test_chunks_are_bounded_and_whole():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 5, 50, 1, 1, 9)] + [None])], names=["text"])
    parts = list(chunks(batch, "text", 10))
    assert [p.column(0).to_pylist() for p in parts] == [["x" * 5, "x" * 5], ["x" * 50], ["x", "x"], ["x" * 9, None]]
    assert list(chunks(batch.slice(0, 0), "text")) == []
