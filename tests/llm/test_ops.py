"""Each operator against a plain version on small data, edge cases included."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from compare import compare
from eventloom.llm import bagminhash, bpe, decontam, forest, license, lm, pii, quality, queries, toxicity, warc
from eventloom.llm.words import hash_words
from llm.data import SMALL, edge_docs, edge_rows, items, labels, no_docs, prose, words


def rows(df):
    return [tuple(r) for r in df.collect()]


def some(df):
    return sorted((str(tuple(r)) for r in df.collect()))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, con_small, name):
    r = compare(queries.QUERIES[name](spark, SMALL), con_small, queries.ORACLES[name])
    assert r["cols_match"] and r["rows"][0] == r["rows"][1] and r["hash_match"], r


def test_all_operators_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14))
    assert "pipeline" in names


# --- 1: WARC ---------------------------------------------------------------

def pages(spark):
    big, other = "é" * 60, "b" * 100
    return spark.createDataFrame(
        [(5, "http://a/\r\nx", big), (3, None, big), (9, "u", big), (4, "u", "small"), (6, "u", "small"), (7, "u", None),
         (8, "u", ""), (None, "u", big), (None, "u", other), (None, "u", other), (3, "u", big), (2, "u", "c" * 99),
         (1, "u", "c" * 99), (10, "u", "\r\n\r\nWARC/1.1" * 30_000)],
        "page_id long, url string, html string").withColumn("payload", F.lit(1))


def test_warc_round_trip_with_edges(spark):
    got = sorted(rows(warc.archive(pages(spark))), key=str)
    want, first = [], {}
    for p, _, h in pages(spark).select("page_id", "url", "html").collect():
        if p is not None and len((h or "").encode()) >= 100:
            first[h] = min(p, first.get(h, p))
    for p, _, h in pages(spark).select("page_id", "url", "html").collect():
        b = (h or "").encode()
        to = first.get(h) if len(b) >= 100 and p != first.get(h) else None
        want.append((p, len(b), hashlib.sha256(b).hexdigest(), "response" if to is None else "revisit", to))
    assert got == sorted(want, key=str)
    assert rows(warc.archive(pages(spark).filter("false"))) == []


def test_warc_bundles_are_seekable_and_plain_zstd(spark):
    import io
    import zstandard
    from eventloom.llm.common import shared_folder
    df = spark.read.parquet(f"{SMALL}/pages.parquet").coalesce(1)
    index = warc.write_bundles(df, shared_folder(spark, "t"), frame_bytes=20_000)
    want = {r.page_id: (r.html or "").encode() for r in df.collect()}
    one = index.first().bundle
    fs, inner = warc.filesystem(one)
    packed = fs.open_input_file(inner).read()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(packed), read_across_frames=True).read()
    assert plain.count(b"WARC/1.1\r\n") >= len(want) and index.select("frame").distinct().count() > 3
    picked = spark.createDataFrame([(7,), (33,), (10 ** 9,)], "page_id long")
    got = {r.page_id: bytes(r.payload) for r in warc.lookup(index, picked).collect() if r.record_type == "response"}
    assert got == {k: want[k] for k in (7, 33)}
    for r in index.limit(5).collect():
        head, _, _ = warc.parse(warc.BundleReader(r.bundle).frame(r.frame)[r.offset:r.offset + r.length])
        assert head["WARC-Record-ID"] == f"<urn:page:{r.page_id}>"


# --- 2: language model -------------------------------------------------------

def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def plain_lm(train, texts, order):
    """Dictionaries in place of the trie; the same smoothing and byte rounding."""
    q = lambda p: lm.LOG10[lm.quantise(np.array([p]))[0]]
    grams = [collections.Counter() for _ in range(order + 1)]
    for t in train:
        for k in range(1, order + 1):
            grams[k].update(tuple(t[i - k + 1:i + 1]) for i in range(k - 1, len(t)))
    n, v = sum(grams[1].values()), len(grams[1])
    price = [None, {g: q((c + 1) / (n + v + 1)) for g, c in grams[1].items()}]
    unknown, back = q(1 / (n + v + 1)), [None, {}]
    for k in range(2, order + 1):
        total = collections.Counter()
        for g, c in grams[k].items():
            total[g[:-1]] += c
        gs = list(grams[k])
        low = np.array([10.0 ** price[k - 1][g[1:]] for g in gs])
        c, t = np.array([grams[k][g] for g in gs], float), np.array([total[g[:-1]] for g in gs], float)
        mu = lm.smooth(c, t, low)
        price.append(dict(zip(gs, (q(x) for x in (c + mu * low) / (t + mu)))))
        back.append({g: q(mu / (total[g] + mu)) for g in grams[k - 1]})
    out = []
    for t in texts:
        score = 0.0
        for i in range(len(t)):
            p = price[1].get((t[i],), unknown)
            for k in range(2, min(order, i + 1) + 1):
                g = tuple(t[i - k + 1:i + 1])
                p = price[k][g] if g in price[k] else p + back[k].get(g[:-1], 0.0)
            score += p
        base = sum(math.log10((grams[1][(w,)] + 1) / (n + v + 1)) for w in t)
        out.append((len(t), sum(grams[1][(w,)] > 0 for w in t), base, score))
    return n, out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_trie_scores_equal_plain_dictionaries(spark, order):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(
        edge_docs(spark).filter("length(text) < 5000 or text is null").select("doc_id", "text"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    train = docs.filter(~held)
    trie = lm.train(train, order, least_shards=1)
    got = lm.score(docs, trie).collect()
    n, want = plain_lm([tokens(r.text) for r in train.collect()], [tokens(r.text) for r in got], order)
    assert trie.total == n
    for r, (count, known, base, score) in zip(got, want):
        assert (r.n_tokens, r.n_known) == (count, known)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9, abs=1e-9)


def test_trie_of_many_shards_and_volumes(spark):
    """With one mu for all shards, the cut into shards and volumes changes nothing."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    texts = spark.createDataFrame([(r.text,) for r in docs.collect()], "text string")
    one, many = (sorted((r.text, round(r.score, 6)) for r in lm.score(
        texts, lm.train(texts, 3, least_shards=n, grid=(4.0,))).collect()) for n in (1, 150))
    assert one == many


def test_lm_scores_do_not_depend_on_the_number_of_shards(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    texts = spark.createDataFrame([(r.text,) for r in docs.collect()], "text string")
    one, twelve, many = (sorted((r.text, round(r.score, 6)) for r in lm.score(
        texts, lm.train(texts, 3, least_shards=n)).collect()) for n in (1, 12, 150))
    assert one == twelve == many


def test_lm_sums_blocks_as_they_come(monkeypatch):
    """What a task holds follows the different n-grams, not the blocks."""
    import tracemalloc
    monkeypatch.setattr(lm, "FOLD", 10_000, raising=False)
    keys = np.arange(10_000, dtype=np.uint64) * np.uint64(7)
    ones, lower = np.ones(len(keys), np.uint32), np.arange(len(keys), dtype=np.uint32) % 251

    def peak(n):
        block = lm.pack(keys, ones, lower)
        tracemalloc.start()
        got = lm.merged((block for _ in range(n)), 2)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert (got[0] == keys).all() and (got[1] == n).all() and (got[2] == lower).all()
        return most

    assert peak(100) < 1.5 * peak(5)
    one, two = lm.merged(iter([lm.pack(keys, ones)] * 7 + [lm.pack(keys[:3], ones[:3])]), 1)[:2]
    assert (one == keys).all() and two.tolist() == [8] * 3 + [7] * (len(keys) - 3)


def test_lm_pieces_are_bounded_whatever_the_first_word(spark):
    """Different n-grams of one frequent first word are dealt over many pieces."""
    rows = [(i, " ".join(f"the a{i * 7 + j} b{j}" for j in range(30))) for i in range(80)] + [(None, ""), (99, None)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    one, many = (lm.train(texts, 4, least_shards=2, most=n) for n in (1 << 40, 40))
    # the contexts of a piece occur 40 times together, but for its last, here at most 80 times
    widest = [np.diff(t.levels[2].offset).max() for t in (one, many)]
    assert widest[0] > 4000 and widest[1] <= 120
    assert len(many.levels[2].offset) > lm.VOLUME  # so several volumes too
    got = [sorted((r.doc_id or -1, r.score) for r in lm.score(texts, t).collect()) for t in (one, many)]
    assert got[0] == got[1]
    _, want = plain_lm([tokens(t) for _, t in rows], [tokens(t) for _, t in rows], 4)
    assert [s for _, s in got[1]] == pytest.approx(
        [s for _, s in sorted((i or -1, w[3]) for (i, _), w in zip(rows, want))], rel=1e-9)


def test_lm_report_holds_out_and_beats_the_base(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op2_lm"](spark, SMALL).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2) for i, r in got.items())
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())
    assert len({r.train_tokens for r in got.values()}) == 1


def test_lm_edges(spark):
    r = lm.report(edge_docs(spark)).collect()
    assert len(r) == len(edge_rows()) and all(math.isfinite(x.score) for x in r)
    assert lm.report(no_docs(spark)).collect() == []
    only_held = edge_docs(spark).filter("doc_id = -1")
    scored = lm.score(edge_docs(spark).select("doc_id", "text"), lm.train(only_held.select("text"))).collect()
    assert all(x.score == 0.0 and x.n_known == 0 for x in scored)


def test_elias_fano_finds_what_it_holds():
    from eventloom.llm.eliasfano import Shelf, encode
    r = np.random.default_rng(5)
    held = [(u, np.sort(r.integers(0, min(u, 1 << 63), n).astype(np.uint64)))
            for u, n in ((1 << 64, 700), (50, 400), (7, 0), (10 ** 9, 1), (1 << 40, 3000), (10 ** 6, 9))]
    shelf = Shelf.of(*(encode(v, u) for u, v in held))
    asks, seqs, want = [], [], []
    for k, (_, v) in enumerate(held):
        assert (shelf.access(np.full(len(v), k), np.arange(len(v))) == v).all()
        ask = np.concatenate([v, r.integers(0, 1 << 62, 100).astype(np.uint64), np.array([0, 2 ** 64 - 1], np.uint64)])
        at, known = np.searchsorted(v, ask), set(v.tolist())
        asks.append(ask)
        seqs.append(np.full(len(ask), k))
        want += [int(i) if int(x) in known else -1 for i, x in zip(at, ask)]
    mixed = r.permutation(len(want))
    got = shelf.find(np.concatenate(seqs)[mixed], np.concatenate(asks)[mixed])
    assert got.tolist() == [want[i] for i in mixed]


def test_elias_fano_walks_to_a_clear_bit_once_per_question(monkeypatch):
    from eventloom.llm import eliasfano
    r = np.random.default_rng(6)
    # many values of one high part (runs of set bits over several words), and few
    held = [np.unique(np.concatenate([r.integers(0, 1 << 40, 300), np.arange(5000) + (1 << 39)])).astype(np.uint64),
            np.arange(1000, dtype=np.uint64), r.integers(0, 90, 64).astype(np.uint64)]
    held[2].sort()
    shelf = eliasfano.Shelf.of(*(eliasfano.encode(v, u) for v, u in zip(held, (1 << 40, 1000, 90))))
    asked, select = [], eliasfano._select_in_word
    monkeypatch.setattr(eliasfano, "_select_in_word", lambda w, k: asked.append(len(k)) or select(w, k))
    for i, v in enumerate(held):
        ask = np.unique(np.concatenate([v, v + np.uint64(1), r.integers(0, 1 << 40, 500).astype(np.uint64)]))
        at = np.searchsorted(v, ask)
        want = np.where((at < len(v)) & (v[np.minimum(at, len(v) - 1)] == ask), at, -1)
        assert shelf.find(np.full(len(ask), i), ask).tolist() == want.tolist()
    asked.clear()  # a second walk only where the set bits leave their word
    sparse = eliasfano.Shelf.of(eliasfano.encode(held[1], 1000))
    assert (sparse.find(np.zeros(1000, int), held[1]) == np.arange(1000)).all() and sum(asked) < 1200


def test_sequences_answer_many_questions_in_blocks():
    """Many questions of sequences of several widths: right places, in little memory besides the answer."""
    import tracemalloc

    from eventloom.llm.eliasfano import Shelf, encode
    rng = np.random.default_rng(5)
    held = [np.unique(rng.integers(0, u, n).astype(np.uint64)) for u, n in ((1 << 60, 5000), (1 << 20, 9000), (3000, 3000), (1, 1))]
    held[1] = np.unique(np.concatenate([held[1], np.arange(500_000, 504_000, dtype=np.uint64)]))  # one part is crowded
    shelf = Shelf.of(*(encode(v, u) for v, u in zip(held, (1 << 60, 1 << 20, 3000, 1))))
    seq = np.sort(rng.integers(0, 4, 400_000))
    place = (rng.random(len(seq)) * np.array([len(v) for v in held])[seq]).astype(np.int64)
    asked = np.concatenate(held)[np.cumsum([0, *map(len, held)])[seq] + place] + (rng.random(len(seq)) < 0.3).astype(np.uint64)
    want = [{int(x): i for i, x in enumerate(v)} for v in held]
    tracemalloc.start()
    try:
        found = shelf.find(seq, asked)
        values = shelf.access(seq, place)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found.tolist() == [want[s].get(x, -1) for s, x in zip(seq.tolist(), asked.tolist())]
    assert [want[s][x] for s, x in zip(seq.tolist(), values.tolist())] == place.tolist()
    assert peak < 12e6, peak


def test_bits_are_selected_in_any_word():
    from eventloom.llm.eliasfano import _select_in_word
    r = np.random.default_rng(7)
    words = np.concatenate([r.integers(0, 1 << 64, 200, np.uint64), r.integers(0, 1 << 64, 50, np.uint64) & r.integers(0, 1 << 64, 50, np.uint64),
                            np.array([1, 1 << 63, 2 ** 64 - 1], np.uint64)])
    for w in words:
        places = [i for i in range(64) if int(w) >> i & 1]
        assert _select_in_word(np.full(len(places), w), np.arange(len(places))).tolist() == places


# --- 3: PII ------------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_pii(text):
    def luhn(d):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and max(map(int, m.group().split("."))) > 255
                    or kind == "card" and not (13 <= len(d) <= 19 and luhn(d))
                    or kind == "phone" and not 9 <= len(d) <= 15):
                continue
            out.append((kind, *m.span()))
    return out


def test_pii_base_spans_equal_plain_patterns():
    r = random.Random(6)
    texts = ["".join(r.choice("a.@@.1125 +-()_4é") for _ in range(r.randrange(60))) for _ in range(20_000)]
    texts += ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8.9", "4111 1111-1111 1111", "+1 (555) 010-0199.", "999.1.1.1 0001.2.3.04"]
    for t in texts:
        assert [s[:3] for s in pii.find(t) if s[0] != "iban"] == plain_pii(t), t


def test_pii_iban_and_context():
    t = "bank account DE89 3704 0044 0532 0130 00, not DE88 3704 0044 0532 0130 00; call +1 555 010 0199"
    found = {s[0]: s for s in pii.find(t)}
    assert t[found["iban"][1]:found["iban"][2]] == "DE89 3704 0044 0532 0130 00"
    assert found["phone"][3] > pii.PRIOR["phone"] > pii.find("order version +1 555 010 0199")[0][3]


def test_pii_is_linear_on_long_runs():
    import time
    began = time.time()
    for t in ("1" * 300_000, "a" * 300_000, "@" * 100_000, "+1" + " " * 200_000, "A1" * 100_000):
        pii.find(t)
    assert time.time() - began < 20


def test_pii_report_and_mask(spark):
    texts = [(1, "mail é x.y@example.org or +1 555 010 0199"), (2, None), (3, ""), (None, "10.0.0.1"), (1, "10.0.0.1")]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("spans", F.lit(0))
    got = {(r.doc_id, r.n_ip): r for r in pii.report(df).collect()}
    assert got[1, 0].spans == "email:7:22,phone:26:41"
    assert got[1, 0].base_sha256 == hashlib.sha256(b"email:7:22,phone:26:41").hexdigest()
    assert got[2, 0].base_sha256 == hashlib.sha256(b"").hexdigest() == got[3, 0].base_sha256
    assert got[None, 1].spans == got[1, 1].spans == "ip:0:8"
    masked = sorted(rows(pii.mask(df)), key=str)
    assert (1, "mail é <email> or <phone>", 0) in masked and (2, None, 0) in masked
    out = pii.mask(edge_docs(spark))
    assert out.schema.names == edge_docs(spark).columns and out.count() == len(edge_rows())
    assert pii.report(no_docs(spark)).collect() == []


# --- 4: neighbours -----------------------------------------------------------

def plain_neighbours(vectors, query, top):
    q = np.array(vectors[query], float)
    scored = sorted((-float(np.dot(np.array(v, float), q)), i) for i, v in vectors.items() if i != query)
    return [(i, -s) for s, i in scored[:top]]


def test_forest_recall_and_scores(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in df.collect()}
    found = collections.defaultdict(list)
    for r in queries.QUERIES["op4_forest"](spark, SMALL).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    assert set(found) == {i for i in vectors if i % 20 == 0}
    hits = 0
    for query, got in found.items():
        want = dict(plain_neighbours(vectors, query, 20))
        assert len(got) == 20 and got == sorted(got, key=lambda x: (-x[1], x[0]))
        hits += len(want.keys() & dict(got).keys())
        assert all(s == pytest.approx(float(np.dot(vectors[i], np.array(vectors[query], float))), abs=1e-6) for i, s in got)
    assert hits >= 0.9 * 20 * len(found)


def test_forest_edges(spark):
    rows_ = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (21, [1.0, 0.0]), (22, [1.0, 0.0]), (1, [3.0, 4.0]), (2, None),
             (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1.0, None]), (None, [1.0, 1.0]),
             (7, [-1.0, 0.5]), (7, [-1.0, 0.5]), (40, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = sorted(rows(forest.neighbours(df, top=3)))
    assert got == [(0, 1, 1, 3.0), (0, 2, 20, 1.0), (0, 3, 21, 1.0), (20, 1, 1, 3.0), (20, 2, 0, 1.0), (20, 3, 21, 1.0)]
    assert rows(forest.neighbours(df.filter("false"))) == []


def all_neighbours(vectors, top=20, every=20):
    """The nearest of every query among all vectors of its length, ties by id."""
    out = []
    for q in (i for i in vectors if i % every == 0):
        scores = [(-float((np.array(v) * np.array(vectors[q])).sum()), i) for i, v in vectors.items()
                  if i != q and len(v) == len(vectors[q])]
        out += [(q, r + 1, i, pytest.approx(-s, abs=1e-12)) for r, (s, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=lambda x: x[:2])


def units(seed, n, d, near=0):
    """Unit vectors, of which the first ``near`` hardly differ."""
    x = np.random.default_rng(seed).standard_normal((n, d))
    x[:near] = x[0] + 1e-9 * x[:near]
    return (x / np.sqrt((x * x).sum(1))[:, None]).tolist()


def test_small_tables_and_rare_lengths_lose_no_neighbour(spark, monkeypatch):
    monkeypatch.setattr(forest, "SEGMENT", 64)  # the many vectors of one length must not cut up the few of another
    vectors = dict(enumerate(units(1, 40, 8) + units(2, 300, 5)))
    df = spark.createDataFrame([(i, v) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    few = {i: v for i, v in vectors.items() if i < 40}
    for these, table in ((few, df.filter("vec_id < 40")), (vectors, df)):
        got = sorted(rows(forest.neighbours(table)), key=lambda x: x[:2])
        assert got == all_neighbours(these)
    segments, _ = forest._blocks(forest.usable(df).withColumn("id", F.col("vec_id")), 64, "segment")
    assert [r.n for r in segments.filter("d = 8").selectExpr("size(segment_k1) n").collect()] == [40]


@pytest.mark.parametrize("small", [0, 4096])
def test_near_copies_do_not_end_the_ascent(monkeypatch, small):
    monkeypatch.setattr(forest, "SMALL", small, raising=False)
    x = np.array(units(3, 900, 16, near=15))
    q, found, _ = forest.Forest(x, 1.0).search(x[:3], 21)
    assert np.bincount(q).tolist() == [21] * 3
    for i in range(3):
        want = np.argsort(-(x @ x[i]))[:21]
        assert len(set(want) & set(found[q == i])) >= 19


def test_equal_scores_are_cut_by_id(spark):
    signs = np.random.default_rng(4).choice([-1.0, 1.0], (400, 24))
    signs[:, :10] = 1.0
    signs[0] = [1.0] * 10 + [0.0] * 14  # scores 10 with all
    vectors = dict(enumerate(signs.tolist()))
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>").filter("vec_id = 0 or vec_id % 20 != 0")
    vectors = {i: v for i, v in vectors.items() if i == 0 or i % 20}
    got = sorted(rows(forest.neighbours(df)), key=lambda x: x[:2])
    assert got == all_neighbours(vectors) and [r[2] for r in got] == [*range(1, 20), 21]


# --- 5 and 7: classifiers ----------------------------------------------------

def auc(scored, truth):
    pairs = sorted((s, truth[i]) for i, s in scored.items() if i in truth)
    pos = sum(y for _, y in pairs)
    ranks = sum(k + 1 for k, (_, y) in enumerate(pairs) if y)
    return (ranks - pos * (pos + 1) / 2) / (pos * (len(pairs) - pos))


@pytest.mark.parametrize("name,label,least", [("op5_quality", "quality", 0.95), ("op7_toxicity", "toxic", 0.8)])
def test_held_out_accuracy(spark, name, label, least):
    big = "/root/testdata/sf0.1"
    got = queries.QUERIES[name](spark, big).collect()
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{big}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{big}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert auc({r.doc_id: r.score for r in got if r.held_out}, truth) >= least


@pytest.mark.parametrize("op", [quality, toxicity])
def test_classifier_edges(spark, op):
    docs, lab = edge_docs(spark), labels(spark)
    got = op.report(docs, lab).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
    assert op.report(no_docs(spark), lab).collect() == []
    for none in (lab.filter("false"), lab.filter("toxic = 1 and quality = 1")):
        assert len({round(r.score, 6) for r in op.report(docs, none).collect()}) == 1


def test_scores_do_not_see_labels_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    lab = spark.read.parquet(f"{SMALL}/labels.parquet")
    out = toxicity.fold(F.col("doc_id"), 5) == 0
    flipped = lab.withColumns({c: F.when(out, 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
    for op in (quality, toxicity):
        assert some(op.report(docs, lab)) == some(op.report(docs, flipped))


@pytest.mark.parametrize("clean_words", [600, 3000])
def test_rare_words_of_toxic_texts_only_are_found(spark, clean_words):
    r, vocabulary = random.Random(11), prose(12, 400).split()
    ids = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5]
    docs, lab = [], []
    for n, i in enumerate(ids[:300]):
        text = r.choices(vocabulary, k=30 if n < 30 else clean_words)
        if n < 12:  # one use in each of 12 texts
            text[7] = "zwack"
        docs.append((i, " ".join(text)))
        lab.append((i, int(n < 30)))
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame(lab, "doc_id long, toxic int"))
    assert hash_words("zwack")[0] in model.hashes
    assert not set(hash_words(" ".join(vocabulary))) & set(model.hashes)


def plain_segments(scores):
    """Maximal-scoring segments by their recursive definition."""
    def split(a, b):
        best = max(((sum(scores[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
        if best[0] <= 1e-12:
            return []
        i = -best[2]
        j = i - best[1]
        return split(a, i) + [(i, j, best[0])] + split(j, b)
    return split(0, len(scores))


def test_segments_equal_the_definition():
    r = random.Random(8)
    for _ in range(300):
        n = r.randint(0, 25)
        score = [r.choice([0.0, 0.0, 0.0, 0.7, 1.3, 2.1]) + r.random() * 1e-3 for _ in range(n)]
        place = [i for i in range(n) if score[i] > 0.5]
        got = toxicity.segments(place, [score[i] for i in place])
        want = plain_segments([score[i] if score[i] > 0.5 else -toxicity.DRIFT for i in range(n)])
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


# --- 6: licenses -------------------------------------------------------------

def plain_licenses(text):
    w, out = words(text), []
    for phrase, label in license.BASE.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    starts = [i for i, _ in out]
    return (len(w), len(out), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in out})))


def test_license_base_equals_plain_search(spark):
    extra = ["MIT License mit license. CC-BY cc by", "gnu general public", "GNU General Public License version 3",
             "the apache licensed apache license", "cc", "cc by cc by gnu gnu general public license"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")).unionByName(
        edge_docs(spark).select("doc_id", "text"))
    got = license.report(docs).collect()
    texts = docs.collect()
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == \
        sorted(((d.doc_id, *plain_licenses(d.text)) for d in texts), key=key)
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)
    assert license.report(no_docs(spark)).collect() == []


def test_license_diagonals_merge_over_a_missing_word(spark):
    whole = dict((b, a) for a, b in license.NOTICES)
    long = next(t for t in whole if whole[t] == "bsd")
    cut = " ".join(w for w in long.split() if w != "binary")
    got = {r.doc_id: r for r in license.report(spark.createDataFrame(
        [(1, prose(1, 30) + " " + long), (2, cut), (3, "redistribution and use"), (4, cut + " " + prose(2, 9) + " " + long)],
        "doc_id long, text string")).collect()}
    assert got[1].labels == got[2].labels == got[4].labels == "bsd" and got[3].labels == ""
    assert got[1].score == 1.0 > got[2].score >= license.SHARE


def test_license_repeats_do_not_swallow_a_notice(spark):
    apache = "Licensed under the Apache License, Version 2.0"
    texts = ["CC BY, CC BY, CC BY-NC 4.0", apache + ", 2.0, 2.0, 2.0", "cc by cc by cc by nc 4", "CC BY-NC 4.0, 4.0, 4.0"]
    got = {r.doc_id: r.labels for r in license.report(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: "cc-by,cc-by-nc", 1: "apache,apache-2.0", 2: "cc-by", 3: "cc-by,cc-by-nc"}


# --- 8: decontamination -------------------------------------------------------

def plain_hits(text, benchmark):
    w = words(text)
    hit, found = set(), set()
    for i, t in benchmark:
        v = words(t)
        n = min(10, len(v))
        if not n:
            continue
        wins = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)}
        for k in range(len(w) - n + 1):
            if tuple(w[k:k + n]) in wins:
                hit.update(range(k, k + n))
                found.add(i)
    ids = ",".join(sorted(str(i) for i in found if i is not None))  # an item without an id counts, but isn't listed
    return len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def test_decontamination_equals_plain_windows(spark):
    docs, bench = edge_docs(spark), items(spark)
    got = sorted((tuple(r) for r in decontam.report(docs, bench).collect()), key=str)
    b = [(r.item_id, r.text) for r in bench.collect()]
    assert got == sorted(((d, *plain_hits(t, b)) for d, t, _ in edge_rows()), key=str)
    assert decontam.report(no_docs(spark), bench).collect() == []
    assert all(r.n_hit == 0 for r in decontam.report(docs, bench.filter("false")).collect())


def test_decontamination_without_broadcast_or_bitmap(spark, monkeypatch):
    docs, bench = edge_docs(spark), items(spark)
    want = some(decontam.report(docs, bench))
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", -1)
    real = decontam.fingerprint_bitmap
    monkeypatch.setattr(decontam, "fingerprint_bitmap", lambda w: (np.full_like(real(w)[0], 2 ** 64 - 1), real(w)[1]))
    assert some(decontam.report(docs, bench)) == want


def test_clean_drops_only_documents_with_full_windows(spark):
    docs, bench = edge_docs(spark), items(spark)
    kept = decontam.clean(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {3, 4, None, 5, 6, 7, 8, 10, 11}


def test_clean_drops_copies_of_short_items(spark):
    r, vocabulary = random.Random(13), prose(14, 300).split()
    five, nine, pair = "who painted the red door", "name the three rivers that meet at the coast", " ".join(vocabulary[:2])
    docs = [(i, " ".join(r.choices(vocabulary, k=2000))) for i in range(60)]
    docs[3] = (3, docs[3][1] + " " + five)
    docs[4] = (4, nine.upper() + ". " + docs[4][1])
    docs[5] = (5, docs[5][1] + " " + five.replace("red", vocabulary[9]))  # no copy
    bench = [(1, five), (2, nine), (3, vocabulary[5]), (4, pair)]  # a word and a pair that meet by chance
    kept = decontam.clean(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(bench, "item_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(60) if i not in (3, 4)]


def test_copies_of_a_corpus_drop_the_same_documents(spark):
    r, vocabulary = random.Random(15), prose(16, 200).split()
    texts = [" ".join(r.choices(vocabulary, k=300)) for _ in range(40)]
    triple = " ".join(vocabulary[:3])
    texts[7] += f" {triple}"
    texts[8] += " what is the name of it"
    bench = spark.createDataFrame([(1, triple), (2, "what is the name of it"), (3, vocabulary[9])], "item_id long, text string")

    def dropped(copies):
        df = spark.createDataFrame([(n * 100 + i, t) for n in range(copies) for i, t in enumerate(texts)], "doc_id long, text string")
        kept = {x.doc_id for x in decontam.clean(df, bench).collect()}
        return {(n, i) for n in range(copies) for i in range(40) if n * 100 + i not in kept}
    once = {i for _, i in dropped(1)}
    assert {7, 8} <= once and len(once) < 10
    assert dropped(10) == {(n, i) for n in range(10) for i in once}


def test_items_without_an_id_hit_and_rows_of_one_id_are_judged_apart(spark):
    text = prose(17, 40)
    docs = spark.createDataFrame([(1, text), (1, prose(18, 40)), (2, prose(19, 40)), (None, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(None, " ".join(text.split()[5:17])), (5, " ".join(text.split()[6:18]))], "item_id long, text string")
    got = {(r.doc_id, r.n_hit, r.n_items) for r in decontam.report(docs, bench).collect()}
    assert got == {(1, 13, 2), (1, 0, 0), (2, 0, 0), (None, 13, 2)}
    assert sorted((r.doc_id, r.text) for r in decontam.clean(docs, bench).collect()) == [(1, prose(18, 40)), (2, prose(19, 40))]


# --- 9: BPE --------------------------------------------------------------------

def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(queries.tokenizer_path())
    r = random.Random(9)
    texts = [t for _, t, _ in edge_rows()] + [x.text for x in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts += ["".join(r.choice("abcdeitnosr \n'\t.,1234éßñ中文字кир̀😀ABCtheing") for _ in range(200)) for _ in range(300)]
    texts += ["".join(chr(r.choice([r.randrange(1, 0x250), r.randrange(0x250, 0xD7FF), r.randrange(0x1F300, 0x1F700)]))
                      for _ in range(60)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit(1))
    got = {x.doc_id: x for x in bpe.round_trip(df, queries.tokenizer_path()).collect()}
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), t
        assert got[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    assert bpe.round_trip(no_docs(spark), queries.tokenizer_path()).collect() == []


def test_bpe_results_do_not_depend_on_the_cache(monkeypatch):
    spec = open(queries.tokenizer_path(), "rb").read()
    text = prose(11, 400)
    want = bpe.Encoder(spec).encode(text)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    enc = bpe.Encoder(spec)
    assert enc.encode(text) == want and enc.decode(want) == text and len(enc) <= 4


# --- 10: near-duplicates -------------------------------------------------------

def bag(text):
    w = words(text)
    return collections.Counter() if not w else collections.Counter(
        [tuple(w)] if len(w) < 5 else zip(*[w[i:] for i in range(5)]))


def plain_classes(docs):
    parent = {i: i for i in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    bags = {i: bag(t) for i, t in docs.items()}
    for a, b in itertools.combinations(sorted(docs), 2):
        met, both = sum((bags[a] & bags[b]).values()), sum((bags[a] | bags[b]).values())
        if met and met >= 0.8 * both:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in docs}


def near_docs():
    base, r, out = prose(21, 120).split(), random.Random(3), {}
    for i in range(60):
        w = list(base)
        for _ in range(i % 5):
            w[r.randrange(len(w))] = f"edit{i}"
        out[i] = " ".join(w)
    for i in range(60, 100):
        out[i] = prose(i, 40) + (" " + " ".join(base[:20]) if i % 2 else "")
    out |= {100: "alone", 101: "alone", 102: "", 103: None, 104: "", 105: "again " * 200, 106: "again " * 190, 107: "again " * 120}
    return out


def test_near_classes_equal_all_pairs(spark):
    docs = near_docs()
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").withColumn("n", F.lit(1)).repartition(5)
    got = {r.doc_id: r.class_id for r in bagminhash.report(df).collect()}
    assert got == plain_classes(docs)
    kept = {r.doc_id for r in bagminhash.clean(df).collect()}
    assert kept == set(plain_classes(docs).values()) and bagminhash.clean(df).columns == df.columns


def test_near_classes_edges(spark):
    got = collections.defaultdict(set)
    for r in bagminhash.report(edge_docs(spark)).collect():
        got[r.doc_id].add(r.class_id)
    assert got[1] == got[2] == got[9] == {1} and got[3] == {3} and got[4] == {4} and len(got[None]) == 2
    assert bagminhash.report(no_docs(spark)).collect() == []
    kept = [r.doc_id for r in bagminhash.clean(edge_docs(spark)).collect()]
    assert sorted(kept, key=str) == sorted([1, 3, 4, None, None, 5, 6, 7, 8, 10, 11], key=str)


def test_signatures_estimate_weighted_jaccard():
    r = np.random.default_rng(0)
    for keep in (0.3, 0.8):
        est, true = [], []
        for _ in range(60):
            a = r.integers(1, 9, 200)
            b = np.where(r.random(200) < keep, a, r.integers(1, 9, 200))
            e = r.integers(0, 1 << 44, 200).astype(np.uint64)
            s = bagminhash.signatures(np.repeat([0, 1], 200), np.concatenate([e, e]), np.concatenate([a, b]), 2)
            est.append(np.mean(s[0] == s[1]))
            true.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        assert np.mean(est) == pytest.approx(np.mean(true), abs=0.015)


# --- pipeline ------------------------------------------------------------------

def test_pipeline_stages_against_plain_versions(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    at = docs
    texts = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in P.STAGES[:4]:
        out = stage(spark, at, SMALL)
        assert out.columns == docs.columns
        out = spark.createDataFrame(out.collect(), out.schema)
        now = {r.doc_id: r.text for r in out.collect()}
        if name == "toxicity":
            bad = {r.doc_id for r in queries.QUERIES["op7_toxicity"](spark, SMALL).collect() if r.predicted}
            assert now.keys() == texts.keys() - bad
        elif name == "near_dedup":
            assert now.keys() == set(plain_classes(texts).values())
        elif name == "decontamination":
            bench = duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
            assert now.keys() == {i for i, t in texts.items() if not plain_hits(t, [b for b in bench if len(words(b[1])) >= 10])[4]}
        else:
            assert now == {i: pii.replace(t, pii.find(t)) for i, t in texts.items()}
        texts, at = now, out
    want = some(bpe.round_trip(at, queries.tokenizer_path()))
    assert some(P.run(spark, SMALL)) == want


def test_pipeline_on_edges(spark, tmp_path):
    import corpus_pipeline as P
    for n, docs in enumerate((edge_docs(spark), no_docs(spark))):
        folder = str(tmp_path / str(n))
        docs.write.parquet(f"{folder}/documents.parquet")
        labels(spark).write.parquet(f"{folder}/labels.parquet")
        items(spark).write.parquet(f"{folder}/benchmark.parquet")
        got = P.run(spark, folder)
        assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert got.count() <= docs.count()
