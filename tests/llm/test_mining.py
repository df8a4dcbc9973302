"""Hard negatives, page wrappers and collocations against plain versions."""

import collections
import html
import io
import math
import re
import tracemalloc
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from eventloom.llm import covertree, phrases, wrapper
from eventloom.llm import words as word_hashes
from llm.data import SMALL, edge_docs, no_docs, prose


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- 11: hard negatives ------------------------------------------------------

def plain_negatives(table):
    """``table``: (vec_id, embedding, label)."""
    best = {}
    for i, v, lab in table:
        if i is None or v is None or lab is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        lab = int(math.fmod(lab + 1, 10)) if i % 7 == 0 else lab
        row = (lab, [math.floor(256 * x) for x in v])
        best[i] = min(best.get(i, row), row)
    out = []
    for a, (lab, v) in best.items():
        if a % 50:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in best.items() if i != a and len(w) == len(v)}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if best[i][0] == lab][:5]:
            hard = [i for i in order if best[i][0] != lab and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(a, p, r, i, score[p], score[i]) for r, i in enumerate(hard[:3], 1)]
    return sorted(out)


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_hard_negatives_with_edges(spark):
    r = np.random.default_rng(3)
    centres = r.normal(size=(6, 8))
    table = [(i, [float(x) for x in (centres[i % 6] + r.normal(size=8) * 0.3).astype(np.float32)], i % 4) for i in range(260)]
    table += [(i, table[100][1], i % 3) for i in range(260, 330)]  # copies: ties go to the smaller id
    table += [(400, None, 1), (450, [1.0, None], 1), (None, [1.0] * 8, 1), (500, [float("nan")] * 8, 2), (550, [0.0] * 8, 2),
              (551, [0.0] * 8, 2), (600, [0.5] * 3, 1), (601, [0.5] * 3, 1), (602, [0.25, 0.5, 0.3], 2), (650, [], 1), (651, [], 1),
              (652, [], 2), (50, [9.0] * 8, 9), (700, [1.0] * 8, None), (100, table[100][1], 0), (-50, table[7][1], -3), (-49, table[8][1], -11)]
    df = spark.createDataFrame(table, SCHEMA).selectExpr("*", "1 score", "2 rank", "'x' pack", "3 d")
    assert sorted(rows(covertree.mine(df))) == plain_negatives(table)
    assert rows(covertree.mine(df.filter("false"))) == []


def test_hard_negatives_over_many_trees_and_groups(spark, monkeypatch):
    for name, value in (("SEGMENT", 60), ("GROUP", 2), ("SLOTS", 2)):
        monkeypatch.setattr(covertree, name, value)
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    index = covertree.Index(df, every=50)
    assert index.trees.count() > 5 and index.pairs > 10
    table = [(x.vec_id, list(x.embedding), x.label) for x in df.collect()]
    assert sorted(rows(covertree.mine(df))) == plain_negatives(table)


@pytest.mark.parametrize("kind", ["random", "clustered", "copies", "line", "huge"])
def test_cover_tree_searches_equal_brute_force(kind):
    r = np.random.default_rng(5)
    x = {"random": r.integers(-300, 300, (400, 16)), "clustered": r.integers(-300, 300, (9, 16))[r.integers(0, 9, 400)] + r.integers(-9, 9, (400, 16)),
         "copies": np.repeat(r.integers(-300, 300, (2, 16)), 200, 0), "line": np.arange(400)[:, None] * np.ones((1, 16), np.int64),
         "huge": r.integers(-2 ** 28, 2 ** 28, (400, 16))}[kind].astype(np.int64)
    ids, labels = r.permutation(400), r.integers(0, 5, 400)
    tree = covertree.CoverTree.build(x, ids, labels)
    # nets: rows of a level stand apart and lie within the covering angle of their parents
    fields = np.load(io.BytesIO(tree.pack()))
    tree = covertree.CoverTree(**{f: fields[f] for f in tree.FIELDS})
    assert sorted(tree.ids.tolist()) == list(range(400))
    shares = []
    for a in range(0, 400, 9):
        exact = x.astype(object) @ x[a].astype(object)
        order = sorted(range(400), key=lambda i: (-exact[i], ids[i]))
        (got,), seen = tree.search(x[a], ids[a], labels[a], [-np.inf], [np.inf], 5, True)
        assert got == [(exact[i], ids[i]) for i in order if labels[i] == labels[a] and ids[i] != ids[a]][:5]
        low, high = int(exact[order[40]]) // 2, int(exact[order[40]])
        (got,), more = tree.search(x[a], ids[a], labels[a], [low], [high], 3, False)
        assert got == [(exact[i], ids[i]) for i in order if labels[i] != labels[a] and low <= exact[i] <= high][:3]
        shares.append(seen / 400)
    if kind == "clustered":
        assert np.mean(shares) < 0.6  # subtrees outside are skipped


def test_components_past_64_bits_are_an_error(spark):
    df = spark.createDataFrame([(0, [1e30], 1), (1, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="64 bits"):
        covertree.mine(df).collect()


# --- 12: pages ---------------------------------------------------------------

def plain_article(page):
    m = re.search(r"<article>(.*?)(</article>|<footer>|$)", page or "", re.S)
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?p>|</?h1>", m[1])] if m else []
    return "\n\n".join(b for b in blocks if b)


def test_main_text_of_the_given_pages(spark):
    df = spark.read.parquet(f"{SMALL}/pages.parquet")
    want = sorted((p.page_id, p.url, plain_article(p.html), len(plain_article(p.html))) for p in df.collect())
    assert sorted(rows(wrapper.extract(df))) == want


def site(n):
    """Pages without an article element: the wrapper has to find it."""
    out = []
    for i in range(n):
        body, want = "", [f"Title {prose(i, 4)}"]
        for j in range(2 + i % 5):
            text = prose(1000 + 10 * i + j, 25)
            want.append(text)
            body += (f"<p>{text}", f"<p>{text}</p>", f"<blockquote>{text}</blockquote>", f"<h2>{text}</h2>")[(i + j) % 4]
        notes = "".join(f"<div class='comment'><p>{prose(5000 + 7 * i + j, 30)}</p></div>" for j in range(i % 3))
        out.append((i, f"http://site.example/{i}", f"""<html><head><title>x</title></head><body>
<div class="cookie-notice">We use cookies {i}</div><div id="top"><a href=/>Home</a> <a href=/b>About</a></div>
<div class=wrap><div class="content has-sidebar"><h1>{want[0]}</h1>{body}</div>
<div id=sidebar><h3>Popular</h3><ul><li><a href=x>{prose(i + 9, 5)}</a></li></ul></div></div>
<div class=comments><h3>Comments</h3>{notes}</div><form><p>Sign up {i}</p></form>
<div class=bottom>All rights reserved by the publisher of this site.</div><script>var x="<p>{i}";</script>""", "\n\n".join(want)))
    return out


def test_wrappers_find_the_article_among_the_rest(spark, monkeypatch):
    pages = site(30)
    df = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")
    want = {p[0]: p[3] for p in pages}
    assert {r.page_id: r.text for r in wrapper.extract(df).collect()} == want
    # in many small groups, and dealt to partitions in another way
    monkeypatch.setattr(wrapper, "GROUP", 4)
    monkeypatch.setattr(wrapper, "FAN", 2)
    assert {r.page_id: r.text for r in wrapper.extract(df.repartition(7)).collect()} == want


def test_wrapper_is_a_union_free_expression():
    shapes = [wrapper.folded(wrapper.parse(p)) for p in (
        "<div><p>a</p><p>b</p></div>", "<div><h2>t</h2><p>a</p></div>", "<ul><li>x<li>y</ul><div><p>a</p></div>",
        "<div><dl><dt>a<dd>b<dt>c<dd>d</dl></div>")]
    for s in shapes:
        for t in wrapper.texts(s):
            t.data = [[1, 1, 0, 0, 1, 0, 1]]
    got = wrapper.regex(wrapper._aligned(shapes))
    assert got == ("<html>(<ul>(<li>TEXT</li>)+</ul>)?(<div>(<h2>TEXT</h2>)?(<p>TEXT</p>)+</div>)?"
                   "(<div><dl>((<dt>TEXT</dt>)?(<dd>TEXT</dd>)?)+</dl></div>)?</html>")


def test_main_text_of_odd_pages(spark):
    odd = [(1, "http://a/", None), (2, "http://a/", ""), (3, None, "<p>one<p>two &amp; &lt;b&gt;&nbsp; three"), (4, "::", "plain text"),
           (5, "http://b/", "<div>" * 3000 + "deep"), (6, "http://c/", "<p>" + "word " * 200_000), (None, "http://a/", "<article><p>x</p></article>"),
           (7, "http://a/", "<article><p>x</p></article>"), (7, "http://a/", "<article><p>x</p></article>"), (8, "http://d/", "<p title='a>b'>t</p><p"),
           (9, "http://e/", "<nav>menu</nav><!-- <p>no</p> -->"), (10, "http://e/", "<li>a<li>b<td>c<td>d</p></div>")]
    df = spark.createDataFrame(odd, "page_id long, url string, html string").selectExpr("*", "'t' text", "1 n_chars", "'k' kept", "'h' host")
    got = collections.Counter((r.page_id, r.text) for r in wrapper.extract(df).collect())
    assert got == collections.Counter([
        (1, ""), (2, ""), (3, "one\n\ntwo & <b> three"), (4, "plain text"), (5, "deep"), (6, ("word " * 200_000).strip()), (None, "x"),
        (7, "x"), (7, "x"), (8, "t"), (9, ""), (10, "a\n\nb\n\nc\n\nd")])
    assert rows(wrapper.extract(df.filter("false"))) == []


def test_copies_are_no_boilerplate(spark):
    odd = "<article><h1>only here</h1><aside>x</aside><blockquote>quoted once</blockquote></article>"
    pages = [(i, "http://h/", odd) for i in range(20)] + [
        (100 + i, "http://h/", f"<article><h1>{prose(i, 5)}</h1><p>{prose(50 + i, 20)}</p></article>") for i in range(6)]
    got = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[i] == "only here\n\nquoted once" for i in range(20))


# --- 13: collocations --------------------------------------------------------

def plain_phrases(docs):
    low = {c: c + 32 for c in range(65, 91)}
    f, n = collections.Counter(), collections.Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(low)):
            w = re.findall(r"[^\x20\x09]+", piece)
            lang = "und" if lang is None else lang
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2 or a < 10:
            continue
        if any(100 * b >= 50 * a for (g, q), b in f.items() if g == lang and len(q) == 3 > len(p) and b >= 10 and p in (q[:2], q[1:])):
            continue
        score, k = min((math.floor(Fraction(1_000_000 * a * a, f[lang, p[:k]] * f[lang, p[k:]])), k) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranked, last = [], None
    for r in out:
        rank = rank + 1 if r[0] == last else 1
        last = r[0]
        if rank <= 2000:
            ranked.append((r[0], rank, *r[1:]))
    return sorted(ranked)


def phrase_docs(spark):
    words = prose(4, 12).split()
    text = lambda s: " ".join(words[(s * 7 + i * i + i // 3) % 12] + ("" if i % 5 else ",") for i in range(60))
    table = [(i, text(i) if i % 9 else None, ["en", "fr", None][i % 3]) for i in range(60)]
    table += [(100 + i, "New YORK city. Les\tété  中文 new york\x0bcity New York State", "en") for i in range(14)]
    table += [(None, "New York", "en"), (200, "", "en"), (201, "a " * 30_000, "de"), (202, "A b! a B? a b; a,b:a b\na b\r" * 12, None),
              (203, "x\x00y z\x1c\xa0w " * 20, ""), (204, " \t ", "fr")]
    return spark.createDataFrame(table, "doc_id long, text string, lang string").selectExpr("*", "1 n", "2 len", "'p' phrase", "3 shard")


def test_phrases_equal_plain_counts(spark):
    df = phrase_docs(spark)
    want = plain_phrases([(r.lang, r.text) for r in df.collect()])
    assert sorted(rows(phrases.report(df))) == want and len(want) > 50
    assert rows(phrases.report(no_docs(spark))) == []
    phrases.report(edge_docs(spark)).collect()


def test_phrases_do_not_depend_on_shards_or_crowded_maps(spark, monkeypatch):
    df = phrase_docs(spark)
    want = plain_phrases([(r.lang, r.text) for r in df.collect()])
    counter = phrases.Counter(df, shards=5)
    got = {(r.lang, r.phrase): r.f for r in counter.frequencies().collect()}
    assert all(got[r[0], r[2]] == r[3] for r in want)
    assert 5 < counter.scans <= 15  # longer phrases start within the first cycle
    monkeypatch.setattr(phrases, "CELLS", 64)  # every cell is shared: more is counted, nothing else changes
    assert sorted(rows(phrases.report(df))) == want


def test_a_late_phrase_completes_its_cycle(spark):
    """Pairs that only get frequent in the last shard are counted in all of them."""
    counter = phrases.Counter(spark.createDataFrame([(i, "rare pair here", "en") for i in range(11)], "doc_id long, text string, lang string"))
    assert {(r.phrase, r.f) for r in counter.frequencies().collect()} == {
        (p, 11) for p in ("rare", "pair", "here", "rare pair", "pair here", "rare pair here")}


def test_phrases_hold_little_of_a_batch(monkeypatch):
    """Scans and naming take a batch in runs of texts, and give equal names of many runs once."""
    texts = [prose(i, 200) + " Same words everywhere" for i in range(64)] * 100
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})
    h = phrases._Chunk(batch.slice(0, 64)).phrases(1)[1]
    maps = {1: phrases.Map(np.concatenate([h & np.uint64(phrases.CELLS - 1), h >> np.uint64(64 - phrases.BITS)]),
                           np.full(2 * len(h), 2, np.uint16))}
    for step in (phrases._scanner(0, 2, {}, 16), phrases._namer(maps)):
        monkeypatch.setattr(word_hashes, "_POW", np.ones(1, np.uint64))
        monkeypatch.setattr(word_hashes, "_INV", np.ones(1, np.uint64))
        tracemalloc.start()
        try:
            found = list(step(iter([batch])))
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
        assert peak < 70e6, peak
    named = pa.Table.from_batches(found).to_pylist()
    want = collections.Counter(w for t in texts for w in t.lower().split())
    assert len(named) == len(want) + 1 and {r["phrase"]: r["n"] for r in named if r["len"]} == want


def test_phrases_send_workers_few_rows_at_once(spark, monkeypatch):
    scanner, namer = phrases._scanner, phrases._namer

    def few(step):
        def run(batches):
            def checked():
                for batch in batches:
                    assert batch.num_rows <= 1000, batch.num_rows
                    yield batch
            yield from step(checked())
        return run

    monkeypatch.setattr(phrases, "_scanner", lambda *a: few(scanner(*a)))
    monkeypatch.setattr(phrases, "_namer", lambda *a: few(namer(*a)))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = spark.range(5000).selectExpr("id doc_id", "'one two' text", "'en' lang").coalesce(1)
    assert {(r.phrase, r.f) for r in phrases.Counter(df).frequencies().collect()} == {(p, 5000) for p in ("one", "two", "one two")}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_scores_past_64_bits_are_exact(spark):
    big = 4_000_000_000_000
    f = [("en", 1, "a", big + 3), ("en", 1, "b", big + 7), ("en", 2, "a b", big)]
    (r,) = phrases.candidates(spark.createDataFrame(f, "lang string, len int, phrase string, f long")).collect()
    assert r.score == 1_000_000 * big * big // ((big + 3) * (big + 7))
