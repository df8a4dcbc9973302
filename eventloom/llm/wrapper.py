"""Main text of web pages: wrappers inferred as union-free regular expressions.

Pages of a host share templates. A page is read as a stream of block tags and
text (inline tags, scripts and styles go), and its stream is folded: runs of
alike siblings become repeated groups. Pages that fold alike have one *shape*.
A host's shapes are then aligned one after another, the most frequent first:
siblings that match are merged, siblings that one side lacks become optional,
adjacent repeats become repeated groups, and text becomes a slot that knows how
often, how long, how linked and how constant it is. The result, the host's
wrapper, is a union-free regular expression: tags, text slots, options and
repeats, no alternatives. A list of more than ``WIDTH`` siblings becomes one
repeated group of optional members.

The wrapper says which slots are the article: those in its ``article`` (else
``main``, else the innermost element that holds most of the free text), outside
elements whose tag, role, class or id speaks of menus, headers, footers,
sidebars, notices, adverts, forms or comments, which are neither mostly links
nor the same text on most pages of the host. Each shape is aligned with its
host's wrapper once, and its pages' texts picked by slot.

Pages are parsed where they lie. Per host and shape only sums, and the least
and greatest hash of each slot's text, are shuffled. Shapes of a host are
aligned in groups of at most about ``GROUP``, and the groups' wrappers in turn,
so neither a hot host nor one with many shapes meets in one task. The result
depends on the host's pages alone, not on how they are stored.

Null and empty html gives an empty text, a page without a host in its url
shares a wrapper with the others of that kind. Repeated pages each give a row;
copies are no evidence that a text is boilerplate. Long pages are read whole;
elements nested deeper than ``DEPTH`` count as their parents' own. Broken
markup is read as browsers read it, roughly: unclosed paragraphs, cells and
items end where the next begins, stray end tags are ignored. An empty table
gives no rows; only page_id, url and html are read.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import materialise, per_chunk
from eventloom.operators.joins import broadcast_if_small

WIDTH, DEPTH, GROUP, FAN = 64, 200, 256, 16
#: A slot is boilerplate if its text is the same on this share of a host's pages, three at least.
SAME, PAGES = 0.5, 3
#: A slot is navigation if this share of its characters is linked.
LINKED = 0.8
#: The article's element holds this share of the free text of its parent.
HOLDS = 0.6

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section
summary table tbody td tfoot th thead title tr ul""".split())
#: Elements whose content is not read as markup, and those that are no text of a page.
RAW = frozenset("script style textarea title xmp iframe noembed noframes template svg noscript".split())
DROPPED = frozenset("""head nav header footer aside form menu dialog title button select option label canvas object
audio video map""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an opening tag ends, up to which ancestors.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
#: Words of a role, class or id that mark what isn't the article.
HINTS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar
sidebars aside complementary widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs header masthead
topbar footer contentinfo copyright cookie cookies consent gdpr notice notices alert popup modal overlay newsletter
subscribe subscription signup login share sharing social related recommended recommendations comment comments disqus
replies reply respond pagination pager toolbar search form disclaimer hidden paywall""".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<([/]?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[a-zA-Z/!?][^>]*>?""", re.S)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def _key(tag: str, attrs: str) -> str:
    """An element's name: its tag, then the words of its role, class and id, digits left out."""
    words = set()
    for name, value in _ATTR.findall(attrs) if attrs.strip() else ():
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "style":
            if re.search(r"display\s*:\s*none", value):
                words.add("hidden")
        elif name in ("hidden", "aria-hidden"):
            if value != "false":
                words.add("hidden")
        else:
            words.update(w for w in re.split(r"[^a-z]+", re.sub(r"\b(?:has|no|with|without)[-_]\w+", " ", value)) if w)
    return ".".join([tag, *sorted(words)])


class Node:
    """An element (or text, ``#``, or a group of siblings, ``()``) of a page, shape or wrapper.

    ``opt``: may be missing; ``rep``: may repeat. ``data`` of a text: its blocks
    on a page, its numbers in a shape, its sums in a wrapper."""

    __slots__ = ("key", "opt", "rep", "kids", "data", "keep")

    def __init__(self, key: str, opt: bool = False, rep: bool = False, kids: list | None = None, data: list | None = None):
        self.key, self.opt, self.rep, self.kids, self.data, self.keep = key, opt, rep, kids or [], data, False

    @property
    def tag(self) -> str:
        return self.key.split(".", 1)[0]

    def keys(self) -> set:
        return {k.key for k in self.kids}


def parse(page: str) -> Node:
    """A page as a tree of block elements and texts, numbered in page order."""
    root = Node("html")
    stack, text, links, linked, muted, number = [root], [], 0, 0, [], 0
    at, n = 0, len(page)

    def flush() -> None:
        nonlocal links, number
        if text:
            block = " ".join(entities.unescape("".join(text)).split())
            if block and not any(x.tag in DROPPED for x in stack):
                stack[-1].kids.append(Node("#", data=[(number, block, min(links, len(block)))]))
                number += 1
            text.clear()
        links = 0

    def close(names: set, within: set) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return
            if stack[i].tag in within:
                return

    while at < n:
        m = _TAG.search(page, at)
        to = m.start() if m else n
        if to > at and not muted:
            text.append(page[at:to])
            links += (to - at) * (linked > 0)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        end, tag = m[1] == "/", m[2].lower()
        if tag in RAW and not end:
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else n
            continue
        if tag not in BLOCKS:
            if tag == "br" and not muted:
                text.append(" ")
            elif tag == "a":
                linked = 0 if end else 1
            if tag not in VOID and not m[3].endswith("/"):
                if end and muted and tag in muted:
                    del muted[muted.index(tag):]
                elif not end and (muted or tag in DROPPED or HINTS & set(_key(tag, m[3]).split(".")[1:])):
                    muted.append(tag)
            continue
        flush()
        muted.clear()
        linked = 0
        if end:
            close({tag}, set())
        else:
            if stack[-1].tag == "p":
                stack.pop()
            if any(x.tag == "head" for x in stack):
                close({"head"}, set())
            if tag in ENDS:
                close(*ENDS[tag])
            if tag in ("html", "body", "hr"):
                continue
            node = Node(_key(tag, m[3]))
            if len(stack) < DEPTH:
                if not any(x.tag in DROPPED for x in stack):
                    stack[-1].kids.append(node)
                stack.append(node)
    flush()
    return root


# ---------------------------------------------------------------- inference

def alike(a: Node, b: Node) -> bool:
    """Whether two siblings can be one part of a wrapper."""
    if a.key == "()" or b.key == "()":
        return a.key == b.key and bool(a.keys() & b.keys())
    if a.key != b.key:
        return False
    x, y = a.keys(), b.keys()
    return a.key == "#" or "." in a.key or x == y or not x or not y or 2 * len(x & y) >= min(len(x), len(y))


def merged(a: Node, b: Node, again: bool = False) -> Node:
    """Both as one; ``again``: they stand side by side. ``a`` is used up."""
    a.opt, a.rep = a.opt and b.opt if again else a.opt or b.opt, a.rep or b.rep or again
    if a.key == "#":
        a.data = joined(a.data, b.data)
    elif a.key == "()":
        a.kids = _members(a.kids + b.kids)
    elif b.kids:
        a.kids = align(a.kids, b.kids) if a.kids else b.kids
    return a


def joined(a: list, b: list) -> list:
    if a and isinstance(a[0], list):  # sums: pages, characters, linked ones, hashes of text and page
        x, y = a[0], b[0]
        return [[x[0] + y[0], x[1] + y[1], x[2] + y[2], min(x[3], y[3]), max(x[4], y[4]), min(x[5], y[5]), max(x[6], y[6])]]
    a.extend(b)
    return a


def _members(nodes: list[Node]) -> list[Node]:
    out: dict[str, Node] = {}
    for x in nodes:
        if x.key in out:
            merged(out[x.key], x)
        else:
            out[x.key] = x
            x.opt, x.rep = True, False
    return list(out.values())


def _grouped(nodes: list[Node]) -> Node:
    parts = [k for x in nodes for k in (x.kids if x.key == "()" else [x])]
    return Node("()", rep=True, opt=all(x.opt for x in nodes), kids=_members(parts))


def packed(nodes: list[Node], keys: set) -> list[Node]:
    """Runs of siblings that a repeated group can take, as such a group."""
    out, run = [], []
    for x in [*nodes, None]:
        if x is not None and (x.keys() <= keys if x.key == "()" else x.key in keys):
            run.append(x)
            continue
        if run:
            out.append(_grouped(run))
            run = []
        if x is not None:
            out.append(x)
    return out


def fold(nodes: list[Node]) -> list[Node]:
    """Repeats side by side become repeated parts."""
    out: list[Node] = []
    for x in nodes:
        if out and x.key != "#" and alike(out[-1], x):
            merged(out[-1], x, True)
        else:
            out.append(x)
    for size in (2, 3):
        i = 0
        while i + 2 * size <= len(out):
            keys = [x.key for x in out[i:i + size]]
            if "()" not in keys and keys == [x.key for x in out[i + size:i + 2 * size]]:
                out = packed(out, set(keys))
            i += 1
    if len(out) > WIDTH:
        out = [_grouped(out)]
    if len(out) == 1 and out[0].key == "()" and len(out[0].kids) > WIDTH:  # only tags and text tell members apart
        kids = out[0].kids
        for x in kids:
            x.key = x.tag if x.key != "#" else x.key
        out[0].kids = _members(kids)
    return out


def folded(node: Node) -> Node:
    node.kids = fold([folded(x) if x.kids else x for x in node.kids])
    return node


def matches(a: list[Node], b: list[Node]) -> list[tuple[int, int]]:
    """A longest common subsequence of alike siblings."""
    n, m = len(a), len(b)
    same = [[alike(x, y) for y in b] for x in a]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + 1 if same[i][j] else 0)
    out, i, j = [], 0, 0
    while i < n and j < m:
        if same[i][j] and best[i][j] == best[i + 1][j + 1] + 1:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def _both_packed(a: list[Node], b: list[Node]) -> tuple[list[Node], list[Node]]:
    for keys in [x.keys() for x in [*a, *b] if x.key == "()"]:
        a, b = packed(a, keys), packed(b, keys)
    return a, b


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """Sibling lists of two pages or wrappers as one: what only one has is optional."""
    if len(a) == len(b) == 1 and a[0].key == b[0].key == "#":
        return [merged(a[0], b[0])]
    a, b = _both_packed(a, b)
    out, i, j = [], 0, 0
    for x, y in [*matches(a, b), (len(a), len(b))]:
        for z in [*a[i:x], *b[j:y]]:
            z.opt = True
            out.append(z)
        if x < len(a):
            out.append(merged(a[x], b[y]))
        i, j = x + 1, y + 1
    return fold(out)


# ---------------------------------------------------------------- text form

def dump(node: Node, data: bool = False) -> str:
    def plain(x: Node) -> list:
        return [x.key, x.opt * 1 + x.rep * 2, x.data if data and x.key == "#" else [plain(k) for k in x.kids]]
    return json.dumps(plain(node), separators=(",", ":"))


def load(text: str, data=None) -> Node:
    """``data``: gives each text of a shape its data, in order."""
    def node(x: list) -> Node:
        if x[0] == "#":
            return Node("#", bool(x[1] & 1), bool(x[1] & 2), data=x[2] if data is None else next(data))
        return Node(x[0], bool(x[1] & 1), bool(x[1] & 2), [node(k) for k in x[2]])
    return node(json.loads(text))


def texts(node: Node) -> Iterator[Node]:
    if node.key == "#":
        yield node
    for x in node.kids:
        yield from texts(x)


def regex(node: Node) -> str:
    """The wrapper as a regular expression, for people to read."""
    inner = "".join(regex(x) for x in node.kids)
    one = {"#": "TEXT", "()": f"({inner})"}.get(node.key, f"<{node.key}>{inner}</{node.tag}>")
    return (f"({one})" if len(one) > 1 and one[0] != "(" and (node.opt or node.rep) else one) + ["", "?", "+", "*"][node.opt + 2 * node.rep]


# ---------------------------------------------------------------- the article

def _semantic(node: Node) -> bool:
    return node.tag in ("article", "main") and not HINTS & set(node.key.split(".")[1:])


def _holds(node: Node, test) -> bool:
    return test(node) or any(_holds(x, test) for x in node.kids)


def noise(node: Node) -> bool:
    if node.tag in DROPPED:
        return True
    hinted = HINTS & set(node.key.split(".")[1:])
    return bool(hinted) and node.tag != "main" and not any(_holds(x, _semantic) for x in node.kids)


def choose(root: Node) -> Node:
    """Mark the slots that are the article (``keep``), and elements whose unknown texts are."""
    free: list[Node] = []

    def walk(x: Node) -> None:
        if x.key == "#":
            free.append(x)
        elif not noise(x):
            for k in x.kids:
                walk(k)
    walk(root)
    pages = max([s.data[0][0] for s in free], default=0)
    varied = any(s.data[0][3] != s.data[0][4] for s in free)
    same = lambda d: varied and d[0] >= max(PAGES, SAME * pages) and d[3] == d[4] and d[5] != d[6]
    good = {id(s) for s in free if not same(s.data[0]) and s.data[0][2] < LINKED * max(1, s.data[0][1])}

    def mass(x: Node) -> int:
        if x.key == "#":
            return x.data[0][1] - x.data[0][2] if id(x) in good else 0
        return 0 if noise(x) else sum(mass(k) for k in x.kids)

    def find(x: Node, tag: str) -> list[Node]:
        if noise(x):
            return []
        return [x] if x.tag == tag else [y for k in x.kids for y in find(k, tag)]

    total = mass(root)
    chosen = next((found for tag in ("article", "main") if (found := find(root, tag))
                   and 4 * sum(map(mass, found)) >= total and total), None)
    if chosen is None:
        x = root
        while (inner := max((k for k in x.kids if k.key not in ("#", "()")), key=mass, default=None)) is not None \
                and mass(inner) >= HOLDS * mass(x) and not inner.rep and _holds_blocks(inner):
            x = inner
        chosen = [x]

    def mark(x: Node) -> None:
        x.keep = id(x) in good if x.key == "#" else not noise(x)
        if x.keep:
            for k in x.kids:
                mark(k)
    for x in chosen:
        mark(x)
    if not any(s.keep for s in free):
        for s in free:
            s.keep = True
    return root


def _holds_blocks(x: Node) -> bool:
    return any(k.key != "#" for k in x.kids)


def pick(shape: Node, wrapper: Node, out: set) -> None:
    """The numbers of a shape's texts that the wrapper marks as the article."""
    a, b = shape.kids, wrapper.kids
    for keys in [x.keys() for x in b if x.key == "()"]:
        a = packed(a, keys)
    if wrapper.key == "()":
        pairs = [(x, next((y for y in b if y.key == x.key), None)) for x in a]
    else:
        found = dict(matches(a, b))
        pairs = [(x, b[found[i]] if i in found else next((y for y in b if y.key == x.key), None)) for i, x in enumerate(a)]
    for x, y in pairs:
        if y is None:  # not in the wrapper: as the element it stands in
            y = choose_alone(x, wrapper.keep)
        if x.key == "#":
            out.update(x.data if y.keep else ())
        else:
            pick(x, y, out)


def choose_alone(x: Node, keep: bool) -> Node:
    y = Node(x.key, kids=[choose_alone(k, keep and not noise(x)) for k in x.kids])
    y.keep = keep and (x.key == "#" or not noise(x))
    return y


# ---------------------------------------------------------------- on Spark

def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _shape(page: str | None) -> tuple[str, str, list[Node]] | None:
    if not page:
        return None
    root = folded(parse(page))
    slots = list(texts(root))
    text = dump(root)
    return hashlib.blake2b(text.encode(), digest_size=16).hexdigest(), text, slots


STATS = "host string, shape_id string, slot int, shape string, n long, chars long, linked long, lo long, hi long, plo long, phi long"


def _stats(part: pa.RecordBatch) -> pa.RecordBatch:
    """Per host and shape of some pages, the sums of each text slot (slot -1: the shape itself)."""
    urls, pages = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("url", "html"))
    sums: dict[tuple, list] = {}
    for url, page in zip(urls, pages):
        found = _shape(page)
        if found is None:
            continue
        shape_id, text, slots = found
        host = host_of(url)
        parts = ["\n".join(b for _, b, _ in s.data) for s in slots]
        own = _hash("\n\n".join(parts))
        for i, s in enumerate([None, *slots]):
            h = _hash(parts[i - 1]) if i else 0
            one = [text if not i else None, 1, sum(len(b) for _, b, _ in s.data) if i else 0,
                   sum(k for _, _, k in s.data) if i else 0, h, h, own, own]
            old = sums.setdefault((host, shape_id, i - 1), one)
            if old is not one:
                old[1:] = [old[1] + 1, old[2] + one[2], old[3] + one[3], min(old[4], h), max(old[5], h), min(old[6], own), max(old[7], own)]
    cols = list(zip(*[(*k, *v) for k, v in sums.items()])) or [()] * 11
    types = [pa.string(), pa.string(), pa.int32(), pa.string(), *[pa.int64()] * 7]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)],
                                      names=[x.split()[0] for x in STATS.split(", ")])


def _aligned(roots: list[Node]) -> Node:
    root = roots[0]
    for x in roots[1:]:
        root.kids = align(root.kids, x.kids)
    return root


def _infer(group: pd.DataFrame) -> pd.DataFrame:
    """The wrapper of some shapes of one host, the most frequent first."""
    group = group.sort_values(["n", "shape_id"], ascending=[False, True])
    roots = [load(s, iter([[[int(v) for v in x]] for x in slots])) for s, slots in zip(group["shape"], group["slots"])]
    return pd.DataFrame({"host": group["host"].iloc[:1], "bucket": group["bucket"].iloc[:1], "n": [int(group["n"].sum())],
                         "wrapper": [dump(_aligned(roots), True)]})


def _infer_more(group: pd.DataFrame) -> pd.DataFrame:
    """The wrapper of some wrappers of one host."""
    group = group.sort_values(["n", "wrapper"], ascending=[False, True])
    return pd.DataFrame({"host": group["host"].iloc[:1], "bucket": group["next"].iloc[:1], "n": [int(group["n"].sum())],
                         "wrapper": [dump(_aligned([load(w) for w in group["wrapper"]]), True)]})


def _picked(shapes: pd.DataFrame, wrappers: pd.DataFrame) -> pd.DataFrame:
    if shapes.empty or wrappers.empty:
        return pd.DataFrame({"host": [], "shape_id": [], "kept": []})
    wrapper = choose(load(wrappers["wrapper"].iloc[0]))
    kept = []
    for shape, slots in zip(shapes["shape"], shapes["slots"]):
        out: set = set()
        pick(load(shape, iter([[i] for i in range(len(slots))])), wrapper, out)
        kept.append(sorted(out))
    return pd.DataFrame({"host": shapes["host"], "shape_id": shapes["shape_id"], "kept": kept})


def _blocks(part: pa.RecordBatch) -> pa.RecordBatch:
    """Every page with its shape, and its text blocks in page order, each with its slot."""
    ids, urls, pages = (part.column(part.schema.get_field_index(c)) for c in ("page_id", "url", "html"))
    rows = ([], [], [], [])
    for url, page in zip(urls.to_pylist(), pages.to_pylist()):
        found = _shape(page)
        blocks = sorted((n, i, b) for i, s in enumerate(found[2]) for n, b, _ in s.data) if found else []
        for col, v in zip(rows, (host_of(url), found[0] if found else None, [i for _, i, _ in blocks], [b for *_, b in blocks])):
            col.append(v)
    return pa.RecordBatch.from_arrays(
        [ids, urls, pa.array(rows[0], pa.string()), pa.array(rows[1], pa.string()),
         pa.array(rows[2], pa.list_(pa.int32())), pa.array(rows[3], pa.list_(pa.string()))],
        names=["page_id", "url", "host", "shape_id", "slots", "blocks"])


def shapes(pages: DataFrame) -> DataFrame:
    """(host, shape_id, shape, n, slots, bucket): every shape of every host with the sums of its slots."""
    found = (pages.select("url", "html").mapInArrow(per_chunk(_stats, "html"), STATS)
             .groupBy("host", "shape_id", "slot")
             .agg(F.max("shape").alias("shape"), *[F.sum(c).alias(c) for c in ("n", "chars", "linked")],
                  *[F.min(c).alias(c) for c in ("lo", "plo")], *[F.max(c).alias(c) for c in ("hi", "phi")]))
    sums = F.array("n", "chars", "linked", "lo", "hi", "plo", "phi")
    whole = found.groupBy("host", "shape_id").agg(
        F.max("shape").alias("shape"), F.max("n").alias("n"),
        F.array_sort(F.collect_list(F.when(F.col("slot") >= 0, F.struct("slot", sums.alias("s"))))).alias("x"))
    whole = materialise(whole.select("host", "shape_id", "shape", "n", F.col("x.s").alias("slots")), "page-shapes")
    many = whole.groupBy("host").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("buckets"))
    return whole.join(many, "host").withColumn("bucket", F.pmod(F.xxhash64("shape_id"), F.col("buckets")).cast("int")).drop("buckets")


def wrappers(found: DataFrame) -> DataFrame:
    """(host, bucket, n, wrapper): one wrapper per host."""
    schema = "host string, bucket int, n long, wrapper string"
    out = materialise(found.groupBy("host", "bucket").applyInPandas(_infer, schema), "wrappers")
    most = out.agg(F.max("bucket")).first()[0] or 0
    while most > 0:
        most //= FAN
        out = materialise(out.withColumn("next", F.floor(F.col("bucket") / FAN).cast("int"))
                          .groupBy("host", "next").applyInPandas(_infer_more, schema), "wrappers")
    return out


def extract(pages: DataFrame) -> DataFrame:
    """The contract's columns: (page_id, url, text, n_chars)."""
    pages = pages.select("page_id", "url", "html")
    found = materialise(shapes(pages), "page-shapes")
    hosts = found.groupBy("host").agg(F.max("bucket").alias("most"))
    each = (wrappers(found).join(hosts, "host")
            .select("host", "wrapper", F.explode(F.sequence(F.lit(0), "most")).alias("bucket")))
    kept = materialise(found.groupBy("host", "bucket").cogroup(each.groupBy("host", "bucket"))
                       .applyInPandas(_picked, "host string, shape_id string, kept array<int>"), "page-slots")
    types = dict(pages.dtypes)
    blocks = pages.mapInArrow(per_chunk(_blocks, "html"), f"page_id {types['page_id']}, url {types['url']}, host string, "
                                                          "shape_id string, slots array<int>, blocks array<string>")
    both = blocks.join(broadcast_if_small(kept), ["host", "shape_id"], "left")
    chosen = F.filter(F.arrays_zip("slots", "blocks"), lambda x: F.array_contains("kept", x["slots"]))
    text = F.coalesce(F.array_join(F.transform(chosen, lambda x: x["blocks"]), "\n\n"), F.lit(""))
    return both.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
