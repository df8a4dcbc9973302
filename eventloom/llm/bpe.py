"""Byte-level BPE encoding and decoding by backtracking over longest matches.

A byte string's BPE tokens are the only sequence in which every two adjacent
tokens are compatible: encoding their bytes together gives those two tokens
again. So the encoder takes the longest vocabulary match at each place (all
matches come from one Aho-Corasick pass), checks it against the token before
it in the pair table, tries the next shorter match if they don't fit, and steps
back one token when none is left. A place once left is never entered again,
which bounds the work linearly. The pair table is filled as pairs come up.

Decoding gathers token bytes from one flat buffer by an offset table.

The vocabulary file is read on the driver and broadcast: its size is that of
a fixed vocabulary, not of the data.

Nulls and empty texts have no tokens and decode to the empty text; other
columns are passed through, so repeated rows each give a row and an empty
table an empty one. Long texts are encoded whole, pretoken by pretoken.
"""

from __future__ import annotations

import json
import re
from array import array
from collections import deque

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import per_chunk

#: The public byte-level split rule (contractions, letters, numbers, others,
#: white space); fixed value.
SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")

# The same rule for texts without code points from U+0180 on, where the three
# classes are few enough to list; the standard module is several times faster.
_L, _N, _W = "A-Za-zªµºÀ-ÖØ-öø-\u017f", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
SPLIT_LATIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_W}{_L}{_N}]+|[{_W}]+(?![^{_W}])|[{_W}]+")
BEYOND_LATIN = re.compile("[^\x00-\u017f]")


def pretokens(text: str) -> list[str]:
    return (SPLIT if BEYOND_LATIN.search(text) else SPLIT_LATIN).findall(text)


#: Pretokens remembered in each of a worker's two cache generations, and the
#: longest that is remembered; memory only, results do not depend on them.
REMEMBERED, LONGEST_REMEMBERED = 100_000, 48


def byte_letters() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves,
    the others for the code points from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Token bytes, merges and special tokens of a tokenizer file."""

    def __init__(self, spec: bytes):
        tok = json.loads(spec)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        ids = tok["model"]["vocab"]
        self.special = {a["content"]: a["id"] for a in tok.get("added_tokens", [])}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for s, i in ids.items():
            self.bytes[i] = as_bytes(s)
        for s, i in self.special.items():
            self.bytes[i] = s.encode()
        # rank: the place of the merge that makes a token; single bytes come before all merges
        self.rank = [-1] * size
        self.parts: list[tuple[int, int] | None] = [None] * size
        self.merged: dict[tuple[int, int], int] = {}
        for r, m in enumerate(tok["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            t = ids[a + b]
            pair = (ids[a], ids[b])
            if pair not in self.merged:
                self.merged[pair] = t
                if self.parts[t] is None:
                    self.parts[t], self.rank[t] = pair, r
        self.fits_memo: dict[int, bool] = {}
        made = [i for i in ids.values() if len(self.bytes[i]) == 1 or self.parts[i]]
        by_bytes = {self.bytes[i]: i for i in made}
        # the next shorter token that is a prefix of each token
        self.shorter: list[int | None] = [None] * size
        for i in made:
            b = self.bytes[i]
            for n in range(len(b) - 1, 0, -1):
                if (j := by_bytes.get(b[:n])) is not None:
                    self.shorter[i] = j
                    break
        self.length = [len(b) for b in self.bytes]
        self._automaton(by_bytes)
        self.single = {b: int(i).to_bytes(4, "little") for b, i in by_bytes.items()}
        self.offsets = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int64)
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.split_special = regex.compile("(" + "|".join(
            regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def _automaton(self, by_bytes: dict[bytes, int]) -> None:
        """Aho-Corasick over the reversed tokens. Read from a text's end, the
        state at each byte knows the longest token that starts there."""
        edges, fail, longest = {}, [0], [-1]
        for b, i in by_bytes.items():
            state = 0
            for c in reversed(b):
                nxt = edges.get(state << 8 | c)
                if nxt is None:
                    nxt = edges[state << 8 | c] = len(fail)
                    fail.append(0)
                    longest.append(-1)
                state = nxt
            longest[state] = i
        children: list[list[tuple[int, int]]] = [[] for _ in fail]
        for key, nxt in edges.items():
            children[key >> 8].append((key & 255, nxt))
        queue = deque(n for _, n in children[0])
        while queue:
            state = queue.popleft()
            if longest[state] < 0:
                longest[state] = longest[fail[state]]
            for c, nxt in children[state]:
                back = fail[state]
                while back and (back << 8 | c) not in edges:
                    back = fail[back]
                fail[nxt] = edges.get(back << 8 | c, 0)
                queue.append(nxt)
        self.edges, self.fail, self.ends = edges, fail, longest

    def longest_matches(self, piece: bytes) -> list[int]:
        """The longest token that starts at each byte."""
        step, fail, ends, state, out = self.edges.get, self.fail, self.ends, 0, []
        for c in reversed(piece):
            nxt = step(state << 8 | c)
            while nxt is None:
                state = fail[state]
                nxt = step(state << 8 | c)
            state = nxt
            out.append(ends[state])
        out.reverse()
        return out

    def fits(self, a: int, b: int) -> bool:
        """Whether a and b side by side stay as they are under the merge order."""
        key = a << 32 | b
        known = self.fits_memo.get(key)
        if known is None:
            if len(self.fits_memo) > 1_000_000:
                self.fits_memo.clear()
            known = self.fits_memo[key] = self._fits(a, b)
        return known

    def _fits(self, a: int, b: int) -> bool:
        """Undo, latest merge first, the merges at the border of a and b. Were
        some pair across the border mergeable before the merge that hid one
        of its sides, the border would not have survived."""
        rank, parts, merged = self.rank, self.parts, self.merged
        bound = float("inf")  # merges of a rank from here on came too late
        left = right = None
        while True:
            t = merged.get((a, b))
            if t is not None and (rank[t] < bound or rank[t] == bound and right):
                return False
            # Of the two, undo the later merge. At one rank the left one was made first.
            if rank[a] > rank[b]:
                left, right, bound = True, False, rank[a]
                a = parts[a][1]
            elif parts[b] is None:
                return True
            else:
                left, right, bound = False, True, rank[b]
                b = parts[b][0]

    def encode_piece(self, piece: bytes) -> bytes:
        """Ids of one pretoken, as little-endian unsigned 32-bit integers."""
        whole = self.single.get(piece)
        if whole is not None:
            return whole
        n, longest = len(piece), self.longest_matches(piece)
        length, shorter, memo = self.length, self.shorter, self.fits_memo
        out: list[int] = []
        open_ = bytearray(b"\1") * (n + 1)
        at, t, last = 0, longest[0], -1
        while True:
            end = at + length[t]
            if open_[end]:
                ok = last < 0 or memo.get(last << 32 | t)
                if ok is None:
                    ok = self.fits(last, t)
                if ok:
                    out.append(t)
                    if end == n:
                        return array("I", out).tobytes()
                    at, last, t = end, t, longest[end]
                    continue
            t = shorter[t]
            if t is None:  # nothing leads on from here
                open_[at] = 0
                t = out.pop()
                at -= length[t]
                last = out[-1] if out else -1


class Encoder(dict):
    """Pretoken → id bytes, in two generations so that memory stays bounded."""

    def __init__(self, spec: bytes):
        self.vocabulary = Vocabulary(spec)
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.vocabulary.encode_piece(piece.encode())
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        split, get = pretokens, self.__getitem__
        special = self.vocabulary.special
        if not any(s in text for s in special):
            return b"".join(map(get, split(text)))
        return b"".join(
            special[part].to_bytes(4, "little") if part in special else b"".join(map(get, split(part)))
            for part in self.vocabulary.split_special.split(text))

    def decode(self, ids: bytes | None) -> str:
        """The text of ids; bytes that aren't UTF-8 become U+FFFD."""
        v, ids = self.vocabulary, np.frombuffer(ids or b"", "<u4")
        out = []
        for i in range(0, len(ids), 1 << 18):
            part = ids[i:i + (1 << 18)].astype(np.int64)
            n = v.offsets[part + 1] - v.offsets[part]
            shift = np.repeat(v.offsets[part] - (np.cumsum(n) - n), n)
            out.append(v.flat[shift + np.arange(len(shift))].tobytes())
        return b"".join(out).decode("utf-8", "replace")


_ENCODERS: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder a worker process and broadcast vocabulary."""
    if shared.value["id"] not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[shared.value["id"]] = Encoder(shared.value["spec"])
    return _ENCODERS[shared.value["id"]]


def share(spark, path: str):
    """Broadcast a tokenizer file (its size is the vocabulary's, not the data's)."""
    import zlib
    with open(path, "rb") as f:
        spec = f.read()
    return spark.sparkContext.broadcast({"id": zlib.crc32(spec), "spec": spec})


def _append(part: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*part.columns, values], names=[*part.schema.names, name])


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``: the tokens of ``text`` as little-endian unsigned 32-bit integers."""
    shared = share(df.sparkSession, path)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        enc = _encoder(shared)
        col = part.column(part.schema.get_field_index(text)).to_pylist()
        return _append(part, ids, pa.array([enc.encode(t) for t in col], pa.binary()))

    out = df.withColumn(ids, F.lit(b"")).schema
    return df.mapInArrow(per_chunk(run, text), out)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``: the text that ``ids`` stands for."""
    shared = share(df.sparkSession, path)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        enc = _encoder(shared)
        col = part.column(part.schema.get_field_index(ids)).to_pylist()
        return _append(part, text, pa.array([enc.decode(x) for x in col], pa.string()))

    out = df.withColumn(text, F.lit("")).schema
    return df.mapInArrow(per_chunk(run, ids), out)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """The contract's digest of every document's ids and decoded text. Both are
    made in one pass, so a task needs one Python worker and one vocabulary."""
    shared = share(docs.sparkSession, path)

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        enc = _encoder(shared)
        ids = [enc.encode(t) for t in part.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(ids, pa.binary()), pa.array([enc.decode(x) for x in ids], pa.string())],
            names=["doc_id", "ids", "decoded"])

    docs = docs.select("doc_id", "text")
    coded = docs.mapInArrow(per_chunk(run), f"doc_id {dict(docs.dtypes)['doc_id']}, ids binary, decoded string")
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
