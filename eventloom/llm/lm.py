"""Language-model scores from an Elias-Fano n-gram trie.

Tokens are lower-cased words and one end per text. Level 1 holds the sorted
word hashes; a word's id is its place. Level k holds, for every context of k-1
words, its successors in ascending order, as one monotone sequence, with
monotone pointers to where each context begins. Levels above the second name a
successor by its place among the successors of the shorter context, which is a
small number, so the trie stays compact. Each entry carries its smoothed
log10 probability in one byte, each context its back-off weight in another.

Smoothing is by a Dirichlet prior around the shorter context's estimate:
P(w|c) = (n(cw) + mu P(w|c')) / (n(c) + mu). Level 1 is (n+1)/(N+V+1). Every
level has one mu, picked from ``MU`` by the leave-one-out likelihood of all its
counts, so scores don't depend on how the trie is cut.

Each level is cut into pieces: level 1 by the word's hash, the levels above by
ranges of contexts that occur about ``PIECE`` times together, known from the
level below. So a piece holds that many different n-grams at most, or one
context's successors, which are words and no more than those. Entries of a level
are numbered through, and a context is named by its number. Pieces are built one
by one; ``VOLUME`` of them then share a file per level in the shared folder,
whose sequences are asked together. Counting: map tasks sum equal n-grams of many
texts and send one packed block per piece; one task per piece takes those in turn
and sums them as they come, so it holds its different n-grams about twice, however
often they occur. Files are written under names of their own and known only from
the committed list, so lost tasks leave nothing behind that is read. Scoring maps
the files and looks up whole slices of documents at once. Nothing is pruned.

Null and empty texts are one end token. Documents with a null id are training
documents. Without training texts every probability is 1 (N = 0, V = 0).
Repeated rows each count and each give a row. Long texts are read whole. Only
doc_id and text are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import chunks, input_bytes, materialise, shared_folder, small_batches, text_buffer
from eventloom.llm.eliasfano import Shelf, encode, map_arrays, set_before, write_arrays
from eventloom.llm.words import NONSPACE, Words, mix
from eventloom.session import _fs

ORDER = 3
MU = tuple(2.0 ** i for i in range(-1, 11))
#: Input file bytes per piece of level 1 (the least number of them keeps cores busy).
SHARD_BYTES, LEAST_SHARDS = 16 << 20, 12
#: Occurrences of the contexts of a piece above level 1 (or one context with more).
PIECE = 2_000_000
#: Pieces whose sequences share a file.
VOLUME = 64
#: Entries of blocks that are summed at once at least.
FOLD = 1 << 20
#: Bytes of texts or blocks sent to Python at once.
SENT_BYTES = 4 << 20
#: Text and tokens that a task handles at once.
SLICE_BYTES, HELD_TOKENS = 3 << 20, 1_000_000
END = mix(np.array([0x656E64], np.uint64))[0]
#: One byte holds a log10 of 0 to -LEAST.
LEAST = 12.0


def quantise(p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-np.log10(p) * (255 / LEAST)), 0, 255).astype(np.uint8)


#: log10 of each byte.
LOG10 = -np.arange(256) * (LEAST / 255)


# --- texts as token runs ---------------------------------------------------

class Tokens:
    """Token hashes of a slice of texts, each followed by END; bounds per text."""

    def __init__(self, part: pa.RecordBatch):
        w = Words(*text_buffer(part.column(part.schema.get_field_index("text"))), NONSPACE)
        n = len(part)
        self.bounds = w.bounds + np.arange(n + 1)
        self.hashes = np.empty(len(w) + n, np.uint64)
        self.hashes[self.bounds[1:] - 1] = END
        self.hashes[np.arange(len(w)) + w.doc_of()] = w.hashes

    def place(self) -> np.ndarray:
        """Each token's place in its text."""
        return np.arange(len(self.hashes)) - np.repeat(self.bounds[:-1], np.diff(self.bounds))


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


# --- packed blocks of counts -----------------------------------------------

def pack(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Ascending keys as differences, byte planes apart, with small columns."""
    import zstandard
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    planes = [steps.view(np.uint8).reshape(-1, 8).T.tobytes()]
    planes += [c.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns]
    return zstandard.compress(b"".join(planes), 1)


def unpack(block: bytes, columns: int) -> tuple[np.ndarray, ...]:
    import zstandard
    data = np.frombuffer(zstandard.decompress(block), np.uint8)
    n = len(data) // (8 + 4 * columns)
    keys = np.cumsum(np.ascontiguousarray(data[:8 * n].reshape(8, n).T).view("<u8").ravel(), dtype=np.uint64)
    rest = [np.ascontiguousarray(data[n * (8 + 4 * i):n * (12 + 4 * i)].reshape(4, n).T).view("<u4").ravel()
            for i in range(columns)]
    return (keys, *rest)


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, the order of all (equal ones in any), and where in it each begins."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], order, first


def _summed(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Runs of keys, counts and perhaps another column as one run of different keys."""
    keys, order, first = _sorted(np.concatenate([x[0] for x in held]))
    counts = np.add.reduceat(np.concatenate([x[1] for x in held])[order], first, dtype=np.int64)
    rest = [np.concatenate([x[2] for x in held])[order[first]]] if len(held[0]) > 2 else []
    return (keys, counts, *rest)


def merged(blocks: Iterable[bytes], columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Keys, summed counts, and a key's other column (equal in all blocks). Summed
    whenever as many entries came as there are different ones, ``FOLD`` at least."""
    held, n, most = [], 0, FOLD
    for block in blocks:
        held.append(unpack(block, columns))
        n += len(held[-1][0])
        if n > most:
            held = [_summed(held)]
            n = len(held[0][0])
            most = max(FOLD, 2 * n)
    return (*_summed(held), None)[:3]


def cuts(counts: np.ndarray, most: int) -> np.ndarray:
    """Where runs of entries begin that occur ``most`` times together, but for the last of a run."""
    return np.flatnonzero(np.diff((np.cumsum(counts) - counts) // most, prepend=-1))


def blocks(piece: np.ndarray, key: np.ndarray, other: np.ndarray | None = None):
    """One packed block of distinct keys per piece."""
    order = np.argsort(piece.astype(np.min_scalar_type(int(piece.max(initial=0)))), kind="stable")
    cut = np.flatnonzero(np.diff(piece[order])) + 1
    for at in np.split(order, cut):
        if len(at):
            keys, within, first = _sorted(key[at])
            counts = np.diff(first, append=len(at))
            cols = [counts] if other is None else [counts, other[at[within[first]]]]
            yield int(piece[at[0]]), pack(keys, *cols)


def _rows(found) -> pa.RecordBatch:
    found = list(found)
    return pa.RecordBatch.from_arrays(
        [pa.array([s for s, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())],
        names=["piece", "block"])


# --- the trie --------------------------------------------------------------

class Level:
    """Where a level's pieces are: ``files`` by volume, ``offset`` of each piece's
    first entry in the level, ``ahead`` of each context that begins a piece of the
    next level; both with their end."""

    def __init__(self, files: list[dict], volumes: list[dict], pieces: int):
        size, ahead = np.zeros(pieces + 1, np.int64), []
        for f in files:
            size[f["piece"] + 1] = f["entries"]
        self.offset = np.cumsum(size)
        for f in files:
            ahead.append(self.offset[f["piece"]] + np.array(f["cuts"], np.int64))
        self.ahead = np.concatenate([*ahead, self.offset[-1:]])
        self.files = {r["volume"]: r["path"] for r in volumes}
        self.entries = int(self.offset[-1])


class Trie:
    """The levels, whose volumes are opened when first needed."""

    def __init__(self, shards: int, levels: list[Level], tokens: int):
        self.shards, self.levels, self.total = shards, levels, tokens
        self.words = levels[0].entries if levels else 0
        if self.words >= 1 << 32:
            raise ValueError("word ids need more than 32 bits")
        self._open: dict[tuple[int, int], dict] = {}

    def part(self, level: int, volume: int) -> dict | None:
        """Arrays and sequences of one volume of a level (from 1)."""
        key = (level, volume)
        if key not in self._open:
            path = self.levels[level - 1].files.get(volume) if level <= len(self.levels) else None
            self._open[key] = None
            if path is not None:
                a = map_arrays(path)
                shelf = lambda name: Shelf(*(np.asarray(a[f"{name}.{x}"]) if x in ("n", "bits", "low_at", "high_at")
                                             else a[f"{name}.{x}"]
                                             for x in ("n", "bits", "low_at", "low", "high_at", "high", "ones")))
                self._open[key] = a | {"keys": shelf("keys")} | ({"begin": shelf("begin")} if level > 1 else {})
        return self._open[key]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_open"}

    def __setstate__(self, state):
        self.__dict__.update(state, _open={})

    @staticmethod
    def by_volume(volume: np.ndarray, volumes: int):
        """(volume, places) for every volume that occurs; -1 is left out."""
        # (numbers of 16 bits are sorted in one sweep)
        volume = volume.astype(np.int16 if volumes < 1 << 15 else np.int64)
        order = np.argsort(volume, kind="stable")
        order = order[np.searchsorted(volume[order], 0):]
        for at in np.split(order, np.flatnonzero(np.diff(volume[order])) + 1):
            if len(at):
                yield int(volume[at[0]]), at

    def word_ids(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Id (-1: unknown), count and probability byte of each token."""
        distinct, back = np.unique(h, return_inverse=True)
        ids, counts = np.full(len(distinct), -1, np.int64), np.zeros(len(distinct), np.int64)
        byte = np.full(len(distinct), quantise(np.array([1 / (self.total + self.words + 1)]))[0])
        shard = shard_of(distinct, self.shards)
        for v, at in self.by_volume(shard // VOLUME, self.shards // VOLUME + 1):
            a = self.part(1, v)
            if a:
                seq = shard[at] - v * VOLUME
                found = a["keys"].find(seq, distinct[at])
                ok = np.flatnonzero(found >= 0)
                entry = a["entry_at"][seq[ok]] + found[ok]
                ids[at[ok]] = found[ok] + self.levels[0].offset[shard[at[ok]]]
                counts[at[ok]] = a["counts"][entry]
                byte[at[ok]] = a["probability"][entry]
        return ids[back], counts[back], byte[back]

    def step(self, level: int, parent: np.ndarray, child: np.ndarray, ranked: bool = True):
        """Successor search: the entry of ``child`` among the successors of the
        context ``parent``, an entry of the level below. Returns the entry, its place
        relative to the context (-1 unless ``ranked``), probability byte, and the
        context's back-off byte."""
        place, rank = np.full((2, len(parent)), -1, np.int64)
        byte, back = np.zeros((2, len(parent)), np.uint8)
        firsts, offset = self.levels[level - 2].ahead[:-1:VOLUME], self.levels[level - 1].offset
        for v, at in self.by_volume(np.searchsorted(firsts, parent, "right") - 1, len(firsts)):
            a = self.part(level, v)
            if not a:
                continue
            reach, context_at = int(a["reach"][0]), np.asarray(a["context_at"])
            context = parent[at] - firsts[v]
            back[at] = a["backoff"][context]
            on = np.flatnonzero((child[at] >= 0) & (child[at] < reach))
            at, context = at[on], context[on].astype(np.uint64)
            if int(context_at[-1]) * reach < 1 << 64:  # equal questions are asked once
                one, inverse = np.unique(context * np.uint64(reach) + child[at].astype(np.uint64), return_inverse=True)
                context, succ = (one // np.uint64(reach)).astype(np.int64), one % np.uint64(reach)
            else:
                context, succ, inverse = context.astype(np.int64), child[at].astype(np.uint64), np.arange(len(at))
            seq = np.searchsorted(context_at, context, "right") - 1
            local = context - context_at[seq]
            found = a["keys"].find(seq, local.astype(np.uint64) * np.uint64(reach) + succ)
            ok = np.flatnonzero(found >= 0)
            relative = np.full(len(found), -1, np.int64)
            if ranked and len(ok):  # neighbours of one context share its begin
                new = np.concatenate([[True], np.diff(context[ok]) != 0])
                begin = a["begin"].access(seq[ok[new]], local[ok[new]]).astype(np.int64)
                relative[ok] = found[ok] - begin[np.cumsum(new) - 1]
            bytes_ = np.zeros(len(found), np.uint8)
            bytes_[ok] = a["probability"][a["entry_at"][seq[ok]] + found[ok]]
            found[ok] += offset[v * VOLUME + seq[ok]]
            place[at], rank[at], byte[at] = found[inverse], relative[inverse], bytes_[inverse]
        return place, rank, byte, back

    def walk(self, tokens: Tokens, upto: int):
        """Per level k: (parent, child, entry, probability byte, back-off byte) of
        the k-gram that ends at each token; parents of -1 where there is none."""
        ids, counts, byte = self.word_ids(tokens.hashes)
        at = tokens.place()
        out = [(None, ids, ids, byte, None)]
        for level in range(2, upto + 1):
            # the context is the (k-1)-gram that ends one token earlier; the successor is
            # named as in the context's own shorter form, which ends at this token
            context = np.roll(out[-1][2], 1)
            context[at < level - 1] = -1
            names = ids if level == 2 else rank
            if level <= len(self.levels):
                place, rank, byte, back = self.step(level, context, names, level < upto)
            else:
                place = rank = byte = back = None
            out.append((context, names, place, byte, back))
        return out, counts


def _shared_trie(shared) -> Trie:
    return shared.value


def _slices(batches):
    """Tokens of runs of texts, of about HELD_TOKENS tokens or one longer text."""
    for batch in batches:
        for part in chunks(batch, "text", SLICE_BYTES):
            yield part, Tokens(part)


def count_words(docs: DataFrame, shards: int) -> DataFrame:
    def run(batches):
        held, n = [], 0
        for _, tokens in _slices(batches):
            held.append(tokens.hashes)
            n += len(tokens.hashes)
            if n >= HELD_TOKENS:
                h = np.concatenate(held)
                yield _rows(blocks(shard_of(h, shards), h))
                held, n = [], 0
        if held:
            h = np.concatenate(held)
            yield _rows(blocks(shard_of(h, shards), h))

    return docs.mapInArrow(run, "piece int, block binary")


def count_grams(docs: DataFrame, shared, level: int) -> DataFrame:
    """Blocks of (context's place in its piece, successor) with the byte of the shorter estimate."""
    def send(held):
        return _rows(blocks(*(np.concatenate([x[i] for x in held]) for i in range(3))))

    def run(batches):
        held, n = [], 0
        starts = _shared_trie(shared).levels[level - 2].ahead
        for _, tokens in _slices(batches):
            out, _ = _shared_trie(shared).walk(tokens, level)
            context, child, *_ = out[level - 1]
            at = np.flatnonzero(context >= 0)
            context = context[at]
            piece = np.searchsorted(starts, context, "right") - 1
            key = (context - starts[piece]).astype(np.uint64) << np.uint64(32) | child[at].astype(np.uint64)
            held.append((piece, key, out[level - 2][3][at]))
            n += len(at)
            if n >= HELD_TOKENS:
                yield send(held)
                held, n = [], 0
        if held:
            yield send(held)

    return docs.mapInArrow(run, "piece int, block binary")


#: ``cuts``: where pieces of the next level begin; ``likelihood``: of a level's
#: counts under each mu, to be summed over all pieces.
FILES = "piece int, path string, entries long, tokens long, widest long, cuts array<long>, likelihood array<double>"
_FILE = pa.schema([("piece", pa.int32()), ("path", pa.string()), ("entries", pa.int64()), ("tokens", pa.int64()),
                   ("widest", pa.int64()), ("cuts", pa.list_(pa.int64())), ("likelihood", pa.list_(pa.float64()))])


def _listed(counted: DataFrame, build, name: str) -> list[dict]:
    """Build one file per piece from its blocks, which come in turn; the
    committed list of them (one row a piece)."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = build(key[0].as_py(), (block.as_py() for b in batches for block in b.column("block")))
        yield pa.RecordBatch.from_pylist([dict(zip(_FILE.names, row))], _FILE)

    with small_batches(counted.sparkSession, max_bytes=SENT_BYTES):
        done = materialise(counted.groupBy("piece").applyInArrow(run, FILES), name)
    return [r.asDict() for r in done.orderBy("piece").collect()]


def _file(folder: str, level: int, part: str) -> str:
    return f"{folder}/level{level}-{part}-{uuid.uuid4().hex[:12]}.trie"


def _sequence(name: str, values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    return {f"{name}.{k}": a for k, a in encode(values, universe).items()}


def build_words(counted: DataFrame, folder: str, most: int) -> list[dict]:
    def build(piece: int, blocks: Iterator[bytes]) -> tuple:
        keys, counts, _ = merged(blocks, 1)
        path = _file(folder, 1, f"s{piece}")
        write_arrays(path, _sequence("keys", keys, 1 << 64) | {"counts": counts.astype(np.uint32)})
        return piece, path, len(keys), int(counts.sum()), 0, cuts(counts, most).tolist(), []

    return _listed(counted, build, "lm-words")


def bind(spark, files: list[dict], folder: str, level: int, pieces: int, reach: int = 0, mu: float = 0.0,
         starts: np.ndarray | None = None) -> list[dict]:
    """Put VOLUME pieces' arrays of a level end to end in one file (copied run
    by run, so a task holds little of them), and drop the pieces' own files.
    Probability bytes are made here, now that N, V and the level's mu are known."""
    total, words = sum(f["tokens"] for f in files), sum(f["entries"] for f in files)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        volume = int(rows["piece"].iloc[0]) // VOLUME
        here = range(volume * VOLUME, min(volume * VOLUME + VOLUME, pieces))
        held = {r.piece: map_arrays(r.path) for r in rows.itertuples()}
        none = encode(np.empty(0, np.uint64), 1)
        runs = lambda name, empty: [held[i][name] if i in held else empty for i in here]
        ends = lambda parts: np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
        out: dict = {}
        for seq in ("keys", "begin") if level > 1 else ("keys",):
            part = {k: runs(f"{seq}.{k}", none[k]) for k in none}
            out |= {f"{seq}.{k}": np.concatenate(part[k]) for k in ("n", "bits")}
            out |= {f"{seq}.low_at": ends(part["low"]), f"{seq}.low": part["low"], f"{seq}.high_at": ends(part["high"]),
                    f"{seq}.high": part["high"], f"{seq}.ones": set_before(part["high"])}
        if level == 1:
            out["counts"] = runs("counts", np.empty(0, np.uint32))
            out["probability"] = [quantise((c.astype(float) + 1) / (total + words + 1)) for c in out["counts"]]
        else:
            bare = lambda i: (np.empty(0, np.uint8), np.zeros(starts[i + 1] - starts[i], np.uint8))
            made = [_smoothed(held[i], mu) if i in held else bare(i) for i in here]
            out["probability"], out["backoff"] = [m[0] for m in made], [m[1] for m in made]
            out["context_at"], out["reach"] = ends(out["backoff"]), np.array([reach], np.int64)
        out["entry_at"] = ends(out["probability"])
        path = _file(folder, level, f"v{volume}")
        write_arrays(path, out)
        return pd.DataFrame([(volume, path)], columns=["volume", "path"])

    listed = spark.createDataFrame([(f["piece"], f["path"]) for f in files], "piece int, path string")
    # about a task a volume: a stated number of partitions is not merged for being a few paths
    volumes = len({f["piece"] // VOLUME for f in files})
    done = materialise(listed.withColumn("volume", (F.col("piece") / VOLUME).cast("int")).repartition(volumes, "volume")
                       .groupBy("volume").applyInPandas(build, "volume int, path string"), f"lm-volumes{level}")
    bound = [r.asDict() for r in done.collect()]
    for f in files:
        path, fs = _fs(spark, f["path"])
        fs.delete(path, False)
    return bound


def likelihoods(counts: np.ndarray, totals: np.ndarray, lower: np.ndarray, grid: tuple = MU) -> list[float]:
    """The log-likelihood of the counts, each left out once, under every mu of ``grid``."""
    return [float((counts * np.log((counts - 1 + mu * lower) / (totals - 1 + mu))).sum()) for mu in grid]


def best_mu(files: list[dict], grid: tuple) -> float:
    """One mu for a level: the likeliest over all pieces (a number per piece and mu is summed)."""
    sums = np.array([f["likelihood"] for f in files]).sum(0)
    return max(zip(np.round(sums, 3).tolist(), grid))[1]


def smooth(counts: np.ndarray, totals: np.ndarray, lower: np.ndarray, grid: tuple = MU) -> float:
    """The mu of ``grid`` under which the counts, each left out once, are likeliest."""
    return best_mu([{"likelihood": likelihoods(counts, totals, lower, grid)}], grid)


def _smoothed(piece: dict, mu: float) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a piece's probabilities and of its contexts' back-off weights."""
    totals, low = piece["totals"].astype(float), 10.0 ** LOG10[piece["lower"]]
    p = (piece["counts"] + mu * low) / (np.repeat(totals, piece["sizes"]) + mu)
    return quantise(p), quantise(mu / (totals + mu))


def build_grams(counted: DataFrame, folder: str, level: int, reach: int, starts: np.ndarray, grid: tuple,
                most: int) -> list[dict]:
    def build(piece: int, blocks: Iterator[bytes]) -> tuple:
        keys, counts, lower = merged(blocks, 2)
        context = (keys >> np.uint64(32)).astype(np.int64)
        n = int(starts[piece + 1] - starts[piece])
        totals = np.bincount(context, weights=counts, minlength=n)
        sizes = np.bincount(context, minlength=n)
        likelihood = likelihoods(counts, totals[context], 10.0 ** LOG10[lower], grid)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        keys = context.astype(np.uint64) * np.uint64(reach) + (keys & np.uint64(0xFFFFFFFF))
        path = _file(folder, level, f"s{piece}")
        write_arrays(path, _sequence("keys", keys, n * reach) | _sequence("begin", begin, len(keys) + 1)
                     | {"counts": counts.astype(np.uint32), "lower": lower, "totals": totals.astype(np.uint64),
                        "sizes": sizes.astype(np.uint32)})
        return piece, path, len(keys), int(counts.sum()), int(sizes.max()), cuts(counts, most).tolist(), likelihood

    return _listed(counted, build, f"lm-level{level}")


def train(docs: DataFrame, order: int = ORDER, least_shards: int = LEAST_SHARDS, grid: tuple = MU,
          most: int = PIECE) -> Trie:
    """The trie of all n-grams up to ``order`` words of ``docs.text``; ``most``: see PIECE."""
    spark = docs.sparkSession
    shards = max(least_shards, input_bytes(docs) // SHARD_BYTES)
    folder = shared_folder(spark, "lm")
    path, fs = _fs(spark, folder)
    fs.mkdirs(path)
    texts = docs.select("text")
    files = build_words(count_words(texts, shards), folder, most)
    tokens = sum(f["tokens"] for f in files)
    levels = [Level(files, bind(spark, files, folder, 1, shards), shards)] if files else []
    for level in range(2, order + 1):
        if not files:
            break
        shared = spark.sparkContext.broadcast(Trie(shards, levels, tokens))
        starts = levels[-1].ahead
        reach = max(1, levels[0].entries if level == 2 else max(f["widest"] for f in files))
        files = build_grams(count_grams(texts, shared, level), folder, level, reach, starts, grid, most)
        if files:
            pieces = len(starts) - 1
            bound = bind(spark, files, folder, level, pieces, reach, best_mu(files, grid), starts)
            levels.append(Level(files, bound, pieces))
    return Trie(shards, levels, tokens)


def score(docs: DataFrame, trie: Trie, text: str = "text") -> DataFrame:
    """Add n_tokens, n_known, base_score and score (log10) to every document."""
    shared = docs.sparkSession.sparkContext.broadcast(trie)

    def run(batches):
        t = _shared_trie(shared)
        for part, tokens in _slices(batches):
            out, counts = t.walk(tokens, len(t.levels))
            doc = np.repeat(np.arange(len(part)), np.diff(tokens.bounds))
            total = lambda x: np.bincount(doc, weights=x, minlength=len(part))
            base = np.log10((counts + 1) / (t.total + t.words + 1))
            p = LOG10[out[0][3]]
            for context, _, place, byte, back in out[1:]:
                p = np.where(place >= 0, LOG10[byte], p + np.where(context >= 0, LOG10[back], 0.0))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(np.diff(tokens.bounds).astype(np.int64)),
                 pa.array(total(counts > 0).astype(np.int64)), pa.array(total(base)), pa.array(total(p))],
                names=[*part.schema.names, "n_tokens", "n_known", "base_score", "score"])

    schema = docs.withColumns({"n_tokens": F.lit(0).cast("long"), "n_known": F.lit(0).cast("long"),
                               "base_score": F.lit(0.0), "score": F.lit(0.0)}).schema
    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """The contract's columns; documents of remainder 2 are held out of training."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    docs = docs.select("doc_id", "text")
    trie = train(docs.filter(~held_out), order)
    return score(docs, trie).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(trie.total).cast("long").alias("train_tokens"), "base_score", "score")
