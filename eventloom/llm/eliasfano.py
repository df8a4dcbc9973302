"""Elias-Fano sequences over flat arrays that can be mapped from a file."""

from __future__ import annotations

import json

import numpy as np

_ONE = np.uint64(1)


#: Every byte's lowest bit, and its highest.
_LOWS, _HIGHS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
#: Place of the k-th set bit of byte b, at 8 b + k.
_IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[k] for b in range(256) for k in range(8)], np.int64)


def _select_in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th (from 0) set bit of each word: the byte by its bytes'
    running counts, compared all at once, then a table."""
    k = k.astype(np.uint64)
    sums = word - (word >> _ONE & np.uint64(0x5555555555555555))
    sums = (sums & np.uint64(0x3333333333333333)) + (sums >> np.uint64(2) & np.uint64(0x3333333333333333))
    sums = (sums + (sums >> np.uint64(4)) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _LOWS
    at = np.bitwise_count((k * _LOWS | _HIGHS) - sums & _HIGHS).astype(np.uint64) << np.uint64(3)
    k -= sums << np.uint64(8) >> at & np.uint64(255)
    byte = word >> at & np.uint64(255)
    return at.astype(np.int64) + _IN_BYTE[(byte << np.uint64(3) | k & np.uint64(7)).astype(np.int64)]


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """A non-decreasing sequence: low bits packed, high bits in unary."""
    values, n = values.astype(np.uint64), len(values)
    bits = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
    low = np.zeros((n * bits >> 6) + 2, np.uint64)
    if bits and n:
        part = values & np.uint64((1 << bits) - 1)
        at = np.arange(n, dtype=np.int64) * bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        _or_into(low, word, part << shift)
        over = (at & 63) + bits > 64
        _or_into(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
    top = (values >> np.uint64(bits)).astype(np.int64)
    high = np.zeros(((int(top[-1]) if n else 0) + n + 1 >> 6) + 1, np.uint64)
    at = top + np.arange(n, dtype=np.int64)
    _or_into(high, at >> 6, _ONE << (at & 63).astype(np.uint64))
    return {"n": np.array([n], np.int64), "bits": np.array([bits], np.int64), "low": low, "high": high}


#: Questions that are answered at once: the arrays in between stay in a core's cache.
BLOCK = 1 << 14


class Shelf:
    """Encoded sequences side by side. A question names its sequence, so many
    are answered by the same few array operations."""

    def __init__(self, n, bits, low_at, low, high_at, high, ones):
        """``low_at`` and ``high_at`` (one entry more) are where each sequence's
        words begin; ``ones`` counts the set bits before each word of ``high``."""
        # (views of a mapping that are plain arrays)
        self.n, self.bits, self.low_at, self.low = n, bits, low_at, np.asarray(low)
        self.high_at, self.high, self.ones = high_at, np.asarray(high), np.asarray(ones)
        self.zeros = Zeros(self.ones)
        self.ones_at = np.concatenate([[0], np.cumsum(n)])
        self.zeros_at = high_at * 64 - self.ones_at

    @staticmethod
    def of(*sequences: dict[str, np.ndarray]) -> "Shelf":
        at = lambda name: np.concatenate([[0], np.cumsum([len(x[name]) for x in sequences])]).astype(np.int64)
        join = lambda name: np.concatenate([x[name] for x in sequences])
        high = join("high")
        return Shelf(join("n"), join("bits"), at("low"), join("low"), at("high"), high, set_before([high])[0])

    def _low(self, seq: np.ndarray, i: np.ndarray) -> np.ndarray:
        bits = self.bits[seq]
        at = i * bits
        word, shift = (at >> 6) + self.low_at[seq], (at & 63).astype(np.uint64)
        out = self.low[word] >> shift
        over = np.flatnonzero((at & 63) + bits > 64)
        if len(over):
            out[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return out & ((_ONE << bits.astype(np.uint64)) - _ONE)

    def _zero(self, zero: np.ndarray) -> np.ndarray:
        """Where among all bits the clear bits of these numbers are."""
        word = self.zeros.word(zero)
        return word * 64 + _select_in_word(~self.high[word], zero - self.zeros.before(word))

    def _bucket(self, seq: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which values of a sequence have the high part h: from, to. Their ones
        begin after the clear bit before, and mostly end in the same word."""
        at, lo = self.high_at[seq] * 64, np.zeros(len(h), np.int64)
        some = np.flatnonzero(h > 0)
        zero = self.zeros_at[seq[some]] + h[some] - 1
        place = self._zero(zero)
        at[some] = place + 1
        lo[some] = np.minimum(place - zero - self.ones_at[seq[some]], self.n[seq[some]])
        word = np.minimum(at >> 6, len(self.high) - 1)
        clear = ~self.high[word] >> (at & 63).astype(np.uint64)
        hi = lo + np.bitwise_count((clear & (~clear + _ONE)) - _ONE)
        far = np.flatnonzero((clear == 0) | (at >> 6 > word))
        zero = self.zeros_at[seq[far]] + h[far]
        hi[far] = self._zero(zero) - zero - self.ones_at[seq[far]]
        return lo, np.minimum(hi, self.n[seq])

    def access(self, seq: np.ndarray, i: np.ndarray) -> np.ndarray:
        """The i-th value of each sequence asked."""
        out = np.empty(len(i), np.uint64)
        for at in range(0, len(i), BLOCK):
            out[at:at + BLOCK] = self._access(seq[at:at + BLOCK], i[at:at + BLOCK])
        return out

    def _access(self, seq: np.ndarray, i: np.ndarray) -> np.ndarray:
        one = self.ones_at[seq] + i
        word = np.searchsorted(self.ones, one.astype(np.uint64), "right") - 1
        place = _select_in_word(self.high[word], one - self.ones[word].astype(np.int64))
        top = (word - self.high_at[seq]) * 64 + place - i
        return top.astype(np.uint64) << self.bits[seq].astype(np.uint64) | self._low(seq, i)

    def find(self, seq: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The place of each value in its sequence, or -1. Quickest if ascending."""
        out = np.empty(len(values), np.int64)
        for at in range(0, len(values), BLOCK):
            out[at:at + BLOCK] = self._find(seq[at:at + BLOCK], values[at:at + BLOCK].astype(np.uint64))
        return out

    def _find(self, seq: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.full(len(values), -1, np.int64)
        top = values >> self.bits[seq].astype(np.uint64)
        last = self.zeros_at[seq + 1] - self.zeros_at[seq] - 1  # higher parts hold nothing
        on = np.flatnonzero((self.n[seq] > 0) & (top <= last.astype(np.uint64)))
        h, seq = top[on].astype(np.int64), seq[on]
        lo, end = self._bucket(seq, h)
        some = np.flatnonzero(lo < end)
        on, seq, lo, hi = on[some], seq[some], lo[some], end[some] - 1
        base, bits = self.low_at[seq] * 64, self.bits[seq]
        for width in np.unique(bits).tolist():  # sequences side by side have much the same
            at = np.flatnonzero(bits == width)
            want = values[on[at]] & np.uint64((1 << width) - 1)
            place = self._successor(lo[at], hi[at], base[at], width, want)
            hit = np.flatnonzero(self._field(base[at] + place * width, width) == want)
            out[on[at[hit]]] = place[hit]
        return out

    def _field(self, at: np.ndarray, width: int) -> np.ndarray:
        """The ``width`` low bits that begin at these bits."""
        word, shift = at >> 6, at & 63
        out = self.low.take(word) >> shift.view(np.uint64)
        over = np.flatnonzero(shift > 64 - width)
        if len(over):
            out[over] |= self.low.take(word[over] + 1) << (64 - shift[over]).view(np.uint64)
        out &= np.uint64((1 << width) - 1)
        return out

    def _successor(self, lo: np.ndarray, hi: np.ndarray, base: np.ndarray, width: int, want: np.ndarray) -> np.ndarray:
        """By halving, the first place from lo to hi whose low bits are at least ``want``, or hi."""
        out = lo.copy()
        live = np.flatnonzero(lo < hi)
        lo, hi, base, want = (x[live] for x in (lo, hi, base, want))
        while len(live):
            mid = (lo + hi) >> 1
            less = self._field(base + mid * width, width) < want
            lo, hi = np.where(less, mid + 1, lo), np.where(less, hi, mid)
            on = np.flatnonzero(lo < hi)
            if len(on) < len(live):
                out[live] = lo
                live, lo, hi, base, want = (x.take(on) for x in (live, lo, hi, base, want))
        return out


class Zeros:
    """Clear bits before each word, as 64 per word less the set ones; held only
    for every ``STEP``-th word, so that the mapped arrays stay compact."""

    STEP = 16

    def __init__(self, ones: np.ndarray):
        self.ones = ones
        at = np.arange(0, len(ones), self.STEP)
        self.sample = at * 64 - ones[::self.STEP].astype(np.int64)

    def before(self, word: np.ndarray) -> np.ndarray:
        return word * 64 - self.ones[word].astype(np.int64)

    def word(self, zero: np.ndarray) -> np.ndarray:
        """The last word with at most ``zero`` clear bits before it."""
        lo = (np.searchsorted(self.sample, zero, "right") - 1) * self.STEP
        step = self.STEP // 2
        while step:
            nxt = np.minimum(lo + step, len(self.ones) - 1)
            lo = np.where(self.before(nxt) <= zero, nxt, lo)
            step //= 2
        return lo


def set_before(parts) -> list[np.ndarray]:
    """For runs of words that follow each other, the set bits before each word."""
    out, total = [], 0
    for high in parts:
        count = np.bitwise_count(high).astype(np.uint64)
        out.append(np.concatenate([[np.uint64(0)], np.cumsum(count, dtype=np.uint64)[:-1]]) + np.uint64(total))
        total += int(count.sum())
    return out


def _or_into(words: np.ndarray, at: np.ndarray, bits: np.ndarray) -> None:
    """words[at] |= bits for ascending ``at`` with repeats."""
    if len(at):
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        words[at[first]] |= np.bitwise_or.reduceat(bits, first)


def write_arrays(path: str, arrays: dict) -> None:
    """One file: a JSON line of names, types and places, then the arrays. An
    array may come as a list of runs, which are written one after the other."""
    from eventloom.llm.warc import filesystem
    fs, inner = filesystem(path)
    runs = {name: a if isinstance(a, list) else [a] for name, a in arrays.items()}
    head, at = [], 0
    for name, a in runs.items():
        size = sum(x.nbytes for x in a)
        head.append((name, a[0].dtype.str, sum(map(len, a)), at))
        at += -(-size // 64) * 64
    line = json.dumps(head).encode()
    line = line.ljust(-(-(len(line) + 1) // 64) * 64 - 1) + b"\n"
    with fs.open_output_stream(inner, compression=None) as out:
        out.write(line)
        for a in runs.values():
            for x in a:
                out.write(np.ascontiguousarray(x).data)
            out.write(b"\0" * (-sum(x.nbytes for x in a) % 64))


def map_arrays(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped if the folder is mounted, else read."""
    from pyarrow import fs as pafs
    from eventloom.llm.warc import filesystem
    fs, inner = filesystem(path)
    if isinstance(fs, pafs.LocalFileSystem):
        data = np.memmap(inner, np.uint8, "r")
    else:
        with fs.open_input_file(inner) as f:
            data = np.frombuffer(f.read(), np.uint8)
    cut = bytes(data[:1 << 16]).index(b"\n") + 1
    return {name: data[cut + at:cut + at + n * np.dtype(kind).itemsize].view(kind)
            for name, kind, n, at in json.loads(bytes(data[:cut]))}
