"""Array kernels shared by the corpus operators.

Everything here works on a batch of whole texts at a time: texts are joined into one byte
buffer, tokens are found by comparing byte classes, and every token gets a 64-bit hash from
prefix sums of a polynomial over its bytes. No Python code runs per token.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text handled at a time; a longer text is cut at white space.
GROUP_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = [np.ones(1, U), np.ones(1, U)]

#: Byte classes. Words of the contracts end at these bytes and no others.
WORD_CLASS = np.ones(256, np.uint8)
WORD_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
#: White space 0, letters, digits and all non-ASCII bytes 1, other ASCII 2.
TERM_CLASS = np.full(256, 2, np.uint8)
TERM_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
for _c in (*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)):
    TERM_CLASS[_c] = 1


def release() -> None:
    """Gives freed memory back to the system: a Python worker waits for further tasks with what it holds."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least n of each."""
    while len(_powers[0]) < n:
        size = len(_powers[0])
        for i, base in enumerate((_BASE, _INVERSE)):
            _powers[i] = np.concatenate([_powers[i], _powers[i] * U(pow(base, size, 1 << 64))])
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the murmur3 finaliser)."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of two hashes."""
    return mix(a * U(0x9FB21C651E98DF25) + mix(b ^ U(0xD6E8FEB86659FD93)))


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Prefix sums from which span_hash() gets the hash of any span of buf."""
    up, _ = powers(len(buf) + 1)
    out = np.empty(len(buf) + 1, U)
    out[0] = 0
    np.cumsum(_BYTE[buf] * up[: len(buf)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end); equal bytes have equal hashes."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U) * U(0xA24BAED4963EE407))


_BLANK = b" \t\n\r"


def _cut(text: bytes, low: int, high: int, lone: bool) -> int:
    """Where a piece that begins at low may end, at most at high: before white space, or, if lone,
    before a single space between visible characters; where there is none, after high."""
    at = high
    while (at := max(text.rfind(b" ", low + 1, at), -1 if lone else text.rfind(b"\n", low + 1, at))) >= 0:
        if not lone or _alone(text, at):
            return at
    at = high - 1
    while (at := min((c for c in (text.find(b" ", at + 1), -1 if lone else text.find(b"\n", at + 1)) if c >= 0), default=len(text))) < len(text):
        if not lone or _alone(text, at):
            return at
    return len(text)


def _alone(text: bytes, at: int) -> bool:
    return at + 1 < len(text) and text[at - 1] not in _BLANK and text[at + 1] not in _BLANK


def pieces(texts: list[bytes], limit: int = GROUP_BYTES, lone: bool = False) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Groups of (document index of each piece, pieces); a long text is cut at white space (lone: see _cut())."""
    docs: list[int] = []
    held: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        at = 0
        while True:
            end = len(text) if len(text) - at <= limit else _cut(text, at, at + limit, lone)
            if held and size + end - at > limit:
                yield np.array(docs), held
                docs, held, size = [], [], 0
            docs.append(i)
            held.append(text[at:end])
            size += end - at + 1
            at = end
            if at >= len(text):
                break
    if held:
        yield np.array(docs), held


class Tokens:
    """Tokens of a list of texts: hashes, byte class and length, with offsets by text."""

    def __init__(self, texts: list[bytes], classes: np.ndarray = WORD_CLASS, prefixes: tuple[int, ...] = ()):
        hashes, kinds, sizes, heads = [], [], [], [[] for _ in prefixes]
        counts = np.zeros(len(texts), np.int64)
        for docs, held in pieces(texts):
            buf = np.frombuffer(b"\n".join(held) + b"\n", np.uint8)
            kind = classes[buf]
            edge = np.empty(len(buf) + 1, bool)
            edge[0] = edge[-1] = True
            np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
            at = np.flatnonzero(edge)
            start, end = at[:-1], at[1:]
            real = kind[start] > 0
            start, end = start[real], end[real]
            sums = prefix_sums(buf)
            hashes.append(span_hash(sums, start, end))
            kinds.append(kind[start])
            sizes.append((end - start).astype(np.int32))
            for out, n in zip(heads, prefixes, strict=True):
                out.append(mix(span_hash(sums, start, np.minimum(start + n, end)) + U(n)))
            first = np.cumsum([0, *(len(x) + 1 for x in held)])[:-1]
            where = np.searchsorted(start, np.append(first, len(buf)))
            np.add.at(counts, docs, np.diff(where))
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.hash, self.kind, self.size = join(hashes, U), join(kinds, np.uint8), join(sizes, np.int32)
        self.prefix = [join(x, U) for x in heads]
        self.offsets = np.concatenate([[0], np.cumsum(counts)])

    def docs(self) -> np.ndarray:
        """The text index of each token."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ranges flat[start:start+size] one after the other."""
    size = size.astype(np.int64)
    total = int(size.sum())
    if not total:
        return flat[:0]
    ends = np.cumsum(size)
    index = np.arange(total, dtype=np.int64) + np.repeat(start - (ends - size), size)
    return flat[index]


class Table:
    """Open-addressing map from non-zero 64-bit keys to row numbers 0, 1, 2, ... of bounded size."""

    def __init__(self, bits: int):
        self.mask = U((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, U)
        self.rows = np.zeros(1 << bits, np.int32)
        self.n = 0

    @property
    def full(self) -> bool:
        return 2 * self.n > len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it is missing."""
        out = np.full(len(keys), -1, np.int64)
        open_, want = np.arange(len(keys)), keys
        slot = keys & self.mask
        while len(open_):
            there = self.keys[slot]
            hit = there == want
            out[open_[hit]] = self.rows[slot[hit]]
            on = ~hit & (there != 0)
            open_, want, slot = open_[on], want[on], (slot[on] + U(1)) & self.mask
        return out

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Adds distinct new keys; their rows."""
        rows = np.arange(self.n, self.n + len(keys))
        self.n += len(keys)
        left, want, slot = rows, keys, keys & self.mask
        while len(left):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = want[free]
            mine = free & (self.keys[slot] == want)
            self.rows[slot[mine]] = left[mine]
            on = ~mine
            left, want, slot = left[on], want[on], (slot[on] + U(1)) & self.mask
        return rows


class Sparse:
    """Rows for a bounded set of 64-bit keys; a bitmap turns most other keys away."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys  # ascending
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(keys & U((1 << 20) - 1)).astype(np.int64)] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the known ones among keys, and their rows."""
        at = np.flatnonzero(self.bits[(keys & U((1 << 20) - 1)).astype(np.int64)])
        if not len(self.keys) or not len(at):
            return at[:0], at[:0]
        row = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
        known = self.keys[row] == keys[at]
        return at[known], row[known]
