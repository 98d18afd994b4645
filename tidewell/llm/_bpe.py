"""Exact, batch-wise token ids of the two public tokenizer files in the `tokenizers` format.

The library itself needs several microseconds for every word of a text. Here a batch of texts
is cut into the tokenizer's own pre-tokens by comparing byte classes, each pre-token gets a
64-bit hash, and only pre-tokens that the worker hasn't met are given to the library's BPE
model. Texts with characters or special tokens outside the plain classes go through the library
as a whole, so the ids are the library's for every text.
"""

from __future__ import annotations

import functools
import json
import os

import numpy as np

from ._arrays import GROUP_BYTES, Table, U, gather, pieces, prefix_sums, span_hash

SPACE, BREAK, LETTER, DIGIT, OTHER, STOP, BAD = range(7)
_LATIN = np.full(256, BAD, np.uint8)
_LATIN[0x21:0x7F] = OTHER
_LATIN[0x30:0x3A] = DIGIT
_LATIN[0x20] = SPACE
_LATIN[[0x09, 0x0A, 0x0D]] = BREAK
for _a, _b in ((0x41, 0x5B), (0x61, 0x7B), (0xC0, 0xD7), (0xD8, 0xF7), (0xF8, 0x100)):
    _LATIN[_a:_b] = LETTER
_LATIN[0] = STOP  # between texts
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A or 0xC0 <= c <= 0xDE and c != 0xD7 else c for c in range(256))
#: Fixed values of both formats: the endings that are cut off after an apostrophe.
ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def byte_chars() -> list[str]:
    """The character that byte-level vocabularies use for each byte: itself if visible, else the next free one from 256."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(spare)) for b in range(256)]


class FastBPE:
    """encode(texts) -> ids of all texts as one array, and how many each text has.

    path: a tokenizer file. Words, where the file's pre-tokens drop white space and end words
    with a marker, else byte-level pre-tokens that keep a leading space. A None text counts as empty.
    """

    def __init__(self, path: str, table_bits: int = 21):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        spec = json.load(open(path))
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.words = bool(spec["model"].get("end_of_word_suffix"))
        self.chars = byte_chars()
        self.bits = table_bits
        self._forget()

    def _forget(self) -> None:
        self.table = Table(self.bits)
        rows = (1 << self.bits) // 2 + (1 << 18)
        self.at, self.len = np.zeros(rows, np.int64), np.zeros(rows, np.int32)
        self.flat, self.used = np.zeros(1 << 20, np.uint32), 0

    def _learn(self, keys: np.ndarray, new: list[bytes]) -> None:
        if self.table.full or self.table.n + len(keys) >= len(self.at) - 1:
            self._forget()
        ids = [self.pretoken(x) for x in new]
        rows = self.table.add(keys)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(size.sum()))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.at[rows], self.len[rows] = self.used + np.cumsum(size) - size, size
        self.used += len(flat)

    def pretoken(self, latin: bytes) -> list[int]:
        """Ids of one pre-token, given in Latin-1."""
        return [t.id for t in self.lib.model.tokenize("".join([self.chars[b] for b in latin.decode("latin-1").encode()]))]

    def whole(self, text: str) -> list[int]:
        """Ids of any text."""
        return self.lib.encode(text, add_special_tokens=False).ids

    def _starts(self, buf: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Where pre-tokens begin; text separators and, for words, white space count as beginnings that are no pre-token."""
        before = np.empty_like(kind)
        before[0], before[1:] = STOP, kind[:-1]
        change = kind != before
        solid = (kind >= LETTER) & (kind <= OTHER)
        if self.words:
            start = change | (kind == DIGIT)
            open_ = solid
        else:
            after = np.empty_like(kind)
            after[-1], after[:-1] = STOP, kind[1:]
            blank, was_blank = kind <= BREAK, before <= BREAK
            start = solid & change & (before != SPACE)
            start |= blank & (~was_blank | ((after >= LETTER) & (after <= OTHER)))
            start |= kind == STOP
            open_ = before != SPACE
        quote = np.flatnonzero((buf == 0x27) & change & open_)
        for tail in ENDINGS:
            q = quote[quote + len(tail) < len(buf)]
            for i, c in enumerate(tail):
                q = q[buf[q + 1 + i] == c]
            start[q + 1] = False
            on = q[kind[q + 1 + len(tail)] == LETTER] + 1 + len(tail)
            start[on] = True
            quote = np.setdiff1d(quote, q, assume_unique=True)
        return start

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        plain, odd = [], {}
        for i, text in enumerate(texts):
            try:
                latin = (text or "").encode("latin-1")
                if "<|" in (text or "") and any(s in text for s in self.special):
                    latin = None
            except UnicodeEncodeError:
                latin = None
            if latin is not None and latin.translate(None, _PLAIN):
                latin = None
            if latin is None:
                odd[i] = text
                latin = b""
            plain.append(latin.translate(_LOWER) if self.words else latin)
        flat, counts = self._plain(plain)
        if odd:
            split = np.split(flat, np.cumsum(counts)[:-1])
            for i, text in odd.items():
                split[i] = np.array(self.whole(text), np.uint32)
            flat, counts = np.concatenate(split), np.array([len(x) for x in split], np.int64)
        return flat, counts

    def _plain(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        out: list[np.ndarray] = []
        counts = np.zeros(len(texts), np.int64)
        for docs, held in pieces(texts) if self.words else _byte_pieces(texts):
            buf = np.frombuffer(b"\0".join(held) + b"\0", np.uint8)
            kind = _LATIN[buf]
            start = np.flatnonzero(self._starts(buf, kind))
            end = np.append(start[1:], len(buf))
            real = (kind[start] >= LETTER if self.words else kind[start] >= SPACE) & (kind[start] != STOP)
            start, end = start[real], end[real]
            keys = span_hash(prefix_sums(buf), start, end)
            keys[keys == 0] = 1
            row = self.table.find(keys)
            miss = row < 0
            if miss.any():
                new, first = np.unique(keys[miss], return_index=True)
                first = np.flatnonzero(miss)[first]
                data, n = buf.tobytes(), self.table
                self._learn(new, [data[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)])
                if n is not self.table:  # it was emptied: all of the group's pre-tokens have to be there
                    new, first = np.unique(keys[self.table.find(keys) < 0], return_index=True)
                    first = np.flatnonzero(self.table.find(keys) < 0)[first]
                    rows = [data[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
                    self._learn(new, rows)
                row = self.table.find(keys)
            size = self.len[row]
            out.append(gather(self.flat, self.at[row], size))
            total = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
            first = np.cumsum([0, *(len(x) + 1 for x in held)])
            np.add.at(counts, docs, np.diff(total[np.searchsorted(start, first)]))
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), counts


_PLAIN = bytes(c for c in range(1, 256) if _LATIN[c] != BAD)


def _byte_pieces(texts: list[bytes], limit: int = GROUP_BYTES):
    """As pieces(), but cuts are before a single space between visible characters, where a
    pre-token always begins; pieces of a text that stand in one group are joined again."""
    for docs, held in pieces(texts, limit, lone=True):
        fixed_docs, fixed = [], []
        for d, x in zip(docs.tolist(), held, strict=True):
            if fixed_docs and fixed_docs[-1] == d:
                fixed[-1] += x
            else:
                fixed_docs.append(d)
                fixed.append(x)
        yield np.array(fixed_docs), fixed


class CutBPE(FastBPE):
    """Byte-level BPE by forced boundaries.

    No merge can cross a byte pair that occurs inside no vocabulary token, so each pre-token is
    cut at all such pairs, the fragments are encoded independently and the ids concatenated.
    """

    def __init__(self, path: str, table_bits: int = 21):
        super().__init__(path, table_bits)
        back = {c: b for b, c in enumerate(self.chars)}
        self.inside = np.zeros((256, 256), bool)
        tokens: dict[int, bytes] = {}
        for token, i in self.vocab.items():
            raw = bytes(back[c] for c in token)
            tokens[i] = raw
            if len(raw) > 1:
                x = np.frombuffer(raw, np.uint8)
                self.inside[x[:-1], x[1:]] = True
        for token, i in self.special.items():
            tokens[i] = token.encode()
        self.joined = {self.chars[a] + self.chars[b] for a, b in zip(*np.nonzero(self.inside), strict=True)}
        size = np.array([len(tokens.get(i, b"")) for i in range(max(tokens) + 1)], np.int64)
        self.bytes_of = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(len(size))), np.uint8)
        self.byte_at, self.byte_len = np.cumsum(size) - size, size

    @functools.lru_cache(1 << 16)  # noqa: B019  one instance a worker
    def _fragment(self, chars: str) -> tuple[int, ...]:
        return tuple(t.id for t in self.lib.model.tokenize(chars))

    def fragments(self, chars: str) -> list[str]:
        """chars (byte characters) cut at every pair that no vocabulary token holds."""
        cuts = [0, *(i for i in range(1, len(chars)) if chars[i - 1 : i + 1] not in self.joined), len(chars)]
        return [chars[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _cut(self, chars: str) -> list[int]:
        return [i for x in self.fragments(chars) for i in self._fragment(x)]

    def pretoken(self, latin: bytes) -> list[int]:
        return self._cut("".join([self.chars[b] for b in latin.decode("latin-1").encode()]))

    def whole(self, text: str) -> list[int]:
        out: list[int] = []
        rest = text
        while rest:
            at, token = min(((rest.find(s), s) for s in self.special if s in rest), default=(len(rest), ""))
            if at:
                out += [i for chars, _ in self.lib.pre_tokenizer.pre_tokenize_str(rest[:at]) for i in self._cut(chars)]
            if token:
                out.append(self.special[token])
            rest = rest[at + len(token) :]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; bytes that are no UTF-8 become replacement characters."""
        return gather(self.bytes_of, self.byte_at[ids], self.byte_len[ids]).tobytes().decode("utf-8", "replace")


_encoders: dict[tuple[str, bool], FastBPE] = {}


def encoder(path: str, cut: bool = False) -> FastBPE:
    """The worker's encoder of a file; its table of pre-tokens stays from task to task."""
    key = (path, cut)
    if key not in _encoders:
        _encoders[key] = CutBPE(path) if cut else FastBPE(path)
    return _encoders[key]
