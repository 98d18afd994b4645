"""Order-preserving packing of documents into training sequences (operator 1)."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ._bpe import encoder
from ._shared import in_key_order, small_batches
from .bpe import slices

#: Cost, in tokens of padding, of a sequence that ends inside a document at the end of a
#: sentence, of one that ends inside a sentence, and of any further sequence.
SENTENCE, INSIDE, SEQUENCE = 8, 64, 16
#: Shortest power of two that is taken as a whole sequence.
SHORTEST = 256
#: Ids that are packed at a time.
BLOCK = 1 << 19


def best_cuts(at: np.ndarray, cost: np.ndarray, window: int, shortest: int = SHORTEST, each: int = SEQUENCE) -> list[int]:
    """Indices into at (ascending places where a sequence may end; the first is 0, the last the
    end) at which sequences end so that the sum of padding and penalties is least.

    The cost of a sequence from j to i is window - (at[i] - at[j]), or 0 if its length is a power
    of two of at least `shortest`, plus cost[i] + each. Its first form depends on j by a sum
    only, so the best j of the sliding window is the head of a monotone queue. No two
    neighbouring places may be further apart than the window.
    """
    n = len(at)
    places, costs = at.tolist(), cost.tolist()
    short: dict[int, list[int]] = {}
    size = shortest
    while size < window:
        j = np.searchsorted(at, at - size)
        for i in np.flatnonzero(at[j] == at - size).tolist():
            short.setdefault(i, []).append(int(j[i]))
        size *= 2
    total, back = [0] * n, [0] * n
    queue: deque[tuple[int, int, int]] = deque()
    for i in range(1, n):
        here = places[i]
        value = total[i - 1] + places[i - 1]
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, i - 1, places[i - 1]))
        while here - queue[0][2] > window:
            queue.popleft()
        best, j = queue[0][0] + window - here, queue[0][1]
        if i in short:
            for k in short[i]:
                if total[k] < best:
                    best, j = total[k], k
        total[i], back[i] = best + costs[i] + each, j
    cuts, i = [], n - 1
    while i > 0:
        cuts.append(i)
        i = back[i]
    return cuts[::-1]


class _Packer:
    """Packs one partition's documents, block after block; what a block's last sequences hold goes to the next block."""

    def __init__(self, window: int, first_sequence: int, ends: np.ndarray):
        self.window, self.sequence, self.ends = window, first_sequence, ends
        self.docs: list[tuple[object, int, int, np.ndarray]] = []  # doc_id, ids before these, ids of the document, ids
        self.held = 0

    def add(self, doc_id: object, ids: np.ndarray) -> None:
        self.docs.append((doc_id, 0, len(ids), ids))
        self.held += len(ids)

    def places(self, ids: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where sequences may end, and at what cost: ends of documents and of sentences, and every
        window's length where these are further apart."""
        sentence = np.flatnonzero(self.ends[ids]) + 1
        at = np.unique(np.concatenate([[0], edge, sentence]))
        wide = np.flatnonzero(np.diff(at) > self.window)
        if len(wide):
            at = np.unique(np.concatenate([at, *(np.arange(at[w], at[w + 1], self.window) for w in wide)]))
        cost = np.full(len(at), INSIDE)
        cost[np.isin(at, sentence, assume_unique=True)] = SENTENCE
        cost[np.searchsorted(at, edge)] = 0
        return at, cost

    def flush(self, last: bool) -> list[tuple]:
        """Pieces of the sequences that are settled, or of all."""
        ids = np.concatenate([x[3] for x in self.docs])
        edge = np.cumsum([len(x[3]) for x in self.docs])
        at, cost = self.places(ids, edge)
        ends = at[best_cuts(at, cost, self.window)]
        if not last:
            settled = ends[ends <= len(ids) - 4 * self.window]
            ends = settled if len(settled) else ends[:1]
        done = int(ends[-1])
        cuts = np.unique(np.concatenate([ends, edge[edge < done]]))
        starts = np.append(0, cuts[:-1])
        doc = np.searchsorted(edge, starts, side="right")
        seq = np.searchsorted(ends, starts, side="right")
        seq_start = np.append(0, ends)[seq]
        doc_start = np.append(0, edge)[doc]
        out = []
        for a, b, d, s, sa, da in zip(starts.tolist(), cuts.tolist(), doc.tolist(), seq.tolist(), seq_start.tolist(), doc_start.tolist(), strict=True):
            doc_id, before, total, _ = self.docs[d]
            out.append((doc_id, before + a - da, b - a, ids[a:b], total, self.sequence + s, a - sa))
        self.sequence += len(ends)
        d = int(np.searchsorted(edge, done, side="right"))
        rest = self.docs[d:]
        if rest:
            doc_id, before, total, own = rest[0]
            skip = done - (int(edge[d - 1]) if d else 0)
            rest[0] = (doc_id, before + skip, total, own[skip:])
        self.docs, self.held = rest, len(ids) - done
        return out


def sentence_ends(vocab: dict[str, int], size: int) -> np.ndarray:
    """Which ids end a sentence: tokens of .!? and closing quotes or brackets only."""
    out = np.zeros(size, bool)
    for token, i in vocab.items():
        body = token.removesuffix("</w>")
        if body and set(body) <= set(".!?\"')]") and set(body) & set(".!?"):
            out[i] = True
    return out


def pack(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, text: str = "text", key: str = "doc_id", block: int = BLOCK, ids: bool = True) -> DataFrame:
    """Packs all documents, in ascending key order, into sequences of at most `window` ids.

    A document's ids are those of its whole text, then end_id; null text counts as empty. Each
    id lies in exactly one piece. Returns a row a piece: key, start (the document's ids before
    it), length, ids_crc32, doc_tokens, sequence_id, offset (in the sequence) and, if asked for,
    ids. Sequence ids are unique; their upper bits are the task's partition, so no count has to
    be known beforehand. Documents are range-partitioned once by key; cuts are chosen by
    best_cuts() over blocks of bounded size, and the last few sequences of a block are chosen
    anew with the next, so memory doesn't grow with a partition. Null keys come first; rows that
    repeat a key are packed as documents of their own, in the order of their texts. An empty
    table gives no piece.
    """

    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        ends = sentence_ends(enc.vocab, max(*enc.vocab.values(), *enc.special.values(), end_id) + 1)
        ends[end_id] = False
        packer = _Packer(window, TaskContext.get().partitionId() << 32, ends)
        for batch in slices(batches):
            flat, counts = enc.encode(batch.column(1).to_pylist())
            for doc_id, own in zip(batch.column(0).to_pylist(), np.split(flat, np.cumsum(counts)[:-1]), strict=True):
                packer.add(doc_id, np.append(own, np.uint32(end_id)))
                if packer.held >= block:
                    yield rows(packer.flush(False))
        if packer.docs:
            yield rows(packer.flush(True))

    kind = docs.schema[key].dataType

    def rows(pieces: list[tuple]) -> pa.RecordBatch:
        doc_id, start, length, own, total, sequence, offset = zip(*pieces, strict=True)
        out = {key: pa.array(doc_id, to_arrow)}
        out |= {n: pa.array(x, pa.int64()) for n, x in (("start", start), ("length", length), ("ids_crc32", [zlib.crc32(x.astype("<u4").tobytes()) for x in own]), ("doc_tokens", total), ("sequence_id", sequence), ("offset", offset))}
        if ids:
            out["ids"] = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *length]), pa.int32()), pa.array(np.concatenate(own).astype(np.int32)))
        return pa.RecordBatch.from_pydict(out)

    from pyspark.sql.pandas.types import to_arrow_type

    to_arrow = to_arrow_type(kind)
    schema = f"`{key}` {kind.simpleString()}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint" + ", ids array<int>" * ids
    return in_key_order(docs, key, text).mapInArrow(run, schema)
