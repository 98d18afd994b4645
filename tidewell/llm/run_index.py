"""Removal of long repeated passages with run-length indexes (operator 13).

A window is a string of `window` bytes inside one document. Every window has an anchor: of its
grams of GRAM bytes, the one with the smallest hash, of equals the leftmost. Equal windows have
equal anchors at equal places, so repeats are looked for among the windows of one anchor only,
and an anchor that occurs once has none. Neighbouring windows mostly share their anchor; what
they cover together is a passage.

Passages are counted by anchor first, as two 64-bit hashes. Where an anchor has one passage only,
its first occurrence is new and all others are repeats. Where it has several, their texts are
collected once each, with the place of their first occurrence, and dealt to shards by anchor. A
shard's passages, in corpus order, are one repetitive text. Of its Burrows-Wheeler transform only
runs are kept, with the suffix-array samples at their ends. From these samples the matching
statistics of the text are streamed in text order: each position's longest match with the suffix
sorted before it, and where that stands. Matches of a window or more link positions to chains,
and all but the earliest window of a chain are repeats.

An anchor with very many passages would not fit into a shard: its windows are counted one by one
instead, with partial sums.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._arrays import U, gather, mix, prefix_sums, span_hash
from ._shared import small_batches, staged, unstage
from .bpe import slices
from .near_dup import _marked

WINDOW, GRAM = 100, 32
#: Bytes of passages of a shard; passages of an anchor beyond which its windows are counted one by one.
SHARD_BYTES, HEAVY = 1 << 20, 4096
#: Bytes of a batch, and windows that are hashed at a time.
_SLICE, _CHUNK = 1 << 20, 1 << 20


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column of strings or binaries without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` neighbours."""
    step = 1
    while step * 2 <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def passages(buf: np.ndarray, offsets: np.ndarray, window: int, gram: int, digests: bool = False) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same anchor in documents that stand in buf one after the other: the
    first window's place, how many windows, the anchor's hash, and with digests the hash of the
    bytes that they cover. Windows lie inside one document. Long texts are read in chunks; a run
    may end with one."""
    size = np.diff(offsets)
    fits = size >= window
    edge = np.zeros(len(buf) + 1, np.int32)
    np.add.at(edge, offsets[:-1][fits], 1)
    np.add.at(edge, offsets[1:][fits] - window + 1, -1)
    valid = np.cumsum(edge[:-1]) > 0
    out: list[tuple[np.ndarray, ...]] = []
    for at in range(0, len(buf) - window + 1, _CHUNK):
        part = buf[at : at + _CHUNK + window - 1]
        here = np.flatnonzero(valid[at : at + len(part) - window + 1])
        if not len(here):
            continue
        sums = prefix_sums(part)
        place = np.arange(len(part) - gram + 1)
        h = span_hash(sums, place, place + gram)
        low = U((1 << max(1, len(part).bit_length())) - 1)
        x = (_smallest((h & ~low) | place.astype(U), window - gram + 1)[here] & low).astype(np.int64)
        first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
        count = np.diff(np.append(first, len(x)))
        start = here[first]
        out.append((start + at, count, h[x[first]], *([span_hash(sums, start, start + count + window - 1)] if digests else [])))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), *[np.zeros(0, U)] * (1 + digests)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


class RunIndex:
    """Run-length Burrows-Wheeler transform of a text of passages, with suffix-array samples at run ends.

    Of each run are kept its letter, its first row, the text position of its first suffix and of
    the last suffix of the run before, and how long these two match. A passage ends in a letter
    of its own, smaller than all others, so matches lie inside passages.
    """

    def __init__(self, flat: np.ndarray, offsets: np.ndarray):
        size = np.diff(offsets)
        self.base = offsets[:-1] + np.arange(len(size))  # where passages begin in the text
        self.n = len(flat) + len(size)
        text = np.zeros(self.n, np.int64)
        ends = self.base + size
        body = np.ones(self.n, bool)
        body[ends] = False
        text[body] = flat.astype(np.int64) + 1
        end = np.repeat(ends, size + 1)
        longest = int(size.max(initial=0))
        word = self._words(text, end)
        sa = self._suffixes(word, end, longest)
        before = text[sa - 1]
        head = np.append(True, (before[1:] != before[:-1]) | (before[1:] == 0))
        self.rows = np.flatnonzero(head)
        self.letters = before[self.rows].astype(np.int16)
        first, last = sa[self.rows], np.where(self.rows > 0, sa[self.rows - 1], -1)
        order = np.argsort(first)
        self.first, self.last = first[order], last[order]
        self.match = self._common(text, word, end)

    @staticmethod
    def _words(text: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The first seven letters of each suffix in one integer; none beyond the passage's end."""
        word, place = np.zeros(len(text), np.int64), np.arange(len(text))
        for i in range(7):
            word = (word << 9) | text[np.minimum(place + i, end)]
        return word

    @staticmethod
    def _suffixes(word: np.ndarray, end: np.ndarray, longest: int) -> np.ndarray:
        """The suffix array; equal suffixes in text order. The ranks by so many letters, at each position
        and those many letters on, give the ranks by two or three times as many."""
        place, known = np.arange(len(word)), 7
        bits = max(1, len(word).bit_length())
        times = 3 if 3 * bits <= 63 else 2

        def ranks(key: np.ndarray) -> np.ndarray:
            order = np.argsort(key)
            ascending = key[order]
            rank = np.empty(len(key), np.int64)
            rank[order] = np.cumsum(np.append(0, ascending[1:] != ascending[:-1]))
            return rank

        rank = ranks(word)
        while known < longest and rank.max(initial=0) < len(word) - 1:
            key = rank
            for i in range(1, times):
                key = (key << bits) | rank[np.minimum(place + i * known, end)]
            rank = ranks(key)
            known *= times
        return np.sort((rank << bits) | place) & ((1 << bits) - 1)

    def _common(self, text: np.ndarray, word: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How many letters the suffixes at first and at last have in common, word by word and then letter by letter."""
        out = np.zeros(len(self.first), np.int64)
        at = np.flatnonzero(self.last >= 0)
        a, b = self.first[at], self.last[at]
        left = np.minimum(end[a] - a, end[b] - b)
        for values, step in ((word, 7), (text, 1)):
            on, same = np.arange(len(at)), out[at]
            while len(on):
                here = same[on]
                on = on[(here + step <= left[on])]
                here = same[on]
                on = on[values[a[on] + here] == values[b[on] + here]]
                same[on] += step
            out[at] = same
        return out

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For each position, in text order: the longest match with the suffix sorted before its own,
        and where that begins. From a run's sample on, the match gets shorter by one and moves on
        by one with each position, until the next sample."""
        place = np.arange(self.n)
        of = np.repeat(np.arange(len(self.first)), np.diff(np.append(self.first, self.n)))
        on = place - self.first[of]
        return self.match[of] - on, self.last[of] + on

    def repeated(self, window: int) -> np.ndarray:
        """Which positions begin a string of `window` letters that also begins at an earlier position."""
        length, before = self.statistics()
        place = np.arange(self.n)
        top = np.where(length >= window, before, place)
        while True:
            higher = top[top]
            if np.array_equal(higher, top):
                break
            top = higher
        earliest = np.empty(self.n, np.int64)
        earliest[top[::-1]] = place[::-1]  # of a chain, the smallest position is written last
        return place > earliest[top]


def _intervals(flags: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of maximal runs of true flags; a new run begins at each of breaks."""
    opens = np.zeros(len(flags) + 1, bool)
    opens[breaks] = True
    before = np.append(False, flags[:-1])
    start = np.flatnonzero(flags & (~before | opens[:-1]))
    after = np.append(flags[1:], False)
    end = np.flatnonzero(flags & (~after | opens[1:])) + 1
    return start, end - start


def _bitmap(keys: DataFrame, n: int) -> np.ndarray:
    """A bitmap of the keys' (n of them) last bits, 16 bits a key but 32 MB at most, made by
    aggregation. Where it fills up, more passages than necessary are looked at."""
    size = 1 << min(28, max(16, math.ceil(math.log2(16 * n + 1))))
    bit = keys.select((F.pmod("anchor", F.lit(size)) + 1).alias("bit"))
    maps = bit.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros((size >> 15, 4096), np.uint8)
    for r in maps.toLocalIterator():
        out[r.bucket - 1] = np.frombuffer(r.bits, np.uint8)
    return out.reshape(-1)


def _held(bitmap: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    bit = (anchors & U(8 * len(bitmap) - 1)).astype(np.int64)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


_KEY = "none boolean, id bigint, h bigint"


def _documents(docs: DataFrame) -> DataFrame:
    """none and id (whether doc_id is null, and doc_id or 0), h (the text's hash) and text (null: empty)."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))


def _anchors(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """anchor and several (whether it has more than one passage) of the anchors that occur more than once, a staged table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=_SLICE):
            _, _, anchor, digest = passages(*_flat(batch.column(0)), window, gram, digests=True)
            _, first, n = np.unique(mix(anchor) + digest, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_pydict({"anchor": pa.array(anchor[first].view(np.int64)), "digest": pa.array(digest[first].view(np.int64)), "n": pa.array(n.astype(np.int64))})

    found = rows.select("text").where(F.octet_length("text") >= window).mapInArrow(run, "anchor bigint, digest bigint, n bigint")
    counts = found.groupBy("anchor").agg(F.sum("n").alias("n"), F.min("digest").alias("lo"), F.max("digest").alias("hi"))
    return staged(counts.where("n > 1").select("anchor", (F.col("lo") != F.col("hi")).alias("several")), "anchors")


def _classes(rows: DataFrame, shared: Broadcast, window: int, gram: int) -> DataFrame:
    """The distinct passages of shared anchors, a staged table: anchor, passage (null where the anchor
    has no other), and first: the document, start and number of windows of the first occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, several = shared.value
        for batch in slices(batches, size=_SLICE):
            buf, offsets = _flat(batch.column(3))
            start, count, anchor = passages(buf, offsets, window, gram)
            some = _held(often, anchor)
            start, count, anchor = start[some], count[some], anchor[some]
            text = _held(several, anchor)
            size = np.where(text, count + window - 1, 0)
            ends = np.cumsum(np.append(0, size))
            flat = gather(buf, start[text], size[text])
            valid = pa.py_buffer(np.packbits(text, bitorder="little").tobytes())
            passage = pa.Array.from_buffers(pa.binary(), len(start), [valid, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])
            doc = np.searchsorted(offsets, start, side="right") - 1
            out = {c: batch.column(i).take(pa.array(doc)) for i, c in enumerate(("none", "id", "h"))}
            out |= {"start": pa.array((start - offsets[doc]).astype(np.int32)), "n": pa.array(count.astype(np.int32))}
            yield pa.RecordBatch.from_pydict({"anchor": pa.array(anchor.view(np.int64)), "passage": passage} | out)

    found = rows.where(F.octet_length("text") >= window).mapInArrow(run, f"anchor bigint, passage binary, {_KEY}, start int, n int")
    return staged(found.groupBy("anchor", "passage").agg(F.min(F.struct("none", "id", "h", "start", "n")).alias("first")), "passages")


def _new(classes: DataFrame, window: int, shard_bytes: int, heavy: int) -> DataFrame:
    """The windows under shared anchors that are the first of their kind, as runs: none, id, h, start, n; a staged table."""
    lone = classes.where("passage is null").select("first.*")
    several = classes.where("passage is not null").select("anchor", "passage", "first.*")
    many = several.groupBy("anchor").count().where(F.col("count") > heavy).select("anchor")
    marked = _marked(several, "anchor", many, many.count())
    usual, crowded = marked.where("not likely").drop("likely"), marked.where("likely").drop("likely")

    i = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    windows = crowded.select("none", "id", "h", "start", "passage", i.alias("i")).select(F.struct("none", "id", "h", (F.col("start") + F.col("i")).alias("start"), F.lit(1).alias("n")).alias("at"), F.expr(f"substring(passage, i + 1, {window})").alias("w"))
    single = windows.groupBy("w").agg(F.min("at").alias("first")).select("first.*")

    def run(table: pa.Table) -> pa.Table:
        none, id_, h, start = (table.column(c).to_numpy() for c in ("none", "id", "h", "start"))
        order = np.lexsort((start, h, id_, none))
        flat, offsets = _flat(table.column("passage").combine_chunks())
        size = np.diff(offsets)[order]
        flat = gather(flat, offsets[:-1][order], size)
        index = RunIndex(flat, np.append(0, np.cumsum(size)))
        windows = size - window + 1
        base = np.cumsum(windows) - windows
        fresh = ~index.repeated(window)[gather(np.arange(index.n), index.base, windows)]
        at, n = _intervals(fresh, base)
        of = np.searchsorted(base, at, side="right") - 1
        row = order[of]
        return pa.table({"none": none[row], "id": id_[row], "h": h[row], "start": (start[row] + at - base[of]).astype(np.int32), "n": n.astype(np.int32)})

    size = several.agg(F.sum(F.octet_length("passage"))).first()[0] or 0
    shard = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-size // shard_bytes))))
    found = usual.withColumn("shard", shard).groupBy("shard").applyInArrow(run, f"{_KEY}, start int, n int")
    return staged(lone.unionAll(found).unionAll(single), "first-windows")


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, texts: bool = True, shard_bytes: int = SHARD_BYTES, heavy: int = HEAVY) -> DataFrame:
    """Removes each byte that is covered by a string of `window` bytes which also starts earlier: in a
    document with a smaller doc_id, or further ahead in its own. Strings lie inside one document,
    and the input decides, not what is left.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of the bytes
    that are left), and if texts, kept (these bytes; cuts may fall inside a character) and spans
    (start and end of the removed runs). Null text counts as empty: nothing is removed from it, as
    from any text shorter than a window. Rows without doc_id come last. Rows that repeat a doc_id
    are documents of their own, in the order of their texts' hashes; of equal rows one is the
    first, and the others are repeats as a whole if they have a window. An empty table gives an
    empty result. Further columns aren't read.

    Two things are decided by hashes: that an anchor's occurrences have all the same bytes around
    them (128 bits), and which rows are the same (doc_id and 64 bits). Two bitmaps of at most
    32 MB are broadcast, whatever the size of the input.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = _documents(docs)
    anchors = _anchors(rows, window, gram)
    n = {r.several: r["count"] for r in anchors.groupBy("several").count().collect()}
    maps = _bitmap(anchors, sum(n.values())), _bitmap(anchors.where("several"), n.get(True, 0))
    shared = spark.sparkContext.broadcast(maps)
    unstage(anchors)
    classes = _classes(rows, shared, window, gram)
    new = _new(classes, window, shard_bytes, heavy)
    unstage(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value[0]
        for batch in slices(batches, size=_SLICE):
            buf, offsets = _flat(batch.column(3))
            start, count, anchor = passages(buf, offsets, window, gram)
            some = _held(often, anchor)
            change = np.zeros(len(buf) + 1, np.int32)
            np.add.at(change, start[some], 1)
            np.add.at(change, start[some] + count[some], -1)
            known = batch.column(4)
            entries = known.flatten()
            doc = np.repeat(np.arange(batch.num_rows), np.diff(known.offsets.to_numpy()))
            first = offsets[doc] + entries.field(0).to_numpy()
            own = np.zeros(len(buf) + 1, np.int32)
            np.add.at(own, first, 1)
            np.add.at(own, first + entries.field(1).to_numpy(), -1)
            again = np.flatnonzero((np.cumsum(change[:-1]) > 0) & (np.cumsum(own[:-1]) == 0))
            cover = np.zeros(len(buf) + 1, np.int32)
            cover[again] += 1
            cover[again + window] -= 1
            removed = np.cumsum(cover[:-1]) > 0
            at, length = _intervals(removed, offsets[:-1])
            ends = np.append(0, np.cumsum(removed))[offsets]
            spans = np.searchsorted(at, offsets)
            kept, edges = buf[~removed].tobytes(), (offsets - ends).tolist()
            left = [kept[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
            ids = pa.compute.if_else(batch.column(0), pa.scalar(None, pa.int64()), batch.column(1))
            out = {"doc_id": ids, "copies": batch.column(2), "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(np.diff(ends)), "n_spans": pa.array(np.diff(spans).astype(np.int64))}
            out["kept_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string())
            if texts:
                of = np.searchsorted(offsets, at, side="right") - 1
                ranges = pa.StructArray.from_arrays([pa.array(at - offsets[of]), pa.array(at + length - offsets[of])], ["start", "end"])
                out |= {"kept": pa.array(left, pa.binary()), "spans": pa.ListArray.from_arrays(pa.array(spans.astype(np.int32)), ranges)}
            yield pa.RecordBatch.from_pydict(out)

    key = ["none", "id", "h"]
    own = new.groupBy(*key).agg(F.collect_list(F.struct("start", "n")).alias("new"))
    single = rows.groupBy(*key).agg(F.count("*").alias("copies"), F.first("text").alias("text"))
    empty = F.array().cast("array<struct<start:int,n:int>>")
    both = single.join(own, key, "left").select("none", "id", "copies", "text", F.coalesce("new", empty).alias("new"))
    schema = "doc_id bigint, copies bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary, spans array<struct<start:bigint,end:bigint>>" * texts
    done = both.mapInArrow(run, schema)
    # of equal rows, all but one are repeats of the first
    nth = F.explode(F.sequence(F.lit(1), F.col("copies")))
    whole = (F.col("nth") > 1) & (F.col("n_bytes") >= window)
    out = done.select("*", nth.alias("nth")).select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"), F.when(whole, F.lit(1).cast("bigint")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(whole, F.sha2(F.lit(b""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        *([F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"), F.when(whole, F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("end")))).otherwise(F.col("spans")).alias("spans")] if texts else []),
    )
    return out
