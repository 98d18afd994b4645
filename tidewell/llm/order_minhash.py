"""Order MinHash fingerprints (operator 3).

For each of m hash functions, the l smallest k-mers of a text are selected, where the i-th
occurrence of a k-mer counts as a k-mer of its own; they are put back into the order of the
text and their tuple is hashed. Two texts agree in a tuple if they share the k-mers and their
order, so the share of equal tuples falls with the edit distance, also when blocks only move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._arrays import U, mix, powers
from ._shared import small_batches
from .bpe import slices

K, TUPLE, HASHES = 6, 2, 64
_RNG = np.random.Generator(np.random.PCG64(77))
_ODD = _RNG.integers(1, 1 << 31, 1 << 10, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(1, 1 << 31, 1 << 10, dtype=np.uint32)


def numbered_kmers(x: np.ndarray, k: int = K) -> np.ndarray:
    """64-bit hashes of the k-mers of code points, each with its occurrence number, in the order
    of the text. A text shorter than k is one k-mer."""
    k = min(k, len(x))
    if not k:
        return np.zeros(0, U)
    h = x[: len(x) - k + 1].astype(U)
    for i in range(1, k):
        h = h * U(0x9E3779B97F4A7C15) + x[i : len(x) - k + 1 + i]
    h = mix(h + U(k))
    n = len(h)
    bits = max(1, int(n).bit_length())
    # sorting (hash, place) in one word; the place's bits cost as many of the hash's
    if bits <= 20:
        low = U((1 << bits) - 1)
        word = np.sort((h & ~low) | np.arange(n, dtype=U))
        order, key = (word & low).astype(np.int64), word & ~low
    else:
        order = np.argsort(h, kind="stable")
        key = h[order]
    new = np.append(True, key[1:] != key[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    number = np.empty(n, U)
    number[order] = (np.arange(n) - first).astype(U)
    return mix(h ^ (number * U(0xC2B2AE3D27D4EB4F)))


def signature(x: np.ndarray, k: int = K, size: int = TUPLE, hashes: int = HASHES) -> np.ndarray:
    """The m tuple hashes (32 bits each) of a text's code points; all 0 for an empty text.

    A text with fewer numbered k-mers than a tuple needs gives tuples of those it has.
    """
    h = numbered_kmers(x, k)
    if not len(h):
        return np.zeros(hashes, np.uint32)
    low = (h >> U(32)).astype(np.uint32)
    l = min(size, len(h))
    out = np.zeros(hashes, U)
    step = max(1, min(hashes, (1 << 16) // len(low)))
    for at in range(0, hashes, step):
        to = min(hashes, at + step)
        rank = low[None, :] * _ODD[at:to, None]
        rank += _ADD[at:to, None]
        row = np.arange(to - at)
        picked = np.empty((l, to - at), np.int64)
        for i in range(l):
            picked[i] = rank.argmin(1)
            rank[row, picked[i]] = np.uint32(0xFFFFFFFF)
        picked.sort(axis=0)
        value = np.zeros(to - at, U)
        for i in range(l):
            value = mix(value * U(0x9E3779B97F4A7C15) + h[picked[i]])
        out[at:to] = value
    return np.maximum((out >> U(32)).astype(np.uint32), 1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal tuples, 0 to 1; two empty texts are alike."""
    return float((a == b).mean())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


#: Bytes of text that a range of the ring should hold about; ranges at most; sampled ids for each range.
RANGE_BYTES, RANGES, SAMPLED = 16 << 20, 1 << 16, 20


def ring_bounds(docs: DataFrame, ranges: int) -> np.ndarray:
    """The largest id of each of about so many ranges of doc_id, descending: ids of a sample, and the
    largest of all. SAMPLED ids a range come to the driver, as Spark takes for its own range exchanges."""
    known = docs.select("doc_id").where("doc_id is not null")
    total = known.agg(F.count("*").alias("n"), F.max("doc_id").alias("last")).first()
    if not total.n:
        return np.zeros(0, np.int64)
    share = min(1.0, SAMPLED * ranges / total.n)
    sample = np.array([total.last, *(r[0] for r in (known.sample(share, 7) if share < 1 else known).toLocalIterator())], np.int64)
    sample.sort()
    return np.unique(sample[np.linspace(0, len(sample) - 1, ranges + 1).round().astype(np.int64)[1:]])[::-1]


def in_ring(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """docs (doc_id, text) as rows (part, ghost, doc_id, text), hash-partitioned by part and
    sorted within it, where each part is a range of doc_id in descending order and its ghost row
    repeats the first document of the following part; the last part's is the first of all.

    There are as many ranges as the texts' bytes ask for, up to RANGES: a range is streamed, so it
    may hold more than a task's memory. Their bounds are data, half a megabyte at most, which is
    broadcast; the plan is the same whatever their number, texts are shuffled once, and no task
    sees more than a few ranges. Rows with the same doc_id stand in one range, ordered by text,
    and so do rows without one, at the end: ids should tell most rows apart.
    """
    spark = docs.sparkSession
    small_batches(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if ranges is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        ranges = min(RANGES, max(4 * tasks, -(-size // RANGE_BYTES)))
    bounds = ring_bounds(docs, ranges)
    last = max(0, len(bounds) - 1)
    shared = spark.sparkContext.broadcast(bounds[::-1].copy())

    def place(ids: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """The range of each id, and whether it is the largest of its range; null ids come last. Without
        any id, the first row of the ring is the first of the only range: all rows are ghosts too."""
        up = shared.value
        for batch in ids:
            id_ = batch.fill_null(0).to_numpy(zero_copy_only=False)
            none = batch.is_null().to_numpy(zero_copy_only=False)
            at = np.searchsorted(up, id_)
            part = np.where(none, last, last - at)
            opens = (up[np.minimum(at, last)] == id_) & ~none if len(up) else np.ones(len(id_), bool)
            yield pa.StructArray.from_arrays([pa.array(part.astype(np.int32)), pa.array(opens)], ["part", "opens"])

    # not deterministic: so that Spark evaluates it in one place only
    placing = F.arrow_udf(place, "struct<part:int,opens:boolean>").asNondeterministic()
    text = F.coalesce("text", F.lit("")).alias("text")
    placed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text).select("doc_id", "text", placing("doc_id").alias("x")).select("doc_id", "text", "x.part", "x.opens")
    ghost_of = F.when(F.col("opens"), F.when(F.col("part") == 0, F.lit(last)).otherwise(F.col("part") - 1))
    spots = F.array_compact(F.array(F.struct(F.col("part").alias("part"), F.lit(0).alias("ghost")), F.when(ghost_of.isNotNull(), F.struct(ghost_of.alias("part"), F.lit(1).alias("ghost")))))
    out = placed.select(F.explode(spots).alias("at"), "doc_id", "text").select("at.part", "at.ghost", "doc_id", "text")
    return out.repartition(max(tasks, len(bounds) // 4), "part").sortWithinPartitions("part", "ghost", F.col("doc_id").desc_nulls_last(), "text")


def fingerprints(docs: DataFrame, k: int = K, size: int = TUPLE, hashes: int = HASHES, ranges: int | None = None) -> DataFrame:
    """Fingerprints every whole text and its edited text, in which the last floor(n_chars / 2)
    code points are replaced by the first as many (or all) of the next document, by descending
    doc_id; after the last comes the first.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hexadecimal),
    near_edited and near_next (likeness of the text's fingerprint to those of the edited text and
    of the next document). Null text counts as empty. Null ids come last; rows that repeat an id
    are documents of their own, ordered by text. A lone document is its own next one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # part, doc_id, text, its signature
        sign = lambda text: signature(code_points(text), k, size, hashes)
        hexed = lambda s: s.astype(">u4").tobytes().hex()
        for batch in slices(batches, 500):
            rows = []
            for part, ghost, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0] != part:
                    raise ValueError("a part without the row that follows it")
                if held is None and ghost:
                    continue  # a further row with the id of the following part's first one
                own = sign(text)
                if held:
                    _, before, old, sig = held
                    half = len(old) // 2
                    edited = old[: len(old) - half] + text[:half]
                    other = sig if edited == old else sign(edited)
                    rows.append((before, len(old), hashlib.sha256(edited.encode()).hexdigest(), hexed(sig), hexed(other), likeness(sig, other), likeness(sig, own)))
                held = None if ghost else (part, doc_id, text, own)
            cols = list(zip(*rows, strict=True)) or [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)
        if held:
            raise ValueError("a part without the row that follows it")

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_ring(docs, ranges).mapInArrow(run, schema)
