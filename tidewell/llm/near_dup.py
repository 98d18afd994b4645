"""MinHash near-duplicates by bottom-k sketches (operator 5).

A document's set holds its distinct word shingles; one hash function orders all shingles, and a
document's sketch is the k smallest of its set. Inverted lists of retained values give pairs
with overlaps, bit maps of the sketches bound what two of them can share, and the full sets decide.
Equal sets are one class beforehand; lists, pairs and links are between classes.

Nothing is lost to frequent values: two sets that are similar enough share at least `need`
retained values, so they also share one that isn't among the need - 1 most frequent of either.
Only the others are listed. Where both sets fit into their sketches, `need` is the exact overlap
for the two sizes, and lists are kept apart by the smaller size: sets that share a template but
not enough of it stand in no common list.

Of a list with few members, all pairs are compared. Of a longer one, every member is compared
with one of them, the pivot; links merge labels, and a second pivot takes the rest. If then a list
of sets that don't fit into their sketches still has several labels, and more members than a
block, these may have no more in common than a template. They are listed once more by larger sketches, in which a similar pair
shares a greater part for sure: sets that only share a template stand in no common list again.
Members of a list that then still has several labels meet in blocks, where only those outside
the list's largest label are compared with others. First their sketches meet, and only members
that may be like one of another label go on; then full sets meet, in blocks bounded by bytes. Of
a block come members and links, never pairs of a list.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._arrays import Tokens, U, mix, pair_hash
from ._shared import heavy_limit, small_batches, spread_join, staged, unstage
from .bpe import slices
from .components import components

K, PERCENT, WIDTH = 64, 80, 5
#: Members of a list of which all pairs are compared; pivots of a longer one; members and bytes of a block.
FEW, PIVOTS, MEMBERS, BYTES = 8, 2, 512, 2 << 20
#: Values of a larger sketch, and by how many percent of them a similar pair may fall below the
#: threshold: at 0.8, more than 6 standard deviations, once in 10**9 pairs.
WIDE, SLACK = 1024, 8
#: Bits of a sketch's bit map.
SIGN = 512
_SLICE = 2 << 20


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """For each text, the ascending distinct hashes of its shingles of `width` words; of fewer
    words, the one of all of them; of none, none. Words are runs of anything but the six ASCII
    white-space characters, with A-Z lower-cased."""
    return _sets([(t or "").encode().lower() for t in texts], width)


def _packed(text: str | None) -> bytes:
    """A text from which its set is made again: about a third of the set's bytes, whose hashes can't be compressed."""
    return zlib.compress((text or "").encode().lower(), 1)


def _unpacked(packed: Iterable[pa.Scalar], width: int) -> Iterator[np.ndarray]:
    """The sets of packed texts, made of a few megabytes of text at a time; of one that follows itself, once."""
    texts, at, size, last = [], [], 0, None
    for x in packed:
        now = x.as_py()
        if now != last:
            if size > _SLICE:
                sets = _sets(texts, width)
                yield from (sets[i] for i in at)
                texts, at, size = [], [], 0
            texts.append(zlib.decompress(now))
            size, last = size + len(texts[-1]), now
        at.append(len(texts) - 1)
    sets = _sets(texts, width) if texts else []
    yield from (sets[i] for i in at)


def _sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    tokens = Tokens(texts)
    h, at = tokens.hash, tokens.offsets
    key = h.copy()
    for i in range(1, min(width, len(h))):
        key[: len(h) - i] = pair_hash(key[: len(h) - i], h[i:])
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            own = key[a : b - width + 1]
        elif b > a:
            whole = h[a : a + 1]
            for i in range(a + 1, b):
                whole = pair_hash(whole, h[i : i + 1])
            own = mix(whole + U(b - a))
        else:
            own = h[:0]
        own = np.sort(own.view(np.int64))
        out.append(own[np.append(True, own[1:] != own[:-1])] if len(own) else own)
    return out


def _mark(own: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that, with the size, tell sets apart."""
    u = own.view(U)
    return int(mix(u).sum(dtype=U).view(np.int64)), int(mix(u ^ U(0x9E3779B97F4A7C15)).sum(dtype=U).view(np.int64))



def _scan(docs: DataFrame, width: int, extra: str, value) -> DataFrame:
    """doc_id, n (set size), s1 and s2 (sums that tell sets apart) of each row, and a further column (extra: its name and type) that value makes of the texts and sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=_SLICE):
            texts = batch.column(1).to_pylist()
            sets = shingle_sets(texts, width)
            sums = [_mark(x) for x in sets]
            out = {"doc_id": batch.column(0).cast(pa.int64()), "n": pa.array(map(len, sets), pa.int64()), "s1": pa.array([s for s, _ in sums], pa.int64()), "s2": pa.array([s for _, s in sums], pa.int64())}
            yield pa.RecordBatch.from_pydict(out | {extra.split()[0]: value(texts, sets)})

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id bigint, n bigint, s1 bigint, s2 bigint, {extra}")


#: A class's number: two different sets have the same one time in 2**64.
_CLASS = F.xxhash64


def sketches(docs: DataFrame, width: int, k: int) -> DataFrame:
    """doc_id, n, s1, s2, sketch (the k smallest hashes) and c (the class) of each row."""

    def value(_, sets: list[np.ndarray]) -> pa.Array:
        low = [x[:k] for x in sets]
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, low)]), pa.int32()), pa.array(np.concatenate(low) if low else np.zeros(0, np.int64)))

    return _scan(docs, width, "sketch array<bigint>", value).withColumn("c", _CLASS("n", "s1", "s2"))


def _marked(rows: DataFrame, key: str, wanted: DataFrame, n: int) -> DataFrame:
    """rows with likely: true where the key is null or one of wanted (its only column; n rows), and in a few other rows.

    A bitmap with 16 bits for each wanted key, made by aggregation and broadcast (32 MB at most),
    turns other rows away before they are read further or shuffled. It only saves work: where it
    fills up, more rows pass.
    """
    size = 1 << min(28, max(16, math.ceil(math.log2(16 * n + 1))))
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(size)) + 1
    ids = wanted.select(bit(F.col(wanted.columns[0])).alias("bit"))
    maps = ids.groupBy(F.bitmap_bucket_number("bit").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("_bits"))
    place = F.bitmap_bit_position(bit(F.col(key)))
    octet = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    there = (F.bitmap_bucket_number(bit(F.col(key))) == F.col("_bucket")) & (F.getbit(octet, (place % 8).cast("int")) == 1)
    known = rows.join(F.broadcast(maps), there, "left")
    return known.select(*rows.columns, (F.col("_bucket").isNotNull() | F.col(key).isNull()).alias("likely"))


def _likely(rows: DataFrame, key: str, wanted: DataFrame, n: int) -> DataFrame:
    """The rows that _marked() marks."""
    return _marked(rows, key, wanted, n).where("likely").drop("likely")


def full_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """c and own (the text of the whole set, see _packed()) of the classes in wanted (c). They lie by c, so that what joins them by
    it, also several times in one query, shuffles them no further; a table of them would be."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    n = wanted.count()
    firsts = _likely(classes.select("c", "first"), "c", wanted, n).join(wanted, "c", "left_semi").select("first")
    found = _scan(_likely(texts, "doc_id", firsts, n), width, "own binary", lambda texts, _: pa.array([_packed(x) for x in texts], pa.binary()))
    found = found.select(_CLASS("n", "s1", "s2").alias("c"), "own").join(wanted, "c", "left_semi")
    return found.groupBy("c").agg(F.max("own").alias("own"))


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def _ends(pairs: DataFrame) -> DataFrame:
    """The distinct classes of pairs (a, b)."""
    return pairs.select(F.col("a").alias("c")).unionAll(pairs.select(F.col("b").alias("c"))).distinct()


def _overlap(n: Column, m: Column, percent: int) -> Column:
    """The least number of common values of sets of n and m values that are similar enough."""
    return F.ceil(percent * (n + m) / F.lit(100.0 + percent))


def _shared_values(rows: DataFrame) -> DataFrame:
    """c and shared: its values with their counts (rows: c, v, count), rarest first. Rows travel as they are: as
    partial lists, of one value each, they would take twice as much."""
    return rows.select("c", "count", "v").repartition("c").groupBy("c").agg(F.array_sort(F.collect_list(F.struct("count", "v"))).alias("shared"))


def listed(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """The inverted lists, a staged table: v (the value), m (the size of the smaller set of a pair that the list is
    for, 0 for sets of which one may not fit into its sketch), c, n, small (n is m, or m is 0), and heavy (whether
    so many classes retain v that its lists are dealt to several tasks).

    A set as the smaller of a pair has the need of a pair with its own size, or, as equal sets are
    one class, with the next; as the larger, that of a pair with m.
    """
    postings = classes.select("c", F.explode("sketch").alias("v"))
    often = staged(postings.groupBy("v").agg(F.count("*").alias("count")).where("count > 1"), "often")
    limit = heavy_limit(classes.count())
    known = _likely(postings, "v", often.select("v"), often.count())
    shared = _shared_values(spread_join(known, often, ["v"], "c", often, limit))
    full = k * percent // 100
    n, has = F.col("n"), F.size("shared")
    alike = _overlap(n, n, percent)
    small = F.when(alike < n, alike).when((100 * n >= percent * (n + 1)) & (_overlap(n, n + 1, percent) <= n), _overlap(n, n + 1, percent)).otherwise(F.lit(k + 1))
    # of larger ones, as in _estimated(), pairs are given up that share 30 % of k less than the threshold lets expect
    wide = F.lit(max(1, k * (percent - 30) // 100))
    entry = lambda m, small, need: F.struct(m.cast("int").alias("m"), small.alias("small"), (has - need + 1).cast("int").alias("room"))
    low, high = F.ceil(n * percent / 100.0).cast("int"), F.least(n - 1, F.lit(full)).cast("int")
    below = F.when((low <= high) & (low > 0), F.transform(F.sequence(low, high), lambda m: entry(m, F.lit(False), _overlap(n, m, percent)))).otherwise(F.array().cast("array<struct<m:int,small:boolean,room:int>>"))
    own = F.when(n <= full, entry(n, F.lit(True), small)).otherwise(entry(F.lit(0), F.lit(True), wide))
    rooms = F.filter(F.concat(F.array(own), below), lambda x: x["room"] > 0)
    rows = shared.join(classes.select("c", "n"), "c").select("c", "n", "shared", F.explode(rooms).alias("x"))
    out = staged(rows.select("c", "n", "x.m", "x.small", F.explode(F.slice("shared", F.lit(1), F.col("x.room"))).alias("s")).select(F.col("s.v").alias("v"), "m", "c", "n", "small", (F.col("s.count") > limit).alias("heavy")), "index")
    unstage(often)
    return out


def _listed_again(members: DataFrame, docs: DataFrame, classes: DataFrame, width: int, percent: int, wide: int) -> DataFrame:
    """p, c, n and label of the members (c, n, label; one row a class) that share a value of their larger
    sketches with one of another label, where p names the shared lists; a staged table.

    A set lists its rarest values, all but need - 1 of those that others have too. A similar pair
    shares at least percent of the values of each of its sets where both fit into the larger
    sketch, and SLACK less otherwise.
    """
    sets = full_sets(docs, classes, members.select("c"), width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=_SLICE):
            low = [x[:wide] for x in _unpacked(batch.column(1), width)]
            values = pa.array(np.concatenate(low) if low else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_pydict({"c": batch.column(0), "sketch": pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, low)]), pa.int32()), values)})

    postings = sets.mapInArrow(run, "c bigint, sketch array<bigint>").select("c", F.explode("sketch").alias("v"))
    postings = staged(postings, "wide")
    often = staged(postings.groupBy("v").agg(F.count("*").alias("count")).where("count > 1"), "often")
    limit = heavy_limit(members.count())
    shared = _shared_values(spread_join(postings, often, ["v"], "c", often, limit))
    n = F.col("n")
    need = F.when(n <= wide * percent // 100, F.ceil(n * percent / 100.0)).otherwise(F.floor(F.least(n, F.lit(wide)) * (percent - SLACK) / 100.0))
    room = (F.size("shared") - need + 1).cast("int")
    rows = shared.join(members, "c").where(room > 0).select("c", "n", "label", F.explode(F.slice("shared", F.lit(1), room)).alias("s")).select("c", "n", "label", F.col("s.v").alias("v"))
    rows = staged(rows, "listed-again")
    several = staged(rows.groupBy("v").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("c").alias("p"), F.count("*").alias("count")).where("lo < hi"), "several")
    out = staged(spread_join(rows, several.select("v", "p"), ["v"], "c", several.select("v", "count"), limit).select("p", "c", "n", "label").distinct(), "again")
    unstage(postings, often, rows, several)
    return out


def _estimated(pairs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches may have enough in common: all that the threshold asks for
    where both sets fit into them; otherwise percent - 30 of the k smallest hashes of the union.
    For k = 64 a true 0.8 has fewer once in 10**8 pairs.

    Two sketches differ in at least as many values as their bit maps in bits, so no such pair is
    lost. A bit map is an eighth of a sketch, so pairs that share a value by chance, whose number
    grows faster than the input, are cheap to turn away.
    """
    n = pairs.count()
    near = _likely(classes.select("c", "n", "sketch"), "c", _ends(pairs), 2 * n)
    near = near.select("c", "n", F.expr(f"transform(sequence(0, {SIGN // 64 - 1}), i -> aggregate(sketch, 0L, (w, v) -> w | if((v & {SIGN - 1}) div 64 = i, shiftleft(1L, int(v & 63)), 0L)))").alias("bits"))
    side = lambda x: near.select(F.col("c").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))
    half = pairs.join(side("b"), "b")
    both = spread_join(half, side("a"), ["a"], "b", pairs.groupBy("a").count(), heavy_limit(n))
    differ = sum(F.bit_count(F.col("bits_a")[i].bitwiseXOR(F.col("bits_b")[i])) for i in range(SIGN // 64))
    least = F.when(F.greatest("n_a", "n_b") <= k, _overlap(F.col("n_a"), F.col("n_b"), percent)).otherwise(F.lit(max(0, -(-k * (percent - 30) // 100))))
    return both.where(differ <= F.least("n_a", F.lit(k)) + F.least("n_b", F.lit(k)) - 2 * least).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets satisfy 100 * |intersection| >= percent * |union|, as links (hi, lo)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=_SLICE):
            keep = []
            for a, b in zip(_unpacked(batch.column(2), width), _unpacked(batch.column(3), width), strict=True):
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["hi", "lo"]).filter(pa.array(keep, pa.bool_()))

    side = lambda x: sets.select(F.col("c").alias(x), F.col("own").alias(f"own_{x}"))
    joined = spread_join(pairs.join(side("b"), "b"), side("a"), ["a"], "b", pairs.groupBy("a").count(), heavy_limit(pairs.count()))
    return joined.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"), "own_a", "own_b").mapInArrow(run, "hi bigint, lo bigint")


def _linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int, percent: int, k: int) -> DataFrame:
    """The links among candidate pairs (a, b), as a staged table (hi, lo)."""
    pairs = staged(pairs.distinct(), "pairs")
    near = staged(_estimated(pairs, classes, k, percent), "near")
    sets = full_sets(docs, classes, _ends(near), width)
    out = staged(_confirmed(near, sets, width, percent), "links")
    unstage(pairs, near)
    return out


def _dealt(members: DataFrame, size: Column, room: int) -> DataFrame:
    """members (p, c, n, label) dealt to blocks: those outside p's largest label to blocks of their
    own, and each such block meets every block of the largest label, every other block and itself.

    size is a member's weight and room a block's. Returns part (the meeting) and the members'
    columns with minor and i (the member's block). Groups of one label are left out.
    """
    by = members.groupBy("p", "label").agg(F.sum(size).alias("w"), F.count("*").alias("m"))
    whole = by.groupBy("p").agg(F.max(F.struct("w", "label")).alias("big"), F.sum("w").alias("w"), F.sum("m").alias("count"), F.count("*").alias("labels")).where("labels > 1")
    blocks = lambda w: F.greatest(F.lit(1), F.ceil(w / F.lit(float(room)))).cast("int")
    groups = whole.select("p", "count", F.col("big.label").alias("largest"), blocks(F.col("w") - F.col("big.w")).alias("g"), blocks(F.col("big.w")).alias("h"))
    rows = spread_join(members, groups.drop("count"), ["p"], "c", groups.select("p", "count"), heavy_limit(members.count()))
    minor = F.col("label") != F.col("largest")
    rows = rows.withColumn("minor", minor).withColumn("i", F.pmod(F.xxhash64("c", F.lit(3)), F.when(minor, F.col("g")).otherwise(F.col("h"))).cast("int"))
    up_to = lambda x: F.sequence(F.lit(0), x - 1)
    meet = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    i = F.col("i")
    as_minor = F.concat(F.transform(up_to(F.col("h")), lambda j: meet(0, i, j)), F.transform(up_to(F.col("g")), lambda j: meet(1, F.least(i, j), F.greatest(i, j))))
    met = rows.withColumn("part", F.explode(F.when(minor, as_minor).otherwise(F.transform(up_to(F.col("g")), lambda j: meet(0, j, i)))))
    return met.select(F.struct("p", "part").alias("part"), "p", "c", "n", "label", "minor", "i")


def _common(own: list[np.ndarray], step: int = 2048) -> np.ndarray:
    """How many values each two of some sets share."""
    size = np.array([len(x) for x in own])
    out = np.zeros((len(own), len(own)), np.float32)
    _, col, often = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
    some = often[col] > 1
    row = np.repeat(np.arange(len(own)), size)[some]
    kept, col = np.unique(col[some], return_inverse=True)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for at in range(0, len(kept), step):  # columns of the incidence matrix at a time
        a, b = np.searchsorted(col, [at, at + step])
        hit = np.zeros((len(own), min(step, len(kept) - at)), np.float32)
        hit[row[a:b], col[a:b] - at] = 1
        out += hit @ hit.T
    return out


def _facing(table: pa.Table) -> np.ndarray:
    """Which two rows of a meeting are to be compared: a member outside the largest label and one of another label."""
    label, minor, i = (np.array(table.column(x)) for x in ("label", "minor", "i"))
    kind = table.column("part")[0].as_py()["part"]
    out = (label[:, None] != label[None, :]) & (minor[:, None] | minor[None, :])
    if kind["kind"] == 0:
        return out & (minor[:, None] != minor[None, :])
    return out & (i[:, None] != i[None, :]) if kind["i"] != kind["j"] else out


def _in_union(own: list[np.ndarray], a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Of the k smallest values of each two sketches' union, the share that both hold."""
    top = np.iinfo(np.int64).max
    table = np.full((len(own), k), top)
    for i, x in enumerate(own):
        table[i, : len(x)] = x
    s = np.sort(np.concatenate([table[a], table[b]], 1), 1)
    real = s < top
    new = np.concatenate([np.ones((len(s), 1), bool), s[:, 1:] != s[:, :-1]], 1) & real
    nth = np.cumsum(new, 1)
    both = (~new & real & (nth <= k)).sum(1)
    return both / np.maximum(1, np.minimum(nth[:, -1], k))


def _alive(members: DataFrame, classes: DataFrame, k: int, percent: int, room: int) -> DataFrame:
    """The members (p, c, n, label) whose sketch may be that of a set like one of another label."""
    rows = _dealt(members, F.lit(1), room)
    least = max(1, k * (percent - 30) // 100)

    def run(table: pa.Table) -> pa.Table:
        own = [np.array(x, np.int64) for x in table.column("sketch").to_pylist()]
        n = np.array(table.column("n"))
        both, union = _common(own), n[:, None] + n[None, :]
        exact = np.maximum(n[:, None], n[None, :]) <= k
        ok = np.where(exact, 100 * both >= percent * (union - both), both >= least) & _facing(table)
        ok &= 100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])
        there = (ok & (exact | (both >= k * 3 // 4))).any(1)
        a, b = np.nonzero(np.triu(ok & ~exact, 1) & ~(there[:, None] & there[None, :]))
        for at in range(0, len(a), 1 << 12):
            x, y = a[at : at + (1 << 12)], b[at : at + (1 << 12)]
            near = 100 * _in_union(own, x, y, k) >= percent - 30
            there[x[near]] = there[y[near]] = True
        return table.select(["p", "c", "n", "label"]).filter(pa.array(there))

    sides = _likely(classes.select("c", "sketch"), "c", members.select("c"), members.count())
    return rows.join(sides, "c").groupBy("part").applyInArrow(run, "p bigint, c bigint, n bigint, label bigint").distinct()


def _block_links(members: DataFrame, sets: DataFrame, width: int, percent: int, room: int) -> DataFrame:
    """Links (hi, lo) between members (p, c, n, label) of the same p with different labels: of those between two labels, one of each meeting."""

    def run(table: pa.Table) -> pa.Table:
        own = list(_unpacked(table.column("own"), width))
        ids, label, size = np.array(table.column("c")), np.array(table.column("label")), np.array([len(x) for x in own])
        both = _common(own).astype(float)
        alike = np.triu(_facing(table) & (100 * both >= percent * (size[:, None] + size[None, :] - both)), 1)
        x, y = np.nonzero(alike)
        _, first = np.unique(np.stack([np.maximum(label[x], label[y]), np.minimum(label[x], label[y])]), axis=1, return_index=True)
        x, y = ids[x[first]], ids[y[first]]
        return pa.table({"hi": pa.array(np.maximum(x, y), pa.int64()), "lo": pa.array(np.minimum(x, y), pa.int64())})

    # a block has no more than MEMBERS members either, however small their sets are
    weight = F.greatest(8 * F.col("n"), F.lit(-(-room // MEMBERS)))
    return _dealt(members, weight, room).join(sets, "c").groupBy("part").applyInArrow(run, "hi bigint, lo bigint")


def class_components(docs: DataFrame, width: int, percent: int, k: int, few: int = FEW, pivots: int = PIVOTS, members: int = MEMBERS, room: int = BYTES, wide: int = WIDE) -> DataFrame:
    """One row for each row of docs, as a staged table: doc_id, n (shingles), c (the class),
    component_id (the smallest doc_id of all rows that links reach) and keeper (the class of the
    row of that id; of several, the smallest). Rows without shingles are linked with nothing; a
    component without any doc_id has a null component_id."""
    small_batches(docs.sparkSession)
    rows = staged(sketches(docs, width, k), "sketches")
    classes = staged(rows.where("n > 0").groupBy("n", "s1", "s2", "c").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"), F.first("sketch").alias("sketch")), "classes")

    index = listed(classes, k, percent)
    # pairs have a member with the list's size, so the pivot is one of these
    rank = F.struct((~F.col("small")).alias("other"), F.xxhash64("c", "v").alias("r"), "c", "n")

    def summed(rows: DataFrame) -> DataFrame:
        out = rows.groupBy("v", "m").agg(F.count("*").alias("count"), F.max("small").alias("pairs"), F.min(rank).alias("a"), F.min("c").alias("p")).where("count > 1 and pairs")
        return out.select("v", "m", "count", F.col("a.c").alias("a"), F.col("a.n").alias("n_a"), "p")

    limit = heavy_limit(index.count())
    heavy = index.where("heavy").drop("heavy")
    stats = staged(summed(heavy), "stats")
    # the others are shuffled once: their lists are short enough for a task, and meet their sums where they lie
    light = index.where("not heavy").drop("heavy").repartition("v", "m")
    lists = staged(light.join(summed(light), ["v", "m"]).unionByName(spread_join(heavy, stats, ["v", "m"], "c", stats.select("v", "m", "count"), limit)), "lists")
    unstage(index, stats)
    short = lists.where(F.col("count") <= few)
    x, y = short.select("v", "m", "c", "n", "small").alias("x"), short.select("v", "m", "c", "n", "small").alias("y")
    same = (F.col("x.v") == F.col("y.v")) & (F.col("x.m") == F.col("y.m")) & (F.col("x.c") < F.col("y.c")) & (F.col("x.small") | F.col("y.small"))
    pairs = x.join(y, same).where(_sizes_fit("x.n", "y.n", percent)).select(F.col("x.c").alias("a"), F.col("y.c").alias("b"))
    long_ = lists.where(F.col("count") > few)
    pivoted = long_.where("c != a").where(_sizes_fit("n", "n_a", percent)).select("a", F.col("c").alias("b"))
    found = [_linked(pairs.unionAll(pivoted), docs, classes, width, percent, k)]
    roots = components(found[0])

    tables: list[DataFrame] = []

    def mixed(roots: DataFrame) -> DataFrame:
        label = roots.select(F.col("node").alias("c"), "root")
        rows = staged(long_.join(label, "c", "left").select("v", "m", "c", "n", "small", "p", F.coalesce("root", "c").alias("label")), "labelled")
        several = rows.groupBy("v", "m").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("count"), F.min(F.struct((~F.col("small")).alias("other"), F.xxhash64("c", "v", F.lit(1)).alias("r"), "c", "n", "label")).alias("a")).where("lo < hi")
        several = staged(several, "several")
        tables.extend([rows, several])
        more = several.select("v", "m", F.col("a.c").alias("a"), F.col("a.n").alias("n_a"), F.col("a.label").alias("l_a"))
        return spread_join(rows, more, ["v", "m"], "c", several.select("v", "m", "count"), limit)

    for _ in range(1, pivots):
        again = mixed(roots).where("label != l_a").where(_sizes_fit("n", "n_a", percent)).select("a", F.col("c").alias("b"))
        found.append(_linked(again, docs, classes, width, percent, k))
        following = components(roots.select(F.col("node").alias("hi"), F.col("root").alias("lo")).unionAll(found[-1]))
        unstage(roots)
        roots = following
    left = staged(mixed(roots).select("m", "p", "c", "n", "label").distinct(), "left")
    # what fits into one block meets there
    large = staged(left.where("m = 0").groupBy("p").agg(F.count("*").alias("count")).where(F.col("count") > members), "large")
    both = spread_join(left, large.select("p", F.lit(True).alias("large")), ["p"], "c", large, heavy_limit(left.count()), "left").withColumn("large", (F.col("m") == 0) & F.coalesce("large", F.lit(False)))
    again = _listed_again(both.where("large").select("c", "n", "label").distinct(), docs, classes, width, percent, wide)
    rest = staged(both.where("not large").select("p", "c", "n", "label").distinct().unionAll(again), "rest")
    alive = staged(_alive(rest, classes, k, percent, members), "alive")
    sets = full_sets(docs, classes, alive.select("c").distinct(), width)
    found.append(staged(_block_links(alive, sets, width, percent, room), "links"))
    final = components(roots.select(F.col("node").alias("hi"), F.col("root").alias("lo")).unionAll(found[-1]))

    linked = final.select(F.col("node").alias("c"), "root").unionAll(final.select(F.col("root").alias("c"), "root").distinct())
    named = classes.select("c", "first").join(linked, "c")
    smallest = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "c")).alias("s")
    of_root = named.groupBy("root").agg(smallest, F.count("*").alias("count")).select("root", F.col("s.first").alias("component_id"), F.col("s.c").alias("keeper"), "count")
    n = classes.count()
    of_class = spread_join(linked, of_root.drop("count"), ["root"], "c", of_root.select("root", "count"), heavy_limit(n)).drop("root")
    known = classes.select("c", "first", "copies").join(of_class, "c", "left").where("copies > 1 or keeper is not null")
    known = staged(known.select("c", F.when(F.col("keeper").isNull(), F.col("first")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("keeper", "c").alias("keeper"), F.col("copies").alias("count")), "known")
    small = rows.select("doc_id", "n", "c")
    some = spread_join(small.where("n > 0"), known.drop("count").withColumn("known", F.lit(True)), ["c"], "doc_id", known.select("c", "count"), heavy_limit(n), "left")
    out = some.select("doc_id", "n", "c", F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), F.coalesce("keeper", "c").alias("keeper"))
    out = staged(out.unionAll(small.where("n = 0").select("doc_id", "n", "c", F.col("doc_id").alias("component_id"), F.col("c").alias("keeper"))), "near")
    unstage(rows, classes, lists, left, large, again, rest, alive, roots, final, known, *found, *tables)
    return out


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, k: int = K, **sizes: int) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (the smallest doc_id that links
    reach, itself included) and kept (doc_id = component_id).

    Links are all pairs with 100 * |intersection| >= percent * |union|. Empty and null texts, and
    texts without words, have no shingles and no links. Rows with the same doc_id are one
    document: every text's links count, n_shingles is the largest and component_id the smallest
    of its texts. Each row with a null doc_id is a document of its own; its component_id is null
    if it is linked with no id. An empty table gives an empty result. Further columns of docs
    aren't read. sizes: see class_components().
    """
    rows = class_components(docs, width, percent, k, **sizes)
    per_doc = rows.where("doc_id is not null").groupBy("doc_id").agg(F.max("n").alias("n_shingles"), F.min("component_id").alias("component_id"))
    lone = rows.where("doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return per_doc.unionAll(lone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def first_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, k: int = K) -> DataFrame:
    """The rows of docs, all columns, of which one row of each component stays.

    It is the row with the smallest doc_id; of rows with that id, one of the keeper's class. Rows
    without shingles all stay, and so does each text of a repeated id that is like no other; of
    linked rows without an id, one stays if none has one. Only rows whose id isn't that of one
    row that stays are looked at again and shuffled; the others pass as they are.
    """
    rows = class_components(docs, width, percent, k)
    stays = (F.col("n") == 0) | (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("c") == F.col("keeper")))
    per_id = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min(stays).alias("all"), F.count("*").alias("rows"))
    asked = staged(per_id.where("not all or rows > 1").select("doc_id"), "asked")
    n = asked.count()

    def sums(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for part in slices([pa.RecordBatch.from_arrays([batch], ["text"])], size=_SLICE):
                out += [{"n": len(x), "s1": s1, "s2": s2} for x in shingle_sets(part.column(0).to_pylist(), width) for s1, s2 in [_mark(x)]]
            yield pa.array(out, pa.struct([("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64())]))

    # not deterministic: so that Spark evaluates it in one place only, and each task has one Python worker
    summed = F.arrow_udf(sums, "struct<n:bigint,s1:bigint,s2:bigint>").asNondeterministic()
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"))
    looked = _marked(packed, "doc_id", asked, n).where("likely").select("row", "doc_id", summed(F.coalesce(F.col("row")["text"], F.lit(""))).alias("x"))
    keyed = looked.select("row", F.col("x.n").alias("n"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), _CLASS("x.n", "x.s1", "x.s2").alias("c"))
    keep = _marked(rows.where(stays), "doc_id", asked, n).where("likely").select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), "c").distinct()
    one = keyed.where("n > 0").dropDuplicates(["id", "none", "c"]).join(keep, ["id", "none", "c"], "left_semi").select("row.*")
    sure = _marked(packed, "doc_id", asked, n).where("not likely").select("row.*")
    return sure.unionAll(one).unionAll(keyed.where("n = 0").select("row.*"))
