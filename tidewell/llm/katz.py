"""Katz backoff language model over hashed word n-grams (operator 2).

    P(w | h) = d(c(h w)) c(h w) / c(h)   if c(h w) > 0
             = a(h) P(w | h')            if c(h) > 0, where h' is h without its first word
             = P(w | h')                 else
    P(w)     = d(c(w)) c(w) / N          if c(w) > 0,     else   what the discounts leave

d are, for each length of n-gram, Good-Turing discounts of the counts 1 to 5; larger counts lose
half a count, so that every history leaves something. a(h) is such that the probabilities after h
sum to 1 over the known words and the unknown one. Texts begin with as many marks as a history
is long, and end with one token.

Texts become chunks of local word numbers. For every chunk, its distinct n-grams go as sorted
hashes to the partition of the count table that holds them, and the totals come back, so a
frequent n-gram travels once for each chunk and no key is ever hot; then every token of the chunk
is evaluated, from the longest n-gram down. Backoff weights are summed the same way from the
chunks that own an n-gram (of all that hold it, the first), and only tokens that back off ask for
them. Messages are a row for each chunk and partition, so their number is the product of both. Where
that grows large, chunks send to a fixed number of coarse partitions, in which bundles of chunks
are merged; only the bundles, a sixty-fourth as many, send to the count table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._arrays import Tokens, U, pair_hash, release
from ._shared import remainder, small_batches, staged, unstage
from .bpe import slices

END, BEGIN = U(0x1F3D5B79A2C4E688), U(0x2E4C6A8897B5D3F1)
SMALL = 5  # counts up to this have a Good-Turing discount
HALF = 0.5  # what larger counts lose
ORDER = 2
CHUNK_TOKENS = 1 << 19
PART_BYTES = 32 << 20  # of text for each partition of the count tables
BUNDLE, COARSE, DIRECT = 64, 256, 1 << 26  # chunks of a bundle, coarse partitions, messages that need no bundles
CHUNK = "chunk bigint, doc_ids array<bigint>, held array<boolean>, sizes array<int>, words binary, ids binary"
REQUEST = "part int, chunk bigint, keys binary, counts binary"
ANSWER = "part int, chunk bigint, keys binary, counts binary, stats array<bigint>"
SCORED = "kind int, chunk bigint, row int, doc_id bigint, held boolean, n_tokens bigint, n_known bigint, base double, score double, part int, keys binary, vals binary"


def squeeze(x: np.ndarray) -> bytes:
    """Integers or floats, byte planes apart, compressed."""
    wide = np.ascontiguousarray(x.astype(x.dtype.newbyteorder("<"))).view(np.uint8).reshape(len(x), x.dtype.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(wide.T).tobytes())


def expand(raw: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, -1).T).reshape(-1).view(kind)


def squeeze_sorted(x: np.ndarray) -> bytes:
    return squeeze(np.diff(x, prepend=U(0)))


def expand_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(expand(raw, U), dtype=U)


def chunks(docs: DataFrame, fold: int, tokens: int) -> DataFrame:
    """Texts as local word numbers, some half a million tokens a row; documents keep the table's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n, held_, ids_, sizes_, hashes = TaskContext.get().partitionId() << 32, 0, [], [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal n, held_, ids_, sizes_, hashes, base
            words, local = np.unique(np.concatenate([*hashes, np.array([END])]), return_inverse=True)
            sizes = np.concatenate(sizes_)
            out = pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([base], pa.int64()),
                    "doc_ids": pa.array([ids_], pa.list_(pa.int64())),
                    "held": pa.array([held_], pa.list_(pa.bool_())),
                    "sizes": pa.array([sizes.astype(np.int32)], pa.list_(pa.int32())),
                    "words": pa.array([squeeze_sorted(words)], pa.binary()),
                    "ids": pa.array([squeeze(local[:-1].astype(np.uint32))], pa.binary()),
                }
            )
            base, n, held_, ids_, sizes_, hashes = base + 1, 0, [], [], [], []
            return out

        for batch in slices(batches):
            words = Tokens([(t or "").encode().lower() for t in batch.column(1).to_pylist()])
            hashes.append(words.hash)
            sizes_.append(np.diff(words.offsets))
            ids_ += batch.column(0).cast(pa.int64()).to_pylist()
            held_ += batch.column(2).to_pylist()
            n += len(words.hash) + batch.num_rows
            if n >= tokens:
                yield flush()
        if ids_:
            yield flush()

    test = F.coalesce(remainder(F.col("doc_id"), fold) == 0, F.lit(False))
    out = docs.select("doc_id", "text", test.alias("held")).mapInArrow(run, CHUNK)
    # one set of input splits, so that a chunk holds the same rows whenever it is computed again
    spark = docs.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(out._jdf.toJavaRDD(), out._jdf.schema()), spark)


class _Chunk:
    """A chunk's tokens (each document's words, then its end), and its distinct n-grams of each length.

    levels[n - 1] has, for n-grams of n words, their ascending hashes, where the first of each
    stands, and the n-gram that ends at each token. starts are the hashes of the histories of n
    words at a document's beginning.
    """

    def __init__(self, row: dict, order: int):
        self.words = expand_sorted(row["words"])
        word_ids = expand(row["ids"], np.uint32).astype(np.int64)
        sizes = np.array(row["sizes"], np.int64)
        self.doc_ids, self.held = row["doc_ids"], np.array(row["held"], bool)
        end = int(np.searchsorted(self.words, END))
        ids = np.insert(word_ids, np.cumsum(sizes), end)
        self.sizes = sizes + 1
        self.doc = np.repeat(np.arange(len(sizes)), self.sizes)
        self.first = np.cumsum(self.sizes) - self.sizes
        at = np.zeros(len(self.words), np.int64)
        at[ids[::-1]] = np.arange(len(ids))[::-1]
        self.levels = [(self.words, at, ids)]
        self.starts = [BEGIN]
        word = self.words[ids]
        gram = word
        for _ in range(1, order):
            history = np.append(U(0), gram[:-1])
            history[self.first] = self.starts[-1]
            gram = pair_hash(history, word)
            self.levels.append(np.unique(gram, return_index=True, return_inverse=True))
            self.starts.append(pair_hash(np.array([self.starts[-1]]), np.array([BEGIN]))[0])


def _spread(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part's keys begin among ascending keys; parts is a power of two."""
    shift = U(64 - (parts.bit_length() - 1))
    edges = np.arange(parts, dtype=U) << shift if parts > 1 else np.zeros(1, U)
    return np.append(np.searchsorted(keys, edges), len(keys))


def requests(chunk_rows: DataFrame, parts: int, order: int = ORDER) -> DataFrame:
    """Each chunk's distinct n-grams of n words (parts (n - 1) * parts and up) with their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = _Chunk(row, order)
                train = ~c.held[c.doc]
                for level, (keys, _, inverse) in enumerate(c.levels):
                    counts = np.bincount(inverse[train], minlength=len(keys)).astype(np.uint32)
                    edge = _spread(keys, parts)
                    some = [p for p in range(parts) if edge[p] < edge[p + 1]]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "part": pa.array([level * parts + p for p in some], pa.int32()),
                            "chunk": pa.array([row["chunk"]] * len(some), pa.int64()),
                            "keys": pa.array([squeeze_sorted(keys[edge[p] : edge[p + 1]]) for p in some], pa.binary()),
                            "counts": pa.array([squeeze(counts[edge[p] : edge[p + 1]]) for p in some], pa.binary()),
                        }
                    )
                del c, row
            release()

    return chunk_rows.mapInArrow(run, REQUEST)


def counted(asked: DataFrame) -> DataFrame:
    """For each request, the total of each key times two, plus 1 if the chunk owns the key; and for
    each part a row without chunk, the count table itself: its keys and their counts, with the sum,
    the number and the counts of counts."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        keys = [expand_sorted(r["keys"]) for r in rows]
        counts = np.concatenate([expand(r["counts"], np.uint32) for r in rows]).astype(np.int64)
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inverse, counts, len(distinct)).astype(np.int64)
        own = np.flatnonzero(counts)
        owner = np.zeros(len(counts), np.int64)
        owner[own[np.unique(inverse[own], return_index=True)[1]]] = 1
        answer = (2 * total[inverse] + owner).astype(np.uint64)
        parts = np.split(answer, np.cumsum([len(k) for k in keys])[:-1])
        seen = total[total > 0]
        stats = [int(seen.sum()), len(seen), *np.bincount(np.minimum(seen, SMALL + 2), minlength=SMALL + 3)[1 : SMALL + 2].tolist()]
        part = rows[0]["part"]
        return pa.table(
            {
                "part": pa.array([part] * (len(rows) + 1), pa.int32()),
                "chunk": pa.array([*(r["chunk"] for r in rows), None], pa.int64()),
                "keys": pa.array([*([None] * len(rows)), squeeze_sorted(distinct[total > 0])], pa.binary()),
                "counts": pa.array([*(squeeze(x) for x in parts), squeeze(seen.astype(np.uint64))], pa.binary()),
                "stats": pa.array([*([None] * len(rows)), stats], pa.list_(pa.int64())),
            }
        )

    return asked.groupBy("part").applyInArrow(run, ANSWER)


def _merged(table: pa.Table) -> tuple[list[dict], np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """A bundle's requests by chunk; their distinct keys; which of these, and the count, each request's keys have; and how many these are."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    keys = [expand_sorted(r["keys"]) for r in rows]
    counts = np.concatenate([expand(r["counts"], np.uint32) for r in rows]).astype(np.int64)
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return rows, distinct, inverse, counts, [len(k) for k in keys]


def _of_bundle(bundles: int) -> Column:
    return F.pmod(F.xxhash64("chunk"), F.lit(bundles)).alias("bundle")


def bundled(asked: DataFrame, bundles: int, coarse: int, parts: int, order: int) -> DataFrame:
    """The requests of bundles of chunks: what their chunks ask of a coarse part, merged, goes to the
    parts that make it up. A bundle's part is a chunk of its own, with the number bundle * order * coarse + part."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bundle, part = (k.as_py() for k in key)
        _, distinct, inverse, counts, _ = _merged(table)
        total = np.bincount(inverse, counts, len(distinct)).astype(np.uint32)
        edge = _spread(distinct, parts)
        some = np.flatnonzero(edge[1:] > edge[:-1]).tolist()
        return pa.table(
            {
                "part": pa.array([part // coarse * parts + p for p in some], pa.int32()),
                "chunk": pa.array([bundle * order * coarse + part] * len(some), pa.int64()),
                "keys": pa.array([squeeze_sorted(distinct[edge[p] : edge[p + 1]]) for p in some], pa.binary()),
                "counts": pa.array([squeeze(total[edge[p] : edge[p + 1]]) for p in some], pa.binary()),
            }
        )

    return asked.withColumn("bundle", _of_bundle(bundles)).groupBy("bundle", "part").applyInArrow(run, REQUEST)


def unbundled(asked: DataFrame, answers: DataFrame, bundles: int, coarse: int, order: int) -> DataFrame:
    """For each request of a chunk, the totals from the answer to its bundle; of a bundle's chunks, the first that has a key owns it."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        rows, distinct, inverse, counts, sizes = _merged(left)
        got = np.concatenate([expand(r["counts"], U) for r in sorted(right.to_pylist(), key=lambda r: r["part"])])
        own = np.flatnonzero(counts)
        owner = np.zeros(len(counts), U)
        first = own[np.unique(inverse[own], return_index=True)[1]]
        owner[first] = got[inverse[first]] & U(1)
        parts = np.split((got[inverse] & ~U(1)) | owner, np.cumsum(sizes)[:-1])
        none = [None] * len(rows)
        return pa.table({"part": pa.array([r["part"] for r in rows], pa.int32()), "chunk": pa.array([r["chunk"] for r in rows], pa.int64()), "keys": pa.array(none, pa.binary()), "counts": pa.array([squeeze(x) for x in parts], pa.binary()), "stats": pa.array(none, pa.list_(pa.int64()))})

    wide = F.lit(order * coarse)
    there = answers.where("chunk is not null").select(F.floor(F.col("chunk") / wide).alias("bundle"), F.pmod("chunk", wide).cast("int").alias("coarse"), "part", "counts")
    return asked.withColumn("bundle", _of_bundle(bundles)).groupBy("bundle", "part").cogroup(there.groupBy("bundle", "coarse")).applyInArrow(run, ANSWER)


def discounts(n: list[int]) -> np.ndarray:
    """d(0..5). n: how many n-grams occur 1 to 6 times.

    Where the counts of counts give no discount between 0 and 1, d(r) is (r - 0.5) / r.
    """
    out = np.ones(SMALL + 1)
    cut = (SMALL + 1) * n[SMALL] / n[0] if n[0] else 1.0
    for r in range(1, SMALL + 1):
        d = 0.0
        if n[r - 1] and n[r] and cut < 1:
            d = ((r + 1) * n[r] / (r * n[r - 1]) - cut) / (1 - cut)
        out[r] = d if 0 < d < 1 else (r - HALF) / r
    return out


def kept(count: np.ndarray, d: np.ndarray) -> np.ndarray:
    """What the discounts leave of counts; 0 of 0."""
    return np.where(count > SMALL, count - HALF, d[np.minimum(count, SMALL)] * count)


class Model:
    """Totals and discounts of each length of n-gram; stats: for each, the sum of counts, how many there are, and how many occur 1 to 6 times."""

    def __init__(self, stats: list[list[int]]):
        self.n, self.v = stats[0][0], stats[0][1]
        self.d = [discounts(x[2:]) for x in stats]
        few = np.array(stats[0][2 : 2 + SMALL])
        r = np.arange(1, SMALL + 1)
        left = float(((1 - self.d[0][1:]) * r * few).sum()) + HALF * (self.v - int(few.sum()))
        self.unknown = left / self.n if self.n else 1.0

    def single(self, c: np.ndarray) -> np.ndarray:
        """P(w) by the word's count."""
        return np.where(c > 0, kept(c, self.d[0]) / max(self.n, 1), self.unknown)


def evaluated(chunk_rows: DataFrame, answers: DataFrame, model: Model, parts: int, order: int = ORDER) -> DataFrame:
    """Every token of every chunk: kind 0, a row a document, without its backoff weights; kind 1,
    for each part of the histories what the n-grams that the chunk owns take and leave; kind 2,
    which documents back off from which histories, and how often. Histories of n words are in the
    parts from (n - 1) * parts on."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({n: pa.array([], t) for n, t in kinds})
        chunk = key[0].as_py()
        c = _Chunk(left.to_pylist()[0], order)
        answer: list[list[np.ndarray]] = [[] for _ in range(order)]
        for r in sorted(right.to_pylist(), key=lambda r: r["part"]):
            answer[r["part"] // parts].append(expand(r["counts"], U))
        both = [np.concatenate(a) for a in answer]
        count, owned = [(x >> U(1)).astype(np.int64) for x in both], [(x & U(1)).astype(bool) for x in both]
        del both, answer
        docs = len(c.doc_ids)
        ends = int(count[0][np.searchsorted(c.words, END)])  # as many as there are training texts
        ids = c.levels[0][2]
        c1 = count[0][ids]
        base = np.log10((c1 + 0.1) / (model.n + 0.1 * (model.v + 1)))
        lower = model.single(count[0])[ids]  # what the n-gram that is a word shorter gives each token, where it was seen
        token, found = lower, np.zeros(len(ids), np.int64)
        out, misses = [], []
        for level in range(1, order):
            keys, at, key_of = c.levels[level]
            below = c.levels[level - 1]
            total = np.append(0, count[level - 1][below[2]][:-1])  # of the history before each token
            total[c.first] = ends
            here = count[level][key_of]
            seen = here > 0
            with np.errstate(divide="ignore", invalid="ignore"):
                chance = kept(here, model.d[level]) / total
            token = np.where(seen, chance, token)
            found = np.where(seen, level, found)
            history = np.append(U(0), below[0][below[2]][:-1])
            history[c.first] = c.starts[level - 1]
            own = np.flatnonzero(owned[level])
            first = at[own]
            h, place = np.unique(history[first], return_inverse=True)
            taken = np.bincount(place, lower[first], len(h))
            freed = np.bincount(place, count[level][own] - kept(count[level][own], model.d[level]), len(h))
            whole = np.zeros(len(h), np.int64)
            whole[place] = total[first]
            out.append((1, level, h, (freed, taken, whole)))
            misses.append((level, history, total))
            lower = chance
        for level, history, total in misses:
            asks = np.flatnonzero((found < level) & (total > 0))
            h, place = np.unique(history[asks], return_inverse=True)
            pair, times = np.unique(place * docs + c.doc[asks], return_counts=True)
            out.append((2, level, h[pair // docs], ((pair % docs).astype(np.uint32), times.astype(np.uint32))))
        rows = [
            {
                "kind": np.zeros(docs, np.int32), "chunk": np.full(docs, chunk), "row": np.arange(docs), "doc_id": c.doc_ids, "held": c.held, "n_tokens": c.sizes,
                "n_known": np.bincount(c.doc, c1 > 0, docs).astype(np.int64), "base": np.bincount(c.doc, base, docs), "score": np.bincount(c.doc, np.log10(token), docs),
            }
        ]
        for kind, level, hashes, values in out:
            edge = _spread(hashes, parts)
            for p in np.flatnonzero(edge[1:] > edge[:-1]).tolist():
                s = slice(edge[p], edge[p + 1])
                vals = [squeeze(v[s]) for v in values]
                raw = np.array([len(v) for v in vals], "<u4").tobytes() + b"".join(vals)
                rows.append({"kind": [kind], "chunk": [chunk], "part": [(level - 1) * parts + p], "keys": [squeeze_sorted(hashes[s])], "vals": [raw]})
        release()
        return pa.concat_tables([pa.table({n: pa.array(x[n], t) if n in x else pa.nulls(len(x["kind"]), t) for n, t in kinds}) for x in rows])

    kinds = [("kind", pa.int32()), ("chunk", pa.int64()), ("row", pa.int32()), ("doc_id", pa.int64()), ("held", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("part", pa.int32()), ("keys", pa.binary()), ("vals", pa.binary())]
    return chunk_rows.groupBy("chunk").cogroup(answers.where("chunk is not null").select("part", "chunk", "counts").groupBy("chunk")).applyInArrow(run, SCORED)


def _fields(raw: bytes, types: tuple) -> list[np.ndarray]:
    size = np.frombuffer(raw[: 4 * len(types)], "<u4")
    at = (4 * len(types) + np.append(0, np.cumsum(size, dtype=np.int64))).tolist()
    return [expand(raw[a:b], t) for a, b, t in zip(at, at[1:], types, strict=False)]


def backed_off(scored: DataFrame) -> DataFrame:
    """chunk, row and what backoff weights add to the document's score, once for each part that holds one of its histories."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["kind"], r["chunk"]))
        given = [(expand_sorted(r["keys"]), *_fields(r["vals"], (np.float64, np.float64, np.int64))) for r in rows if r["kind"] == 1]
        out = {"chunk": [np.zeros(0, np.int64)], "row": [np.zeros(0, np.int64)], "extra": [np.zeros(0)]}
        asked = [r for r in rows if r["kind"] == 2]
        if given and asked:
            h, at = np.unique(np.concatenate([g[0] for g in given]), return_inverse=True)
            freed = np.bincount(at, np.concatenate([g[1] for g in given]), len(h))
            taken = np.bincount(at, np.concatenate([g[2] for g in given]), len(h))
            total = np.zeros(len(h))
            total[at] = np.concatenate([g[3] for g in given])
            weight = np.log10(freed / total / np.maximum(1 - taken, 1e-300))
            for r in asked:
                doc, times = _fields(r["vals"], (np.uint32, np.uint32))
                extra = np.bincount(doc, times * weight[np.searchsorted(h, expand_sorted(r["keys"]))])
                some = np.unique(doc)
                out["chunk"].append(np.full(len(some), r["chunk"]))
                out["row"].append(some.astype(np.int64))
                out["extra"].append(extra[some])
        release()
        return pa.table({n: pa.array(np.concatenate(x), t) for (n, x), t in zip(out.items(), (pa.int64(), pa.int32(), pa.float64()), strict=True)})

    return scored.where("kind > 0").groupBy("part").applyInArrow(run, "chunk bigint, row int, extra double")


def score(docs: DataFrame, fold: int = 10, order: int = ORDER, chunk_tokens: int = CHUNK_TOKENS, parts: int | None = None, direct: int = DIRECT, coarse: int = COARSE) -> DataFrame:
    """Scores every whole text by the model of the texts whose crc32(doc_id as text) mod fold isn't 0.

    order: the words of the longest n-grams (1: no backoff). parts, direct and coarse: see the
    module; the results don't depend on them. Returns doc_id, held_out, n_tokens
    (words and the end), n_known, train_tokens, base_score (of add-0.1 unigrams) and score (log10
    probability by the model). A-Z are lower-cased; null text is empty: only the end. Rows that
    repeat an id are texts of their own; rows with a null id are training texts. Without training
    texts all counts are 0, and the score is 0 for every token. No rows give no rows.
    """
    small_batches(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = parts or 1 << max(6, int(np.ceil(np.log2(max(1, size / PART_BYTES)))))
    rows = chunks(docs, fold, chunk_tokens)
    bundles = int(size / (5 * chunk_tokens) / BUNDLE) + 1  # a chunk has some five bytes a token
    if bundles * BUNDLE * parts * order <= direct:
        answers = counts = staged(counted(requests(rows, parts, order)), "counts")
        sent = parts
    else:
        sent = min(coarse, parts)
        asked = requests(rows, sent, order)
        counts = staged(counted(bundled(asked, bundles, sent, parts, order)), "counts")
        answers = staged(unbundled(asked, counts, bundles, sent, order), "answers")
    level = F.floor(F.col("part") / parts).cast("int").alias("level")
    totals = counts.where("chunk is null").select(level, *(F.col("stats")[i].alias(f"s{i}") for i in range(SMALL + 3))).groupBy("level").agg(*(F.sum(f"s{i}").alias(f"s{i}") for i in range(SMALL + 3)))
    got = {r.level: [int(x) for x in r[1:]] for r in totals.collect()}
    model = Model([got.get(i, [0] * (SMALL + 3)) for i in range(order)])
    scored = staged(evaluated(rows, answers, model, sent, order), "scored")
    unstage(counts, *([answers] if answers is not counts else []))
    extra = backed_off(scored).groupBy("chunk", "row").agg(F.sum("extra").alias("extra"))
    out = scored.where("kind = 0").select("chunk", "row", "doc_id", "held", "n_tokens", "n_known", "base", "score")
    total = F.col("score") + F.coalesce("extra", F.lit(0.0)) if model.n else F.lit(0.0)
    return out.join(extra, ["chunk", "row"], "left").select("doc_id", F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(model.n).cast("bigint").alias("train_tokens"), F.col("base").alias("base_score") if model.n else F.lit(0.0).alias("base_score"), total.alias("score"))
