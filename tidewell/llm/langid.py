"""Language identification (operator 6): nearest of several clustered centroids per language.

A text is the normalised TF-IDF vector of its letter n-grams; each language's training vectors
are clustered, and a text gets the language of the centroid with the largest cosine. A text
that is far from every centroid, compared with the training texts of that centroid, is marked
as rejected.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._arrays import U, mix
from ._shared import remainder, small_batches
from .bpe import slices

#: Letters of the n-grams, hash buckets, clusters of a language, and training texts of a language and of all languages at most.
SIZES, BUCKETS, CLUSTERS, MAX_EACH, MAX_ALL = (1, 2, 3), 4096, 3, 1500, 24_000


def profile(text: str | None) -> tuple[np.ndarray, int]:
    """Counts of the text's n-grams by hash bucket, and its number of letters. Everything but
    letters counts as one space; n-grams of a space alone don't count."""
    if not text:
        return np.zeros(BUCKETS, np.float32), 0
    low = text.lower()
    x = np.frombuffer(low.encode("utf-32-le"), np.uint32)
    letter = letters(int(x.max()) >= 0x250)[x]
    n = int(letter.sum())
    if not n:
        return np.zeros(BUCKETS, np.float32), 0
    x = np.where(letter, x, 32)
    keep = np.append(True, (x[1:] != 32) | (x[:-1] != 32))
    x = np.concatenate([[32], x[keep], [32]]).astype(U)
    out = np.zeros(BUCKETS)
    for size in SIZES:
        if len(x) < size:
            continue
        h = x[: len(x) - size + 1].copy()
        for i in range(1, size):
            h = h * U(0x100000001B3) + x[i : len(x) - size + 1 + i]
        if size == 1:
            h = h[x != 32]
        out += np.bincount((mix(h + U(size << 56)) % U(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    return out.astype(np.float32), n


@functools.cache
def letters(every: bool) -> np.ndarray:
    """Which code points are letters: the Latin ones, or every one."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000 if every else 0x250)), bool)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Centroids:
    langs: list[str]  # of each centroid
    idf: np.ndarray
    centres: np.ndarray
    least: np.ndarray  # cosine below which a text of this centroid is rejected

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        lang, cosine, rejected = [], np.zeros(len(texts)), np.zeros(len(texts), bool)
        rows = [profile(t) for t in texts]
        none = np.array([n == 0 for _, n in rows], bool)
        if len(rows) and len(self.langs):
            near = vectors(np.stack([x for x, _ in rows]), self.idf) @ self.centres.T
            best = near.argmax(1)
            cosine = np.where(none, 0, np.clip(near[np.arange(len(rows)), best], 0, 1)).astype(float)
            rejected = none | (cosine < self.least[best])
            lang = ["und" if x else self.langs[b] for x, b in zip(none, best, strict=True)]
        else:
            lang, rejected = ["und"] * len(texts), np.ones(len(texts), bool)
        return lang, cosine, rejected


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of k clusters by cosine, begun with vectors far from each other."""
    centres = [x.mean(0)]
    for _ in range(min(k, len(x)) - 1):
        centres.append(x[np.argmin(np.max(x @ np.stack(centres).T, axis=1))])
    c = np.stack(centres)
    for _ in range(rounds):
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        own = (x @ c.T).argmax(1)
        c = np.stack([x[own == i].mean(0) if (own == i).any() else c[i] for i in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


def document_frequencies(train: DataFrame) -> tuple[int, np.ndarray]:
    """How many texts there are, and how many hold each bucket: sums of a task first, then of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS + 1, np.int64), 0
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                total[:-1] += profile(text)[0] > 0
            total[-1] += batch.num_rows
            n += batch.num_rows
        if n:
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(np.arange(BUCKETS + 1), pa.int64()), "n": pa.array(total, pa.int64())})

    out = np.zeros(BUCKETS + 1)
    for r in train.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return int(out[-1]), out[:-1]


def fit(docs: DataFrame, max_each: int = MAX_EACH, clusters: int = CLUSTERS, max_all: int = MAX_ALL) -> Centroids:
    """Learns from text and lang of documents whose crc32(doc_id as text) mod 4 isn't 2.

    Document frequencies are those of all training texts. The centroids' bound: of each language
    the max_each documents with the smallest hash of doc_id, or max_all / languages, if that is
    less, but one at least. Only their n-gram counts, and numbers a language, come to the driver.
    Texts without a letter and null languages teach nothing; a null id counts as training; of
    rows that repeat an id or have none, no more than the bound are taken, smallest profile first.
    """
    small_batches(docs.sparkSession)
    train = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & F.coalesce(remainder(F.col("doc_id"), 4) != 2, F.lit(True)))
    langs = {r.lang: r.n for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not langs:
        return Centroids([], np.ones(BUCKETS, np.float32), np.zeros((0, BUCKETS), np.float32), np.zeros(0))
    n, df = document_frequencies(train)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    each = max(1, min(max_each, max_all // len(langs)))
    # a hash range that holds about twice as many rows of a language: the same rows each time
    shares = train.sparkSession.createDataFrame(pa.table({"lang": list(langs), "share": [min(1.0, (2 * each + 20) / x) for x in langs.values()]}))
    key = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40), F.lit(0.0))
    some = train.withColumn("key", key).join(F.broadcast(shares), "lang").where("key < share")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            packed = []
            for text in batch.column(2).to_pylist():
                x = profile(text)[0]
                at = np.flatnonzero(x)
                packed.append(np.stack([at.astype(np.float32), x[at]]).tobytes())
            yield pa.RecordBatch.from_pydict({"lang": batch.column(0), "key": batch.column(1), "x": pa.array(packed, pa.binary())})

    profiles = some.select("lang", "key", "text").mapInArrow(run, "lang string, key double, x binary")
    first = Window.partitionBy("lang").orderBy("key", "x")
    got: dict[str, list[bytes]] = {}
    for r in profiles.withColumn("i", F.row_number().over(first)).where(F.col("i") <= each).collect():
        got.setdefault(r.lang, []).append((r.i, r.x))
    langs_of, centres, least = [], [], []
    for lang in sorted(got):
        own = np.zeros((len(got[lang]), BUCKETS), np.float32)
        for row, (_, raw) in zip(own, sorted(got.pop(lang)), strict=True):
            at, count = np.frombuffer(raw, np.float32).reshape(2, -1)
            row[at.astype(np.int64)] = count
        own = vectors(own, idf)
        c = cluster(own, clusters)
        near = own @ c.T
        best = near.argmax(1)
        for i in range(len(c)):
            mine = near[best == i, i]
            langs_of.append(lang)
            centres.append(c[i])
            least.append(max(0.0, mine.mean() - 4 * mine.std()) if len(mine) else 0.0)
    return Centroids(langs_of, idf, np.stack(centres).astype(np.float32), np.array(least))


def predict(docs: DataFrame, model: Centroids) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the cosine) and rejected (too far from the centroid) of every row.

    lang_pred is `und`, with score 0, for null text and text without a letter, and for all rows
    where no language could be learned. Repeated ids are answered row by row; a null id isn't held out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            lang, cosine, rejected = model.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "lang_pred": pa.array(lang, pa.string()), "score": pa.array(cosine, pa.float64()), "rejected": pa.array(rejected)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
