"""Bounded, labelled training samples for the document classifiers, and scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import remainder, small_batches
from .bpe import slices

#: The classifiers' bound: labelled documents of each class that are learned from at most.
MAX_EACH = 3000
#: Bits of a feature's hash: of a million features, some hundred share theirs with another.
FEATURE_BITS = 32
#: Rows and bytes of text that are worked on at a time.
_ROWS, _BYTES = 500, 1 << 20
Featurizer = Callable[[list[str | None]], tuple[np.ndarray, np.ndarray]]


def folded(hashes: np.ndarray) -> np.ndarray:
    """64-bit feature hashes as numbers of the fixed table."""
    return hashes >> np.uint64(64 - FEATURE_BITS)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, features: Featurizer, max_each: int = MAX_EACH, folds: int = 5, fold: int = 0) -> list[tuple[int, int, np.ndarray]]:
    """Up to max_each documents of each class as (class, doc_id, feature numbers of the whole text, ascending).

    Taken from labels whose crc32(doc_id as text) mod folds isn't `fold`, by ascending hash of
    doc_id, which is as good as random and the same on every run. Labels other than 0 and 1 and
    null ids don't count; of a repeated id the largest label holds, and of its texts the one whose
    features are largest as bytes. Only the sample's ids (bounded) are broadcast; the features,
    not the texts, come to the driver.
    """
    small_batches(docs.sparkSession)
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (remainder(F.col("doc_id"), folds) != fold))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = known.where("y = 1").orderBy(*order).limit(max_each).unionAll(known.where("y = 0").orderBy(*order).limit(max_each))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _ROWS, _BYTES):
            flat, counts = features(batch.column(2).to_pylist())
            flat = folded(flat).astype("<u4")
            at = np.append(0, np.cumsum(counts))
            own = [np.unique(flat[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_pydict({"y": batch.column(0), "doc_id": batch.column(1).cast(pa.int64()), "own": pa.array(own, pa.binary())})

    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("y", "doc_id", "text").mapInArrow(run, "y int, doc_id bigint, own binary")
    out = [(r.y, r.doc_id, np.frombuffer(r.own, "<u4")) for r in rows.groupBy("doc_id").agg(F.max("y").alias("y"), F.max("own").alias("own")).collect()]
    return sorted(out, key=lambda x: (x[1] * 0x9E3779B97F4A7C15 % (1 << 64), x[1]))


def informative(sample: list[tuple[int, int, np.ndarray]], least: int, most: int) -> np.ndarray:
    """The features, ascending, that at least `least` documents hold, at most `most`: those whose
    share differs most between the classes, in standard errors, and by more of these the larger the
    sample, as chance differences of more terms then reach any fixed number."""
    if not sample:
        return np.zeros(0, np.uint64)
    keys = np.concatenate([x[2] for x in sample])
    y = np.repeat(np.array([x[0] for x in sample], np.int8), [len(x[2]) for x in sample])
    keys, row = np.unique(keys, return_inverse=True)
    n = np.array([sum(x[0] == c for x in sample) for c in (0, 1)]) + 1.0
    count = np.stack([np.bincount(row[y == c], minlength=len(keys)) for c in (0, 1)])
    share = (count + 0.5) / n[:, None]
    error = np.sqrt((share * (1 - np.minimum(share, 0.999)) / n[:, None]).sum(0))
    strength = np.abs(share[1] - share[0]) / error
    strong = 1.5 + 0.35 * np.log(n.min())
    often = np.flatnonzero((count.sum(0) >= least) & (strength >= strong))
    best = often[np.argsort(-strength[often], kind="stable")[:most]]
    return np.sort(keys[best])


def scores(text: Column, scorer: Callable[[], Callable[[list[str | None]], np.ndarray]]) -> Column:
    """The score of a text: only texts go to the Python workers, and are scored some at a time."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = scorer()
        for batch in batches:
            parts = [score(part.column(0).to_pylist()) for part in slices([pa.RecordBatch.from_arrays([batch], ["text"])], _ROWS, _BYTES)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return F.arrow_udf(run, "double").asNondeterministic()(text)


def score_rows(docs: DataFrame, scorer: Callable[[], Callable[[list[str | None]], np.ndarray]]) -> DataFrame:
    """doc_id and score of every row. No shuffle."""
    return docs.select("doc_id", scores(F.col("text"), scorer).alias("score"))
