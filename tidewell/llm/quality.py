"""Quality classifier (operator 4): logistic regression on hashed word n-grams, learned by
follow-the-regularised-leader updates and scored as sparse dot products."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._arrays import TERM_CLASS, Sparse, Tokens, U, mix, pair_hash, release
from ._labelled import MAX_EACH, folded, labelled_sample, score_rows, scores
from ._shared import remainder

THRESHOLD = 0.3
_SAME = U(0x5EED5EED5EED5EED)


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 1- and 2-grams of all texts, and how many each has. Words are runs of
    letters and digits or of symbols, in lower case; a word that repeats the one before it counts
    as "the same", so that a run of any word is one feature."""
    tokens = Tokens([(t or "").lower().encode() for t in texts], TERM_CLASS)
    h, n = tokens.hash, np.diff(tokens.offsets)
    if not len(h):
        return h, n
    doc = tokens.docs()
    inner = np.append(False, doc[1:] == doc[:-1])
    before = np.append(U(0), h[:-1])
    same = inner & (before == h)
    word = np.where(same, _SAME, h)
    gram = pair_hash(np.where(np.append(False, same[:-1]), _SAME, before), word)
    two = np.stack([mix(word), np.where(inner, gram, mix(word))], 1).reshape(-1)
    return two, 2 * n


@dataclass(frozen=True)
class LinearModel:
    """Weights of the features that have one; all others weigh nothing."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def scorer(self):
        sparse = Sparse(self.keys)

        def score(texts: list[str | None]) -> np.ndarray:
            flat, counts = ngrams(texts)
            doc = np.repeat(np.arange(len(texts)), counts)
            at, row = sparse.find(folded(flat))
            seen = np.unique(doc[at] * len(self.keys) + row) if len(at) else np.zeros(0, np.int64)
            dot = np.bincount(seen // max(1, len(self.keys)), self.weights[seen % max(1, len(self.keys))], len(texts)) if len(seen) else np.zeros(len(texts))
            return 1 / (1 + np.exp(-np.clip(dot + self.bias, -40, 40)))

        return score


def ftrl(sample: list[tuple[int, int, np.ndarray]], alpha: float = 0.1, beta: float = 1.0, l1: float = 2.0, l2: float = 1.0, epochs: int = 3, least: int = 3) -> LinearModel:
    """Per-coordinate FTRL-proximal over the sample, in its order; features are present or not.

    Weights whose accumulated gradient stays within l1 are exactly 0 and aren't kept. Features
    that fewer than `least` documents of the sample hold are left out. Without both classes the score
    is the known class's, 0.5 without any.
    """
    classes = {y for y, *_ in sample}
    if len(classes) < 2:
        return LinearModel(np.zeros(0, np.uint64), np.zeros(0), {frozenset(): 0.0, frozenset({1}): 3.0, frozenset({0}): -3.0}[frozenset(classes)])
    keys, count = np.unique(np.concatenate([x[2] for x in sample]), return_counts=True)
    keys = keys[count >= least].astype(np.uint64)
    sparse = Sparse(keys)
    rows = [(y, sparse.find(own)[1]) for y, _, own in sample]
    z, n = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)  # the last is the bias, which l1 spares

    def weight(i: np.ndarray) -> np.ndarray:
        limit = np.where(i == len(keys), 0.0, l1)
        return np.where(np.abs(z[i]) <= limit, 0.0, -(z[i] - np.sign(z[i]) * limit) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for y, own in rows:
            i = np.append(own, len(keys))
            w = weight(i)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - y
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    w = weight(np.arange(len(keys) + 1))
    some = np.flatnonzero(w[:-1])
    return LinearModel(keys[some], w[some], float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame, max_each: int = MAX_EACH) -> LinearModel:
    """Learns labels.quality from at most max_each training documents of each class."""
    model = ftrl(labelled_sample(docs, labels, "quality", ngrams, max_each))
    release()
    return model


def score(docs: DataFrame, model: LinearModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs; null text scores as empty text
    (the model's bias). Repeated ids are scored row by row; a null id is not held out."""
    out = score_rows(docs, model.scorer)
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: LinearModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, whose score is at least the threshold."""
    return docs.where(scores(F.col("text"), model.scorer) >= threshold)
