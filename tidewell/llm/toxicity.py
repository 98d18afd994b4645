"""Toxicity (operator 9): a factorization machine over hashed terms.

score = sigmoid(w0 + sum w_i + sum_{i<j} <v_i, v_j>) over the terms of a text, so a pair of
terms can weigh more, or less, than the two of them alone. Terms are words and their first
letters, which catch inflected forms; the pair sum costs one pass by
sum_{i<j} <v_i, v_j> = (|sum v_i|^2 - sum |v_i|^2) / 2.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._arrays import TERM_CLASS, Sparse, Tokens, release
from ._labelled import MAX_EACH, folded, informative, labelled_sample, score_rows, scores
from ._shared import remainder

THRESHOLD = 0.5
#: Most terms of the first passes, dimensions of a term's vector, bytes of the word beginnings.
TERMS, FACTORS, PREFIXES = 4096, 8, (4, 6)


def terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and word beginnings of all texts, and how many each text has."""
    tokens = Tokens([(t or "").lower().encode() for t in texts], TERM_CLASS, PREFIXES)
    word = tokens.kind == 1
    doc = tokens.docs()[word]
    flat = np.stack([tokens.hash[word], *(p[word] for p in tokens.prefix)], 1).reshape(-1)
    return flat, (1 + len(PREFIXES)) * np.bincount(doc, minlength=len(texts)).astype(np.int64)


@dataclass(frozen=True)
class FactorModel:
    keys: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    bias: float

    def raw(self, own: np.ndarray) -> float:
        v = self.factors[own]
        total = v.sum(0)
        return self.bias + self.weights[own].sum() + 0.5 * float(total @ total - (v * v).sum())

    def scorer(self):
        sparse = Sparse(self.keys)

        def score(texts: list[str | None]) -> np.ndarray:
            flat, counts = terms(texts)
            doc = np.repeat(np.arange(len(texts)), counts)
            at, row = sparse.find(folded(flat))
            out = np.full(len(texts), self.bias)
            if len(at):
                seen = np.unique(doc[at] * len(self.keys) + row)
                d, i = seen // len(self.keys), seen % len(self.keys)
                first = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
                ends = np.append(first, len(i))
                for some in np.array_split(np.arange(len(first)), min(len(first), 1 + (len(i) >> 18))):
                    a, z = ends[some[0]], ends[some[-1] + 1]
                    v = self.factors[i[a:z]]
                    total = np.add.reduceat(v, first[some] - a)
                    own = np.add.reduceat(self.weights[i[a:z]] - 0.5 * (v * v).sum(1), first[some] - a)
                    out[d[first[some]]] += own + 0.5 * (total * total).sum(1)
            return 1 / (1 + np.exp(-np.clip(out, -40, 40)))

        return score


def factorize(sample: list[tuple[int, int, np.ndarray]], most: int = TERMS, factors: int = FACTORS, least: int = 5, rate: float = 0.2, l1: float = 1e-3, l2: float = 1e-3, epochs: int = 8) -> FactorModel:
    """Stochastic gradient descent with per-coordinate steps (AdaGrad) on the logistic loss.

    Every term that at least `least` documents of the sample hold has a weight and a vector. The
    first `epochs` passes learn the `most` terms that tell the classes apart best on their own,
    the next as many all terms: what the first explain leaves little to learn, so that the many
    others only move, by smaller first steps, where their pairs are needed. Of these passes, as
    many count as the loss on a tenth of the sample, which isn't learned from, asks for; after two
    that don't lower it, no more are made. Weights are soft-thresholded by l1. Without both
    classes the score is constant.
    """
    classes = {y for y, *_ in sample}
    keys, count = np.unique(np.concatenate([x[2] for x in sample]) if sample else np.zeros(0), return_counts=True)
    keys = keys[count >= least].astype(np.uint64)
    if len(classes) < 2 or not len(keys):
        return FactorModel(np.zeros(0, np.uint64), np.zeros(0), np.zeros((0, factors)), 3.0 if classes == {1} else -3.0)
    strong = np.isin(keys, informative(sample, least, most))
    release()
    sparse = Sparse(keys)
    rows = [(y, sparse.find(own)[1].astype(np.int32)) for y, _, own in sample]
    tenth, rows = (rows[::10], [r for i, r in enumerate(rows) if i % 10]) if len(rows) >= 200 else ([], rows)
    n = [max(1, sum(y == c for y, _ in rows)) for c in (0, 1)]
    heft = [len(rows) / (2 * x) for x in n]
    rng = np.random.Generator(np.random.PCG64(11))
    w, v, b = np.zeros(len(keys)), rng.normal(0, 0.01, (len(keys), factors)), 0.0
    gw, gb = np.where(strong, 1e-6, 10.0), 1e-6
    gv = np.repeat(np.where(strong, 1e-4, 1.0)[:, None], factors, 1)
    flat, size = np.concatenate([np.zeros(0, np.int32), *(own for _, own in tenth)]), np.array([len(own) for _, own in tenth], int)
    doc, truth = np.repeat(np.arange(len(tenth)), size), np.array([y for y, _ in tenth])

    def loss() -> float:
        f = v[flat]
        total = np.stack([np.bincount(doc, f[:, j], len(tenth)) for j in range(factors)], 1)
        raw = b + np.bincount(doc, w[flat] - 0.5 * (f * f).sum(1), len(tenth)) + 0.5 * (total * total).sum(1)
        return float((np.logaddexp(0, np.where(truth == 1, -raw, raw)) * np.array(heft)[truth]).sum())

    best, in_vain = None, 0

    def kept() -> int:
        """Keeps the model if it is the best so far; how many in a row were not."""
        nonlocal best
        now = loss()
        if best is None or now < best[0]:
            best = (now, w.copy(), v.copy(), b)
            return 0
        return in_vain + 1

    for turn, some in enumerate(epochs * [[(y, own[strong[own]]) for y, own in rows]] + epochs * [rows]):
        if turn >= epochs and tenth:
            in_vain = kept()
            if in_vain == 2:
                break
        for y, own in some:
            f = v[own]
            total = f.sum(0)
            raw = b + w[own].sum() + 0.5 * (total @ total - (f * f).sum())
            g = (1 / (1 + np.exp(-np.clip(raw, -35, 35))) - y) * heft[y]
            gb += g * g
            b -= rate * g / np.sqrt(gb)
            gw[own] += g * g
            step = rate / np.sqrt(gw[own])
            x = w[own] - step * g
            w[own] = np.sign(x) * np.maximum(np.abs(x) - step * l1, 0)
            dv = g * (total - f) + l2 * f
            gv[own] += dv * dv
            v[own] = f - 0.25 * rate * dv / np.sqrt(gv[own] + 1e-2)
    if tenth:
        kept()
        _, w, v, b = best
    return FactorModel(keys, w, v, float(b))


def fit(docs: DataFrame, labels: DataFrame, max_each: int = MAX_EACH) -> FactorModel:
    """Learns labels.toxic from at most max_each training documents of each class."""
    model = factorize(labelled_sample(docs, labels, "toxic", terms, max_each))
    release()
    return model


def score(docs: DataFrame, model: FactorModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs; null text scores as empty text
    (the model's bias). Repeated ids are scored row by row; a null id is not held out."""
    out = score_rows(docs, model.scorer)
    return out.select("doc_id", F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: FactorModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, whose score is below the threshold."""
    return docs.where(scores(F.col("text"), model.scorer) < threshold)
