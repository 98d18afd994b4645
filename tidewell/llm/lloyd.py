"""Centroid clustering: plain Lloyd on integers (operator 11).

Vectors become integers, so that every sum and distance is exact and no result depends on the
order of rows or partitions. Each round broadcasts the centroids and reads the vectors once:
mapInPandas finds the nearest centroid of each vector by integer squared differences and adds up
its own rows; of a partition come at most clusters x dimensions sums, which groupBy merges. Only
the merged sums, as many, come to the driver. Nothing is cached or written between rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLUSTERS, ROUNDS, SCALE, DIMS = 40, 5, 256, 64
#: Vectors that are compared with the centroids at a time: their differences stay in a core's cache.
_AT_ONCE = 1024


def quantized(frame: pd.DataFrame, dims: int = DIMS, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Places in frame of the vectors that take part (exactly dims components, none null or
    non-finite), and their integer components floor(scale * x), x as double."""
    rows = [i for i, v in enumerate(frame["embedding"]) if v is not None and len(v) == dims]
    if not rows:
        return np.zeros(0, np.int64), np.zeros((0, dims), np.int64)
    x = np.array([np.asarray(frame["embedding"].iloc[i], np.float64) for i in rows])  # None becomes not a number
    with np.errstate(over="ignore"):
        v = np.floor(scale * x)
    fine = np.isfinite(x).all(1)
    v = v[fine]
    # squared distances of two such vectors stay below 2**63
    if len(v) and np.abs(v).max() >= np.sqrt(2.0**61 / dims):
        raise OverflowError("squared distances don't fit into 64 bits")
    return np.array(rows)[fine], v.astype(np.int64)


def nearest(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the number of the nearest centroid (of equals the smallest) and the squared distance."""
    largest = max(np.abs(v).max(initial=0), np.abs(centroids).max(initial=0))
    kind = np.int32 if v.shape[1] * (2 * int(largest)) ** 2 < 2**31 else np.int64
    small, centres = v.astype(kind), centroids.astype(kind)
    number, distance = np.empty(len(v), np.int32), np.empty(len(v), np.int64)
    for at in range(0, len(v), _AT_ONCE):
        part = small[at : at + _AT_ONCE]
        squared = np.empty((len(centres), len(part)), kind)
        for i, centre in enumerate(centres):
            d = part - centre
            np.einsum("ij,ij->i", d, d, out=squared[i])
        best = squared.argmin(0)
        number[at : at + len(part)] = best
        distance[at : at + len(part)] = squared[best, np.arange(len(part))]
    return number, distance


def _hashes(ids: pd.Series, prefix: str) -> list[str]:
    """Lower-case hex digests of prefix and id; behind all of them, where the id is null."""
    return ["~" if i is None else hashlib.sha256(f"{prefix}{i}".encode()).hexdigest() for i in ids]


def _ids(frame: pd.DataFrame) -> pd.Series:
    """vec_id as Python integers, None where null: ids come as text, as pandas would round them beside a null."""
    return pd.Series([None if i is None or i != i else int(i) for i in frame["vec_id"]], dtype=object)


def _read(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").cast("string").alias("vec_id"), "embedding")


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, scale: int = SCALE, dims: int = DIMS, prefix: str = "2:") -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in that order; of a repeated id, the smallest vectors first."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[str, list[int]]] = []
        for frame in frames:
            rows, v = quantized(frame, dims, scale)
            h = np.array(_hashes(_ids(frame).iloc[rows], prefix))
            if len(h) > clusters:  # those beyond the clusters-th hash can't be among the first
                some = np.flatnonzero(h <= np.partition(h, clusters - 1)[clusters - 1])
            else:
                some = np.arange(len(h))
            held = sorted(held + [(str(h[i]), v[i].tolist()) for i in some])[:clusters]
        yield pd.DataFrame(held, columns=["h", "v"], dtype=object)

    first = _read(vectors).mapInPandas(run, "h string, v array<bigint>").orderBy("h", "v").limit(clusters).collect()
    return np.array([r.v for r in first], np.int64).reshape(len(first), dims)


def _sums(vectors: DataFrame, centroids: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each centroid: how many vectors it is nearest to, their componentwise sums, and the sum of
    their squared distances; exact, as Python integers."""
    k, dims = centroids.shape
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # column 0 counts, columns 1 and 2 add up the distances' lower and upper 32 bits, the others components
        total = np.zeros((k, dims + 3), np.int64)
        for frame in frames:
            _, v = quantized(frame, dims, scale)
            number, distance = nearest(v, shared.value)
            for i in np.unique(number):
                own = number == i
                total[i] += np.concatenate([[own.sum(), (distance[own] & 0xFFFFFFFF).sum(), (distance[own] >> 32).sum()], v[own].sum(0)])
        cluster, place = np.nonzero(total)
        yield pd.DataFrame({"cluster": cluster.astype(np.int32), "place": place.astype(np.int32), "total": total[cluster, place]})

    parts = _read(vectors).mapInPandas(run, "cluster int, place int, total bigint")
    merged = parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    shared.destroy()
    out = np.zeros((k, dims + 3), object)
    for r in merged:
        out[r.cluster, r.place] = int(r.total)
    return out[:, 0], out[:, 3:], out[:, 1] + out[:, 2] * 2**32


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def fit(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, dims: int = DIMS) -> np.ndarray:
    """Integer centroids (clusters x dims, fewer if there are fewer vectors) after so many rounds of
    Lloyd's algorithm. A centroid without vectors stays where it is."""
    centroids = first_centroids(vectors, clusters, scale, dims)
    for _ in range(rounds if len(centroids) else 0):
        n, sums, _ = _sums(vectors, centroids, scale)
        centroids = np.array([s // c if c else old for c, s, old in zip(n, sums, centroids, strict=True)], np.int64).reshape(centroids.shape)
    return centroids


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, dims: int = DIMS) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia and inertia (distances summed over the
    cluster and over all), and centroid_sha256 (of the centroid's components in decimal, joined
    by commas), one row a vector that takes part.

    Vectors take part if they are not null, have exactly dims components, and none of these is
    null or non-finite; an empty vector has none. Rows that repeat a vec_id are vectors of their
    own. A vector with a null vec_id is clustered too, but becomes a first centroid only where
    other vectors don't suffice. Equal distances go to the smaller cluster number. With fewer
    vectors than clusters, each is a centroid at first; without any, the result is empty.
    Components whose squares might not fit into 64 bits (about 2**27 for 64 dimensions, after
    scaling) are an error, as no distance could be returned. Further columns aren't read.
    """
    centroids = fit(vectors, clusters, rounds, scale, dims)
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    digests = np.array([centroid_digest(c) for c in centroids] or [""], object)
    inertia = np.zeros(1, np.int64)
    if len(centroids):
        inertia = _sums(vectors, centroids, scale)[2]
    if sum(inertia.tolist()) >= 2**63:
        raise OverflowError("the inertia doesn't fit into 64 bits")
    inertia = inertia.astype(np.int64)
    shared = vectors.sparkSession.sparkContext.broadcast((centroids, inertia, digests))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, sums, names = shared.value
        for frame in frames:
            rows, v = quantized(frame, dims, scale)
            if len(rows):
                number, distance = nearest(v, centres)
                ids = pd.array(_ids(frame).iloc[rows].tolist(), dtype="Int64")
                yield pd.DataFrame({"vec_id": ids, "cluster": number, "distance": distance, "cluster_inertia": sums[number], "inertia": int(sums.sum()), "centroid_sha256": names[number]})

    return _read(vectors).mapInPandas(run, schema)
