"""Exact top-k by inner product with no random access (operator 7).

Every dimension of a block of vectors is a list of (vector, value) sorted by value. For a query,
the lists are read in parallel from their best ends, in stretches: what a read entry adds goes to
its vector's sum. A vector's score lies between its sum plus the worst of its unread lists and
its sum plus the values at which their reading stands. A vector whose upper bound is below the
k-th best lower bound is out; when no more than k are left, outsiders can't qualify and reading
stops. Then the lists are read on, for those that are left only, until every one of their
entries has come by: their sums are the final scores. No vector is ever looked up by its number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a block, queries of a block, and queries that are answered at a time.
BLOCK, QUERIES, AT_ONCE = 4096, 8192, 256
#: Shares of the lists by which bounds are looked at.
STRETCHES = (0.05, 0.25, 0.55, 0.8, 0.92, 0.97, 0.99, 1.0)


class SortedLists:
    """One block: its dimensions' lists, sorted by value, which can be read from either end.

    Sums are exact: doubles while every score is below 2**53, else 64-bit integers; scores that
    may not fit into these are an error.
    """

    def __init__(self, x: np.ndarray):
        x = x.astype(np.int64)
        self.n, self.dims = x.shape
        self.ids = np.argsort(x, axis=0, kind="stable")
        self.values = np.take_along_axis(x, self.ids, 0)
        self.largest = float(np.abs(x.astype(float)).max(initial=0))

    def depths(self) -> list[int]:
        """How far the lists are read by the end of each stretch."""
        return sorted({min(self.n, max(1, round(self.n * x))) for x in STRETCHES if self.n})

    def top(self, q: np.ndarray, k: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], list[float]]:
        """For each query (row of q), the vectors that can be among its k best or tie with the
        k-th, and their final scores; and the share of the lists that was read when reading
        stopped, and when the last score was complete.

        Every entry counts as its list's worst value until it is read, which adds the difference:
        the sums are the lower bounds, and the scores once all of a vector's entries were read.
        """
        most = self.dims * self.largest * float(np.abs(q.astype(float)).max(initial=0))
        if most >= 2.0**61:
            raise OverflowError("scores don't fit into 64 bits")
        kind = np.float64 if most < 2.0**52 else np.int64
        lists = self.values.astype(kind)
        sides = [np.maximum(q, 0).T.astype(kind), np.minimum(q, 0).T.astype(kind)]  # dims by queries: read from the top, from the bottom
        worst = [lists[0], lists[-1]]
        lower = np.tile(worst[0] @ sides[0] + worst[1] @ sides[1], (self.n, 1))
        unread = [np.ones((self.n, self.dims), kind) for _ in sides]
        alive, some = np.ones((self.n, len(q)), bool), np.ones(self.n, bool)
        column = np.broadcast_to(np.arange(self.dims), self.ids.shape)

        def read(start: int, end: int, rows: np.ndarray) -> None:
            place = np.zeros(self.n, np.int64)
            place[rows] = np.arange(len(rows))
            for side, weights in enumerate(sides):
                s = slice(self.n - end, self.n - start) if side == 0 else slice(start, end)
                wanted = some[self.ids[s]]
                ids, dims = self.ids[s][wanted], column[s][wanted]
                gain = np.zeros((len(rows), self.dims), kind)
                gain[place[ids], dims] = (lists[s] - worst[side])[wanted]
                unread[side][ids, dims] = 0
                lower[rows] += gain @ weights

        at, stopped, depths = 0, 1.0, self.depths()
        for depth in depths:
            rows = np.flatnonzero(some)
            read(at, depth, rows)
            at, stopped = depth, depth / self.n
            reach = [lists[self.n - depth], lists[depth - 1]]
            low = lower[rows]
            upper = low + sum(unread[i][rows] @ ((reach[i] - worst[i])[:, None] * sides[i]) for i in (0, 1))
            low[~alive[rows]] = -(2**61)
            for kk in np.unique(k).tolist():
                if kk <= len(rows):
                    col = np.flatnonzero(k == kk)
                    bar = np.partition(low[:, col], len(rows) - kk, axis=0)[len(rows) - kk]
                    alive[np.ix_(rows, col)] &= upper[:, col] >= bar
            some = alive.any(1)
            if (alive.sum(0) <= k).all():
                break
        for depth in depths[depths.index(at) + 1 :] if at else []:
            rows = np.flatnonzero(some)
            if not any((unread[i][rows] @ (sides[i] != 0)).any() for i in (0, 1)):
                break
            read(at, depth, rows)
            at = depth
        rows = [np.flatnonzero(alive[:, j]) for j in range(len(q))]
        return rows, [lower[r, j].astype(np.int64) for j, r in enumerate(rows)], [stopped, at / max(self.n, 1)]


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best by descending score, then ascending id."""
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def quantized(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and v = floor(scale * x) of the vectors that take part: not null, no null or non-finite component, not empty."""
    v = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~F.coalesce(bad, F.lit(True))).select("vec_id", v.alias("v"))


def search(vectors: DataFrame, every: int = 100, k: int = 10, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """The k best vectors for each query (rows whose vec_id is divisible by `every`): query_id,
    rank, vec_id, score; exact, ties to the smaller vec_id; a query's own row is no candidate.

    Vectors and queries are dealt to blocks of bounded size by hash of id, and each pair of
    blocks meets in one group, so no task holds more than a block of each; a block's results per
    query are at most k rows. Vectors only meet queries of their own length. Rows that repeat a
    vec_id are candidates of their own; of a repeated query id only one row asks: the smallest
    vector. No vectors give no rows.
    """
    data = quantized(vectors)
    sizes = data.agg(F.count("*").alias("n"), F.sum((F.col("vec_id") % every == 0).cast("int")).alias("q")).first()
    n_blocks, q_blocks = max(1, -(-sizes.n // block)), max(1, -(-(sizes.q or 0) // queries))
    spread = lambda n, seed: F.pmod(F.xxhash64("vec_id", "v", F.lit(seed)), F.lit(n)).cast("int")
    rows = data.select("vec_id", "v", spread(n_blocks, 1).alias("block"), F.lit(False).alias("asks"))
    asked = data.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    rows = rows.select("block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q_block"), "asks", "vec_id", "v")
    asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), spread(q_blocks, 2).alias("q_block"), F.lit(True).alias("asks"), "vec_id", "v")

    def run(table: pa.Table) -> pa.Table:
        asks = np.array(table.column("asks"))
        ids = np.array(table.column("vec_id"))
        vs = table.column("v").combine_chunks()
        size = np.diff(vs.offsets.to_numpy())
        at = vs.offsets.to_numpy()[:-1]
        flat = vs.values.to_numpy()
        out: list[tuple[int, int, int]] = []
        for dims in np.unique(size[asks]).tolist():
            own = np.flatnonzero(~asks & (size == dims))
            if not len(own):
                continue
            lists = SortedLists(flat[at[own][:, None] + np.arange(dims)])
            every_id = ids[own]
            asking = np.flatnonzero(asks & (size == dims))
            for some in np.array_split(asking, -(-len(asking) // AT_ONCE)):
                # the query's own rows may be among the best: room for them, then out
                mine = np.array([int((every_id == i).sum()) for i in ids[some]])
                rows_, scores, _ = lists.top(flat[at[some][:, None] + np.arange(dims)], k + mine)
                for i, r, s in zip(ids[some].tolist(), rows_, scores, strict=True):
                    keep = every_id[r] != i
                    got, best = best_of(every_id[r[keep]], s[keep], k)
                    out += [(i, a, b) for a, b in zip(got.tolist(), best.tolist(), strict=True)]
        cols = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), cols, strict=True)})

    near = rows.unionByName(asked).groupBy("block", "q_block").applyInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
