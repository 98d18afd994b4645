"""Correlation of many metrics by mergeable moments.

A table of moments has a row for each metric and each block of partners, with one array for each
moment: over the entity-years that have both, their number, both means, both sums of squared
deviations and that of products, whether a side is constant, and the range of years. Rows of two tables merge
entry by entry, so a year's cells can be added to what is stored without the old cells. No row
is made for a pair until correlations() reads the arrays.

Cells of an entity-year are gathered into one vector; each partition sweeps its vectors block by
block with matrix products and gives its moments, which are merged by metric and block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Metrics of a block; blocks are by hash of the metric's name, so that tables of moments fit together.
BLOCK = 64
METHOD = "pearson_pairwise_entity_year"

_NUMBERS = ("mx", "my", "vx", "vy", "xy", "lo_x", "hi_x", "lo_y", "hi_y")
_FIELDS = ("n", *_NUMBERS, "year_min", "year_max")
SCHEMA = "metric string, block int, partner array<string>, n array<bigint>, " + ", ".join(f"{c} array<double>" for c in _NUMBERS) + ", year_min array<int>, year_max array<int>"
_NONE = {"n": 0, "lo_x": np.inf, "lo_y": np.inf, "hi_x": -np.inf, "hi_y": -np.inf, "year_min": 2**31 - 1, "year_max": -(2**31)}


def cells(long: DataFrame, entity: str = "entity", year: str = "year", metric: str = "metric", value: str = "value") -> DataFrame:
    """entity, year, metric and v: the mean of each metric for an entity and a year; null keys and values and NaN don't count."""
    known = F.col(metric).isNotNull() & F.col(entity).isNotNull() & F.col(year).isNotNull()
    means = long.where(known).groupBy(F.col(entity).alias("entity"), F.col(year).cast("int").alias("year"), F.col(metric).alias("metric")).agg(F.avg(value).alias("v"))
    return means.where(F.col("v").isNotNull() & ~F.isnan("v"))


def _merged(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Moments of two disjoint sets of cells together, entry by entry (parallel variance)."""
    n = a["n"] + b["n"]
    share = b["n"] / np.maximum(n, 1)
    dx, dy, both = b["mx"] - a["mx"], b["my"] - a["my"], a["n"] * share
    out = {"n": n, "mx": a["mx"] + dx * share, "my": a["my"] + dy * share, "vx": a["vx"] + b["vx"] + dx * dx * both, "vy": a["vy"] + b["vy"] + dy * dy * both, "xy": a["xy"] + b["xy"] + dx * dy * both}
    for c in ("lo_x", "lo_y", "year_min"):
        out[c] = np.minimum(a[c], b[c])
    for c in ("hi_x", "hi_y", "year_max"):
        out[c] = np.maximum(a[c], b[c])
    return out


def _constant(z: np.ndarray, there: np.ndarray, other: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """lo and hi of each column of z over the rows that it has in common with each column of other: the
    value twice where it is the only one, -inf and inf where there are several. Values are
    numbered within their column, so that sums of products decide exactly."""
    codes, values = np.zeros(z.shape), np.zeros(z.shape)
    for i in range(z.shape[1]):
        own, at = np.unique(z[there[:, i] > 0, i], return_inverse=True)
        codes[there[:, i] > 0, i], values[: len(own), i] = at, own
    total, squares = codes.T @ other, (codes * codes).T @ other
    same = (n * squares == total * total) & (n > 0)
    value = np.take_along_axis(values.T, (total / np.maximum(n, 1)).astype(np.int64) % len(z), 1)
    lo = np.where(same, value, np.where(n > 0, -np.inf, np.inf))
    return lo, np.where(same, value, -lo)


def block_moments(x: np.ndarray, y: np.ndarray, years: np.ndarray) -> dict[str, np.ndarray]:
    """Moments of each column of x with each column of y over the rows where both are numbers.

    Sums are taken about each column's own mean, and then about the mean over the common rows.
    lo and hi only tell whether a side is constant: see _constant().
    """
    in_x, in_y = ~np.isnan(x), ~np.isnan(y)
    centre = lambda z, there: np.where(there, z, 0).sum(0) / np.maximum(there.sum(0), 1)
    cx, cy = centre(x, in_x), centre(y, in_y)
    dx, dy, fx, fy = np.where(in_x, x - cx, 0), np.where(in_y, y - cy, 0), in_x.astype(float), in_y.astype(float)
    n = fx.T @ fy
    some = np.maximum(n, 1)
    sx, sy = dx.T @ fy, fx.T @ dy
    out = {"n": n.astype(np.int64), "mx": np.where(n > 0, cx[:, None] + sx / some, 0), "my": np.where(n > 0, cy[None, :] + sy / some, 0)}
    out |= {"vx": np.maximum((dx * dx).T @ fy - sx * sx / some, 0), "vy": np.maximum(fx.T @ (dy * dy) - sy * sy / some, 0), "xy": dx.T @ dy - sx * sy / some}
    out["lo_x"], out["hi_x"] = _constant(x, fx, fy, n)
    out["lo_y"], out["hi_y"] = (m.T for m in _constant(y, fy, fx, n.T))
    for c in ("year_min", "year_max"):
        out[c] = np.full(n.shape, _NONE[c], np.int64)
    for year in np.unique(years)[::-1]:  # from the last: what an earlier one has in common takes its place
        of = years == year
        both = (fx[of].T @ fy[of]) > 0
        out["year_min"][both] = year
        out["year_max"][both & (out["year_max"] == _NONE["year_max"])] = year
    return out


class _State:
    """Moments of two blocks' metrics, which are named as they come."""

    def __init__(self) -> None:
        self.a: dict[str, int] = {}
        self.b: dict[str, int] = {}
        self.m: dict[str, np.ndarray] | None = None

    def add(self, names_a: list[str], names_b: list[str], m: dict[str, np.ndarray]) -> None:
        for index, names in ((self.a, names_a), (self.b, names_b)):
            for name in names:
                index.setdefault(name, len(index))
        shape = len(self.a), len(self.b)
        grown = {}
        for c, v in m.items():
            wide = np.full(shape, _NONE.get(c, 0), v.dtype)
            wide[np.ix_([self.a[x] for x in names_a], [self.b[x] for x in names_b])] = v
            grown[c] = wide
        if self.m is None:
            self.m = grown
            return
        old = {}
        for c, v in self.m.items():
            old[c] = np.full(shape, _NONE.get(c, 0), v.dtype)
            old[c][: v.shape[0], : v.shape[1]] = v
        self.m = _merged(old, grown)

    def rows(self, block_a: int, block_b: int) -> Iterator[pa.RecordBatch]:
        """A row a metric and block of partners, with the partners that come after it in lexical order
        and have cells in common with it. Moments of two blocks are those of the second with the first too."""
        yield _batch(self.a, self.b, self.m, block_b)
        if block_a != block_b:
            turned = {"x": "y", "y": "x"}
            other = {c: self.m[c[:-1] + turned[c[-1]] if c[-2:] in ("mx", "my", "vx", "vy", "_x", "_y") else c].T for c in _FIELDS}
            yield _batch(self.b, self.a, other, block_a)


def _batch(own: dict[str, int], others: dict[str, int], m: dict[str, np.ndarray], block: int) -> pa.RecordBatch:
    partners, out = np.array(list(others), object), {"metric": [], "block": [], "partner": [], **{c: [] for c in _FIELDS}}
    for name, i in own.items():
        some = np.flatnonzero((m["n"][i] > 0) & np.array([p > name for p in partners], bool))
        if len(some):
            out["metric"].append(name)
            out["block"].append(block)
            out["partner"].append(partners[some].tolist())
            for c in _FIELDS:
                out[c].append(m[c][i, some])
    kinds = {"metric": pa.string(), "block": pa.int32(), "partner": pa.list_(pa.string()), "n": pa.list_(pa.int64()), "year_min": pa.list_(pa.int32()), "year_max": pa.list_(pa.int32())}
    return pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.list_(pa.float64()))) for c, v in out.items()})


def moments(found: DataFrame, blocks: int = 1, at_once: int = 512) -> DataFrame:
    """The table of moments (SCHEMA) of cells(): give `blocks` about the number of metrics by BLOCK, and
    the same number for tables that are to be merged.

    An entity-year's cells become one vector, which is copied to each two blocks of which it has
    metrics, inside its task. A partition gives one row a metric and block, whatever its number
    of vectors; those rows are merged by metric and block.
    """
    block = F.pmod(F.xxhash64("metric"), F.lit(blocks)).cast("int")
    vectors = found.groupBy("entity", "year").agg(F.collect_list(F.struct(block.alias("b"), F.col("metric").alias("m"), "v")).alias("cells"))
    has = F.array_sort(F.array_distinct(F.transform("cells", lambda c: c["b"])))
    meets = F.flatten(F.transform(has, lambda i: F.transform(F.filter(has, lambda j: j >= i), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    of = lambda k: F.filter("cells", lambda c: c["b"] == F.col("at")[k])
    rows = vectors.select("year", "cells", F.explode(meets).alias("at")).select(F.col("at.i").alias("i"), F.col("at.j").alias("j"), "year", of("i").alias("x"), of("j").alias("y"))

    def matrix(column: pa.ListArray, n: int) -> tuple[list[str], np.ndarray]:
        flat = column.flatten()
        names, places = np.unique(np.array(flat.field("m").to_pylist(), object), return_inverse=True)
        out = np.full((n, len(names)), np.nan)
        out[np.repeat(np.arange(n), np.diff(column.offsets.to_numpy())), places] = flat.field("v").to_numpy()
        return names.tolist(), out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, now = _State(), None
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                i, j = part.column(0).to_numpy(), part.column(1).to_numpy()
                edges = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
                for a, b in zip(edges, np.append(edges[1:], len(i)), strict=True):
                    if now not in (None, (i[a], j[a])):
                        yield from state.rows(*map(int, now))
                        state = _State()
                    now = (i[a], j[a])
                    own = part.slice(a, b - a)
                    names_a, x = matrix(own.column(3), b - a)
                    names_b, y = matrix(own.column(4), b - a)
                    state.add(names_a, names_b, block_moments(x, y, own.column(2).to_numpy()))
        if now is not None:
            yield from state.rows(*map(int, now))

    parts = rows.sortWithinPartitions("i", "j").mapInArrow(run, SCHEMA)
    return merged([parts])


def merged(tables: list[DataFrame]) -> DataFrame:
    """Several tables of moments as one: of cells that no two of them share, such as those of different years."""

    def run(table: pa.Table) -> pa.Table:
        state = _State()
        for row in table.to_pylist():
            m = {c: np.array([row[c]], np.int64 if c == "n" or "year" in c else float) for c in _FIELDS}
            state.add([row["metric"]], row["partner"], m)
        return pa.Table.from_batches([_batch(state.a, state.b, state.m, table.column("block")[0].as_py())])

    every = reduce(DataFrame.unionByName, tables)
    return every.groupBy("metric", "block").applyInArrow(run, SCHEMA)


def correlations(table: DataFrame, min_overlap: int = 2, sources: DataFrame | None = None, created_at: str | None = None) -> DataFrame:
    """metric_a, metric_b, source_a, source_b, correlation (six places), overlap_records,
    year_min, year_max, method and, if given, created_at.

    Pairs are in lexical order (T9). Those with fewer common cells than min_overlap or a side that
    is constant over them make no row (T8). sources: metric and source_id; where it names several
    sources for a metric, the last by name; a metric without one has none.
    """
    long = table.select("metric", F.explode(F.arrays_zip("partner", *_FIELDS)).alias("p")).select(F.col("metric").alias("metric_a"), F.col("p.partner").alias("metric_b"), *[F.col(f"p.{c}").alias(c) for c in _FIELDS])
    fine = long.where((F.col("n") >= min_overlap) & (F.col("lo_x") < F.col("hi_x")) & (F.col("lo_y") < F.col("hi_y")))
    value = F.round(F.try_divide(F.col("xy"), F.sqrt("vx") * F.sqrt("vy")), 6)
    out = fine.withColumn("correlation", value).where(F.col("correlation").isNotNull() & ~F.isnan("correlation"))
    if sources is not None:
        one = sources.groupBy("metric").agg(F.max("source_id").alias("source_id"))
        for side in "ab":
            out = out.join(one.select(F.col("metric").alias(f"metric_{side}"), F.col("source_id").alias(f"source_{side}")), f"metric_{side}", "left")
    else:
        out = out.withColumns({"source_a": F.lit(None).cast("string"), "source_b": F.lit(None).cast("string")})
    stamp = [] if created_at is None else [F.lit(created_at).alias("created_at")]
    return out.select("metric_a", "metric_b", "source_a", "source_b", "correlation", F.col("n").alias("overlap_records"), "year_min", "year_max", F.lit(METHOD).alias("method"), *stamp)
