"""Row choice, merges, joins and set operations.

Where the row kept depends on an order, the order is an explicit argument and ties end in it;
nothing relies on the physical order of rows (T7).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def first_wins(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    return pick(df, keys, F.col(seq).asc())


def last_wins(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    return pick(df, keys, F.col(seq).desc())


def latest(df: DataFrame, keys: Sequence[str], time: str, seq: str) -> DataFrame:
    """The row with the greatest time; of equals, the first."""
    return pick(df, keys, F.col(time).desc(), F.col(seq).asc())


def latest_available(cols: Sequence[tuple[str, str]]) -> Column:
    """Struct of label and value of the last positive one among (label, column) in their order."""
    return F.coalesce(*[F.when(F.col(c) > 0, F.struct(F.lit(label).alias("label"), F.col(c).cast("double").alias("value"))) for label, c in reversed(cols)])


def priority_merge(tiers: Sequence[DataFrame], keys: Sequence[str], seq: str = "seq", last_in_first: bool = True) -> DataFrame:
    """For each key the row of the first tier that has it; in the first tier the last row wins, in the others the first."""
    marked = [t.withColumn("_prio", F.lit(i)).withColumn("_seq", F.col(seq) * (-1 if i == 0 and last_in_first else 1)) for i, t in enumerate(tiers)]
    return pick(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked), keys, F.col("_prio"), F.col("_seq")).drop("_prio", "_seq")


def fill_gaps(main: DataFrame, other: DataFrame, keys: Sequence[str], distinct_by: str | None = None) -> DataFrame:
    """Main, and the rows of other whose key main lacks; of these, with distinct_by, the first of each key only."""
    new = other.join(main.select(*keys).distinct(), list(keys), "left_anti")
    if distinct_by:
        new = first_wins(new, keys, distinct_by)
    return main.unionByName(new, allowMissingColumns=True)


def complete_domain(domain: DataFrame, facts: DataFrame, keys: Sequence[str], defaults: dict) -> DataFrame:
    """Every row of the domain, with defaults where it has no fact."""
    return domain.join(facts, list(keys), "left").na.fill(defaults)


def top_groups(df: DataFrame, key: str, measure: str, time: str, seq: str, n: int = 8) -> DataFrame:
    """The rows of the n keys whose latest measure is largest."""
    best = latest(df, [key], time, seq).orderBy(F.col(measure).desc(), F.col(key)).limit(n).select(key)
    return df.join(best, key, "left_semi")


def with_row_index(df: DataFrame, keys: Sequence[str], *order: Column, name: str = "row_index") -> DataFrame:
    """0-based position of each row within its key."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def value_share(df: DataFrame, col: str) -> DataFrame:
    """Count and share of each value, null included."""
    counts = df.groupBy(col).agg(F.count("*").alias("n"))
    return counts.crossJoin(F.broadcast(df.agg(F.count("*").alias("all")))).select(col, "n", (F.col("n") / F.col("all")).alias("share"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Size of both key sets and of their intersection, and its share of the smaller."""
    marked = a.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(b.select(key, F.lit(0), F.lit(1))).where(F.col(key).isNotNull()).groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    out = marked.agg(F.coalesce(F.sum("l"), F.lit(0)).alias("n_a"), F.coalesce(F.sum("r"), F.lit(0)).alias("n_b"), F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0)).alias("n_both"))
    return out.withColumn("overlap", F.col("n_both") / F.greatest(F.lit(1), F.least("n_a", "n_b")))


def set_difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of one side only; no rows if the sets are equal."""
    x, y = a.select(*keys).distinct(), b.select(*keys).distinct()
    return x.join(y, list(keys), "left_anti").withColumn("side", F.lit("only_a")).unionAll(y.join(x, list(keys), "left_anti").withColumn("side", F.lit("only_b")))


def shard(df: DataFrame, key: str, n: int, i: int) -> DataFrame:
    """One of n disjoint shards, by hash of the key: no global order is needed to deal them."""
    return df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i)


def merge_shards(shards: Iterable[DataFrame], keys: Sequence[str], *order: Column) -> DataFrame:
    """Shards together, exact duplicates dropped, rows numbered anew within the keys."""
    return with_row_index(reduce(DataFrame.unionByName, shards).distinct(), keys, *order)


def scaled(value: Column, low: Column, high: Column, to: tuple[float, float]) -> Column:
    """Min-max scaling; the middle where all values are equal."""
    a, b = to
    return F.when(high > low, a + (value - low) / (high - low) * (b - a)).otherwise((a + b) / 2)


def every_nth(df: DataFrame, keys: Sequence[str], parts: int, *order: Column) -> DataFrame:
    """Of each key's n rows in the given order, every floor(n / parts)-th, from the first (every one, if n < parts)."""
    w = Window.partitionBy(*keys)
    marked = df.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    return marked.where(F.col("_i") % F.greatest(F.lit(1), F.floor(F.col("_n") / parts)) == 0).drop("_i", "_n")


def best_first(df: DataFrame, *measures: str, tie: str) -> DataFrame:
    """Rows by descending sum of the measures, null as 0; equals by tie. A range-partitioned sort."""
    total = sum((F.coalesce(F.col(m), F.lit(0)) for m in measures), F.lit(0))
    return df.orderBy(total.desc(), F.col(tie).asc())


def examples(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows in the given order."""
    return df.orderBy(*order).limit(n)


def mode(df: DataFrame, keys: Sequence[str], value: str, seq: str) -> DataFrame:
    """Each key's most frequent value, and how often it occurs; of equally frequent ones the one seen first by seq."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(seq).alias("_first"))
    return pick(counts, keys, F.col("n").desc(), F.col("_first").asc(), F.col(value).asc_nulls_last()).drop("_first")


def remapped_sum(df: DataFrame, key: str, value: str, table: dict[str, str]) -> DataFrame:
    """Sums by key, where keys of the table count for the key that it names."""
    entries = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return df.groupBy(F.coalesce(F.try_element_at(entries, F.col(key)), F.col(key)).alias(key)).agg(F.sum(value).alias(value))


def arg_max(df: DataFrame, keys: Sequence[str], measure: str, tie: str) -> DataFrame:
    """Each key's row with the largest measure (null last), of equals the smallest tie."""
    return pick(df, keys, F.col(measure).desc_nulls_last(), F.col(tie).asc())


def merged_counts(tables: Sequence[DataFrame], key: str, cols: Sequence[str]) -> DataFrame:
    """The counts of several shards' reports, summed by key; null counts as 0."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return every.groupBy(key).agg(*[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in cols])


def first_wide(df: DataFrame, ids: Sequence[str], name: str, value: str, names: Sequence[str], seq: str) -> DataFrame:
    """One column for each of names: the value of its first row by seq that has one."""
    return df.groupBy(*ids).agg(*[F.min_by(F.when(F.col(name) == n, F.col(value)), F.when((F.col(name) == n) & F.col(value).isNotNull(), F.col(seq))).alias(n) for n in names])


def remaining(total: Column, part: Column) -> Column:
    """F32: what a part leaves of a total, 0 at least; null counts as 0."""
    return F.greatest(F.lit(0.0), F.coalesce(total.cast("double"), F.lit(0.0)) - F.coalesce(part.cast("double"), F.lit(0.0)))


def with_defaults(expected: DataFrame, found: DataFrame, key: str, col: str, default: str) -> DataFrame:
    """Every expected key with its found value, or the default."""
    return expected.select(key).join(found.select(key, col), key, "left").select(key, F.coalesce(col, F.lit(default)).alias(col))
