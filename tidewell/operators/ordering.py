"""Positions in a whole table (W05, W09, W10, W11, R14, V15, O09): numbering rows without a window over all of them.

A window without keys is one task. Here rows are range-partitioned by Spark's sampled exchange,
sorted, and written once with their place in their partition; the partitions' sizes give what is
to be added to it. Only these sizes, one number a partition, come to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.io import scratch_dir

_PART, _NTH = "_part", "_nth"


def global_index(df: DataFrame, *order: Column, name: str = "row_index", partitions: int | None = None) -> DataFrame:
    """The 0-based position of each row in the whole table.

    Rows that are equal in the order stand by a hash of all their columns, so that a value that
    very many rows have is dealt to several partitions too; which of two wholly equal rows comes
    first makes no difference. Nulls stand where the order puts them. An empty table stays empty.
    The rows are read from a table in the scratch folder, which stays there.
    """
    spark = df.sparkSession
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if not _is_map(df, c)]) if df.columns else F.lit(0)
    sort = [*order, tie]
    dealt = (df.repartitionByRange(partitions, *sort) if partitions else df.repartitionByRange(*sort)).sortWithinPartitions(*sort)
    # a partition's rows are numbered as they are written: the number's lower 33 bits count them
    numbered = dealt.withColumn(_PART, F.spark_partition_id()).withColumn(_NTH, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    path = f"{scratch_dir(spark)}/index-{uuid.uuid4().hex}"
    numbered.write.parquet(path)
    staged = spark.read.schema(numbered.schema).parquet(path)
    sizes = sorted(tuple(r) for r in staged.groupBy(_PART).agg(F.max(_NTH) + 1).collect())
    before = dict(zip([p for p, _ in sizes], [0, *accumulate(n for _, n in sizes)], strict=False))
    starts = spark.createDataFrame(list(before.items()), f"{_PART} int, _start bigint")
    return staged.join(F.broadcast(starts), _PART).withColumn(name, F.col("_start") + F.col(_NTH)).select(*df.columns, name)


def _is_map(df: DataFrame, column: str) -> bool:
    return "map<" in df.schema[column].dataType.simpleString()


def index_in_key(df: DataFrame, keys: Sequence[str], *order: Column, name: str = "row_index", partitions: int | None = None) -> DataFrame:
    """The 0-based position of each row within its key, for keys of any size: where one key
    holds a large part of the table, a window by keys would put that part into one task.

    The position in the whole table by key and order, less the key's first one. The first
    positions are pre-aggregated, and of the two sides of the join the rows' may be skewed only.
    """
    whole = global_index(df, *[F.col(k).asc_nulls_first() for k in keys], *order, name="_at", partitions=partitions)
    first = whole.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min("_at").alias("_first"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return whole.join(first, same).select(*df.columns, (F.col("_at") - F.col("_first")).alias(name))


def deal(df: DataFrame, n: int, *order: Column, name: str = "shard") -> DataFrame:
    """N shards by position, as items of a list are dealt in turn: row i goes to shard i % n
    as the row i // n of it (name + "_row")."""
    return global_index(df, *order, name="_at").select(*df.columns, (F.col("_at") % n).cast("int").alias(name), F.floor(F.col("_at") / n).alias(f"{name}_row"))


def undealt(shards: DataFrame, n: int, name: str = "shard", index: str = "row_index") -> DataFrame:
    """The positions that rows had before deal()."""
    return shards.withColumn(index, F.col(f"{name}_row") * n + F.col(name)).drop(name, f"{name}_row")


def shard_findings(shards: DataFrame, expected: int, n: int, name: str = "shard") -> DataFrame:
    """What is wrong with the shards of a table of `expected` rows, one row a finding: shard,
    rule (row_count or row_order), found and wanted. Shard i of n has every n-th row, numbered
    from 0 without gaps or repeats; a shard without rows is found too."""
    ids = shards.sparkSession.range(n).select(F.col("id").cast("int").alias(name))
    seen = shards.groupBy(name).agg(F.count("*").alias("rows"), F.countDistinct(f"{name}_row").alias("distinct"), F.min(f"{name}_row").alias("lo"), F.max(f"{name}_row").alias("hi"))
    both = ids.join(seen, name, "left").withColumn("wanted", F.floor((F.lit(expected) - F.col(name) + n - 1) / n)).na.fill({"rows": 0, "distinct": 0})
    count = both.where("rows <> wanted").select(name, F.lit("row_count").alias("rule"), F.col("rows").alias("found"), "wanted")
    order = both.where("rows > 0 and (distinct <> rows or lo <> 0 or hi <> rows - 1)").select(name, F.lit("row_order").alias("rule"), (F.col("hi") - F.col("lo") + 1).alias("found"), F.col("rows").alias("wanted"))
    return count.unionAll(order)


def every_nth(df: DataFrame, parts: int, *order: Column) -> DataFrame:
    """W11 for a whole table: of n rows in the given order every floor(n / parts)-th, from the first (every one, if n < parts)."""
    at = global_index(df, *order, name="_at")
    step = at.agg(F.greatest(F.lit(1), F.floor(F.count("*") / parts)).alias("_step"))
    return at.crossJoin(F.broadcast(step)).where(F.col("_at") % F.col("_step") == 0).select(*df.columns)
