"""Wide, long, nested and generated shapes."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def to_long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], source: str | None = None) -> DataFrame:
    """One row for each value; metric names get the source in front. One scan, no union."""
    names = [F.col(f"`{c}`").cast("double").alias(c) for c in cols]
    out = df.select(*ids, *names).unpivot(list(ids), list(cols), "metric", "value")
    return out.withColumn("metric", F.concat_ws(".", F.lit(source), "metric")) if source else out


def year_columns(df: DataFrame) -> list[str]:
    """Columns that are named by a year."""
    return [c for c in df.columns if re.fullmatch(r"\d{4}", c)]


def metric_passthrough(source: str, name: Column) -> Column:
    """Key of a table that is long already."""
    return F.concat_ws(".", F.lit(source), F.lower(F.regexp_replace(F.trim(name), " ", "_")))


def to_wide(df: DataFrame, ids: Sequence[str], name: str, value: str, names: Sequence[str], how=F.avg) -> DataFrame:
    """One column for each of the given names, so that no job is needed to find them."""
    return df.groupBy(*ids).agg(*[how(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names])


def canonical(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Exactly these columns, with these types; missing ones and cells that don't fit are null."""
    return df.select(*[(F.col(f"`{c}`").try_cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in schema.items()])


def series(df: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Each key's points as an array of structs, by x."""
    return df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(x).alias("x"), F.col(y).alias("y")))).alias("points"))


def zip_explode(df: DataFrame, keys: Sequence[str], **arrays: str) -> DataFrame:
    """Arrays side by side, a row for each index."""
    zipped = F.arrays_zip(*[F.col(c).alias(n) for n, c in arrays.items()])
    return df.select(*keys, F.posexplode(zipped).alias("i", "z")).select(*keys, "i", *[F.col("z").getField(n).alias(n) for n in arrays])


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """A row for each line, with its 0-based number."""
    return df.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def chunks(df: DataFrame, key: str, order: str, text: str, starts: Column, sep: str = " ") -> DataFrame:
    """Rows up to the next start are one chunk; what stands before the first start is chunk 0."""
    w = Window.partitionBy(key).orderBy(order)
    numbered = df.withColumn("chunk", F.sum(F.coalesce(starts, F.lit(False)).cast("int")).over(w).cast("bigint"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(F.col(text), F.lit("")).alias("t")))), lambda s: s["t"])
    return numbered.groupBy(key, "chunk").agg(F.array_join(parts, sep).alias("text"), F.count("*").alias("n_rows"))


def between_markers(df: DataFrame, key: str, order: str, start: Column, end: Column) -> DataFrame:
    """Rows from the last start up to, without, the first end after it."""
    last = df.groupBy(key).agg(F.max(F.when(start, F.col(order))).alias("_from"))
    marked = df.join(last, key).where(F.col(order) >= F.col("_from"))
    stop = marked.where(F.col(order) > F.col("_from")).groupBy(key).agg(F.min(F.when(end, F.col(order))).alias("_to"))
    return marked.join(stop, key, "left").where(F.col("_to").isNull() | (F.col(order) < F.col("_to"))).drop("_from", "_to")
