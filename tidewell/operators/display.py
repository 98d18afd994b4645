"""Figures for display: nearest points, ranges, ticks and number texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nearest(points: DataFrame, pointers: DataFrame, key: str, cutoff: float = 1000.0) -> DataFrame:
    """For each pointer (key, px, py) the nearest of its key's points (key, id, x, y) by squared
    distance, of equally near ones the smallest id; null where none is within the cutoff. A join
    by key and one aggregate."""
    both = pointers.select(key, "px", "py").join(points.select(key, "id", "x", "y"), key, "left")
    far = (F.col("x") - F.col("px")) ** 2 + (F.col("y") - F.col("py")) ** 2
    best = both.groupBy(key, "px", "py").agg(F.min(F.when(far <= cutoff, F.struct(far.alias("distance"), F.col("id")))).alias("best"))
    return best.select(key, "px", "py", F.col("best.id").alias("id"), F.col("best.distance").alias("distance"))


def finite_range(low: Column, high: Column) -> Column:
    """struct of low and high: 0 and 1 where one isn't finite; widened by the value itself (1, for 0) where both are the same."""
    bad = low.isNull() | high.isNull() | F.isnan(low) | F.isnan(high) | (F.abs(low) == float("inf")) | (F.abs(high) == float("inf"))
    pad = F.when(low == high, F.when(high == 0, 1.0).otherwise(F.abs(high))).otherwise(0.0)
    return F.struct(F.when(bad, 0.0).otherwise(low - pad).alias("low"), F.when(bad, 1.0).otherwise(high + pad).alias("high"))


def ticks(low: Column, high: Column, count: int = 5) -> Column:
    """count values from low to high at equal distances; low alone for a count up to 1 and for an empty range."""
    if count <= 1:
        return F.array(low)
    every = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: low + (high - low) / (count - 1) * i)
    return F.when(high == low, F.array(low)).otherwise(every)


#: The units of large numbers, from the largest on.
_UNITS = ((1e12, "LCr"), (1e10, "KCr"), (1e7, "Cr"))


def number_text(value: Column, decimals: int = 2, compact: bool = True) -> Column:
    """a number with commas after the last three digits and every two before them; with
    compact, 10,000,000 and more in units with one decimal; N/A where it isn't finite."""

    def plain(x: Column, places: int) -> Column:
        text = F.format_string(f"%.{places}f", F.round(F.abs(x), places))
        whole = F.regexp_replace(F.substring_index(text, ".", 1), r"(\d)(?=(\d\d)+\d$)", "$1,")
        rest = F.regexp_replace(F.substring_index(text, ".", -1), "0+$", "") if places else F.lit("")
        sign = F.when(F.round(x, places) < 0, "-").otherwise("")
        return F.concat(sign, whole, F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""))

    out = plain(value, decimals)
    if compact:
        for size, unit in reversed(_UNITS):
            out = F.when(F.abs(value) >= size, F.concat(plain(value / size, 1), F.lit(unit))).otherwise(out)
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(bad, "N/A").otherwise(out)
