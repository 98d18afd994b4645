"""Numbers from dirty cells (P06, P10, P11, P29, F01, F02, F14-F16, F31, F33, T2-T4). Nothing here raises on bad text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells that mean "missing".
NA = ("", "na", "n/a", "nan", "null", "none", "-")
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def missing(c: Column) -> Column:
    """The text, or null where it means nothing."""
    return F.when(~F.lower(F.trim(c)).isin(*NA), c)


def number(c: Column) -> Column:
    """A cell as a finite double, commas dropped; null if it is no number."""
    bare = F.regexp_replace(F.trim(c.cast("string")), ",", "")
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def finite(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def num0(c: Column, fallback: float = 0.0) -> Column:
    """null, NaN and infinity are the fallback."""
    return F.coalesce(finite(c.cast("double")), F.lit(fallback))


def first_truthy(*cols: Column) -> Column:
    """The first column that is neither null, NaN nor 0; else 0 (T4)."""
    return F.coalesce(*[F.nullif(finite(c.cast("double")), F.lit(0.0)) for c in cols], F.lit(0.0))


def clamp(c: Column, low: float, high: float) -> Column:
    """null and NaN are the lower end."""
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), F.coalesce(F.when(~F.isnan(c), c), F.lit(float(low)))))


def amount(c: Column) -> Column:
    """struct of value and unit of texts like 'Rs. 1,200 crore' (T11: the unit is recognised;
    numbers of things are a count). Of several numbers, the one before the unit; without a unit, the first."""
    text = F.lower(F.trim(c))
    ending = r"(crore|lakh|million|billion|bn|km|%|percent|nos?\.?|count|n\.a\.)s?\s*$"
    found = F.nullif(F.regexp_extract(text, ending, 1), F.lit(""))
    unit = F.when(found == "bn", "billion").when(found == "percent", "%").when(found.rlike(r"^(nos?\.?|count|n\.a\.)$"), "count").otherwise(found)
    digits = r"(-?\d[\d,]*\.?\d*)"
    before = F.regexp_extract(text, digits + r"[\s(]*" + ending, 1)
    return F.struct(number(F.when(before != "", before).otherwise(F.regexp_extract(text, digits, 1))).alias("value"), unit.alias("unit"))


def per(top: Column, bottom: Column, scale: float) -> Column:
    """A ratio, null unless the denominator is positive."""
    return F.when(bottom > 0, top * F.lit(scale) / bottom)


def numeric_columns(df: DataFrame, exclude: set[str] = frozenset()) -> list[str]:
    """P10: numeric columns, and text columns with a parsable value: one aggregate for all of them."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields if f.name not in exclude}
    text = [c for c, k in kinds.items() if k == "string"]
    some = df.agg(*[F.max(number(F.col(f"`{c}`")).isNotNull()).alias(str(i)) for i, c in enumerate(text)]).first() if text else ()
    good = {c for i, c in enumerate(text) if some[i]}
    return [c for c, k in kinds.items() if c in good or k in ("byte", "short", "integer", "long", "float", "double") or k.startswith("decimal")]


def coerce_mixed(df: DataFrame, share: float = 0.8) -> DataFrame:
    """Text columns of which at least this share of non-missing cells are numbers become doubles."""
    text = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    if not text:
        return df
    q = lambda c: F.col(f"`{c}`")
    shares = df.agg(*[F.avg(F.when(missing(q(c)).isNotNull(), number(q(c)).isNotNull().cast("double"))).alias(str(i)) for i, c in enumerate(text)]).first()
    return df.withColumns({c: number(q(c)) for i, c in enumerate(text) if (shares[i] or 0) >= share})
