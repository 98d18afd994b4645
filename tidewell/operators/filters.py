"""Filters that a caller's choice drives."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import num0
from ..functions.names import metric_name, spaced_key


def by_key(df: DataFrame, col: str, wanted: str | None) -> DataFrame:
    """Rows whose normalised key is the wanted one's; all rows for None, empty and `All`."""
    return df if wanted in (None, "", "All") else df.where(spaced_key(F.col(col)) == spaced_key(F.lit(wanted)))


def by_metric(df: DataFrame, names: Iterable[str] = (), prefix: str | None = None, metric: str = "metric_name", value: str = "metric_value") -> DataFrame:
    """Rows whose normalised metric name is one of names or begins with prefix (all, without either);
    the name is normalised, and the value a number, 0 where it is none."""
    out = df.withColumns({metric: metric_name(F.col(metric)), value: num0(F.col(value))})
    names = list(names)
    if names:
        out = out.where(F.col(metric).isin(*names))
    return out.where(F.col(metric).startswith(prefix)) if prefix else out


def split_provisional(df: DataFrame, status: str, mark: str = "provisional") -> tuple[DataFrame, DataFrame]:
    """Final rows (null status included) and provisional rows."""
    is_provisional = F.coalesce(F.lower(F.col(status)) == mark, F.lit(False))
    return df.where(~is_provisional), df.where(is_provisional)


def by_evidence(df: DataFrame, tag: Column, wanted: str = "all") -> DataFrame:
    """P20: rows of one evidence class, or all."""
    return df if wanted == "all" else df.where(tag == wanted)


def by_source(df: DataFrame, equals: Iterable[str] = (), contains: Iterable[str] = (), col: str = "source_id") -> DataFrame:
    """Rows whose source is one of equals, or holds one of contains; none without either."""
    test = F.lit(False)
    for x in equals:
        test = test | (F.col(col) == x)
    for x in contains:
        test = test | F.col(col).contains(x)
    return df.where(F.coalesce(test, F.lit(False)))


def matching(df: DataFrame, cols: Iterable[str], words: Iterable[str]) -> DataFrame:
    """Rows of which one of the columns holds one of the words, in any case; null holds nothing."""
    test = F.lit(False)
    for c in cols:
        for w in words:
            test = test | F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))).contains(w.lower())
    return df.where(test)
