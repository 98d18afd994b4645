"""Years, fiscal periods and dates from labels."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _part(c: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def year_number(c: Column) -> Column:
    """the first four digits in a row, as an int."""
    return _part(c.cast("string"), r"(\d{4})", 1).try_cast("int")


def period_label(c: Column) -> Column:
    """a label like 2019-20, else the year, else the text; `unknown` for null and empty."""
    t = F.trim(c.cast("string"))
    pair = lambda century: F.concat_ws("-", _part(t, rf"({century}\d{{2}})-(\d{{2}})", 1), _part(t, rf"({century}\d{{2}})-(\d{{2}})", 2))
    found = F.coalesce(F.nullif(pair("20"), F.lit("")), F.nullif(pair("19"), F.lit("")), _part(t, r"((?:19|20)\d{2})", 1), t)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit("unknown"))


def fiscal_start(c: Column) -> Column:
    """the year with which a period label begins, 0 if it begins with none."""
    return F.coalesce(_part(c, r"^((?:19|20)\d{2})", 1).try_cast("int"), F.lit(0))


def fiscal_label(c: Column) -> Column:
    """a label like 2019-20, else the year."""
    pair = r"\b(20\d{2})[-/–—](\d{2})\b"
    return F.coalesce(F.concat(_part(c, pair, 1), F.lit("-"), _part(c, pair, 2)), _part(c, r"\b((?:19|20)\d{2})\b", 1))


def date_value(c: Column) -> Column:
    """Y-M-D; Y-M (a month from 1 to 12 is its first day, else a fiscal year: 31 March of
    the following year, T10); a year, or the first in a text: its 31 December."""
    t = F.trim(c)
    day = F.try_to_date(_part(t, r"^(\d{4}-\d{1,2}-\d{1,2})", 1), "yyyy-M-d")
    year, month = _part(t, r"^(\d{4})-(\d{1,2})$", 1).try_cast("int"), _part(t, r"^(\d{4})-(\d{1,2})$", 2).try_cast("int")
    pair = F.when(month.between(1, 12), F.make_date(year, month, F.lit(1))).when(year.isNotNull(), F.make_date(year + 1, F.lit(3), F.lit(31)))
    any_year = year_number(t)
    return F.coalesce(day, pair, F.when(any_year.between(1, 9999), F.make_date(any_year, F.lit(12), F.lit(31))))


#: The forms of a date in a text, in the order in which they are tried.
_HINTS = ((r"\b(20\d{2}-\d{1,2}-\d{1,2})\b", "yyyy-M-d", ""), (r"\b((?:0[1-9]|[12]\d|3[01])[-/](?:0[1-9]|1[0-2])[-/]20\d{2})\b", "dd-MM-yyyy", ""), (r"\b((?:19|20)\d{2}[-/](?:0[1-9]|1[0-2]))\b", "yyyy-MM-dd", "-01"), (r"\b((?:19|20)\d{2})\b", "yyyy-MM-dd", "-01-01"))


def date_hint(*texts: Column) -> Column:
    """the date that the first of the texts to name one names: a day, a month's first day,
    or a year's first day. Slashes count as dashes."""
    found = [F.try_to_date(F.concat(F.translate(_part(t, p, 1), "/", "-"), F.lit(end)), form) for t in texts for p, form, end in _HINTS]
    return F.coalesce(*found)


def date_only(c: Column) -> Column:
    """a timestamp or a text that is one, as yyyy-MM-dd; empty where it is none."""
    return F.coalesce(F.date_format(F.try_to_timestamp(F.trim(c.cast("string"))), "yyyy-MM-dd"), F.lit(""))


#: What in a column's name says that it may hold dates.
_DATE_NAME = re.compile(r"date|time|timestamp|year|period|month|snapshot|as[_-]of|asof|effective|publication|release|quarter|fy|observ", re.IGNORECASE)


def date_columns(columns: Iterable[str]) -> list[str]:
    """the columns whose name says that they may hold dates, and those named label."""
    return [c for c in columns if _DATE_NAME.search(c) or c == "label"]


def latest(*texts: Column) -> Column:
    """The latest date among the texts of a row."""
    return F.array_max(F.array(*[date_value(t) for t in texts]))


def latest_date(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row, the latest date that a table's date columns name; null if none does."""
    names = date_columns(df.columns) if columns is None else list(columns)
    found = [date_value(F.col(f"`{c}`").cast("string")) for c in names]
    return df.agg(F.max(F.greatest(*found, F.lit(None).cast("date")) if found else F.lit(None).cast("date")).alias("latest"))


def latest_retrieved(catalog: DataFrame, source_ids: Iterable[str], retrieved: str = "retrieved_at") -> DataFrame:
    """The latest retrieval day of some sources of a catalog, empty if none has one."""
    day = F.max(F.nullif(date_only(F.col(retrieved)), F.lit("")))
    return catalog.where(F.col("source_id").isin(*source_ids)).agg(F.coalesce(day, F.lit("")).alias("latest"))
