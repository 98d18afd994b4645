"""Rows from text."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import let, normal_url, resolved

NUMBER = r"-?\d+(?:,\d{3})*(?:\.\d+)?"  # T14
#: Whole lines that say nothing, next to page numbers and addresses.
RUNNING_TITLES = ("national highways authority of india", "annual report", "annual report of nhai", "content", "contents")
#: The forms of a numbered line with a value, and of a label with a value.
NUMBERED = r"^\s*(\d+\.?)\s+(.+?)\s{2,}(\d+[\d,]*\.?\d*)\s*$"
LABELLED = r"(?i)([\p{L}\p{N}_/().,%&+\s-]{3,220})[:–—-]\s*(-?(?:Rs\.?|₹|INR)?\s*[\d,]+(?:\.\d+)?(?:\s*(?:crore|crores|lakh|lakhs|million|billion|bn|%|nos?|No\.?|N\.A\.?))?)"

#: The end of a label and the beginning of its value, which every labelled value has.
VALUE_AHEAD = r"(?i)[\p{L}\p{N}_/().,%&+\s-]{3}[:–—-]\s*-?(?:Rs\.?|₹|INR)?\s*[\d,]"


def stripped(c: Column) -> Column:
    """White space off both ends; null is empty."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", "")


def is_noise(line: Column) -> Column:
    """Fewer than 4 characters, nothing but a page number, digits, an address or a running
    title, no letter or digit, or six bars or more without a letter."""
    return let(F.regexp_replace(stripped(line), r"\s{2,}", " "), _says_nothing)


def _says_nothing(t: Column) -> Column:
    bars = F.length(t) - F.length(F.replace(t, F.lit("|"), F.lit("")))
    said = t.rlike(r"(?i)^(page\s+\d+|\d+|https?://\S+|www\.\S+)$") | F.lower(t).isin(*RUNNING_TITLES)
    return (F.length(t) < 4) | said | ~t.rlike(r"[\p{L}\p{N}]") | ((bars >= 6) & ~t.rlike(r"\p{L}"))


def has_table_signal(text: Column, head: int = 80, least: int = 3) -> Column:
    """Of the first lines that aren't blank, at least `least` look tabular: two numbers, a wide
    gap and three words, or three cells between bars."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|\n|\r"), stripped), lambda x: x != "")
    cells = lambda x: F.size(F.filter(F.split(x, r"\|"), lambda p: stripped(p) != ""))
    tabular = lambda x: (F.regexp_count(x, F.lit(NUMBER)) >= 2) | (x.rlike(r"\s{2,}") & (F.size(F.split(x, r"\s+")) >= 3)) | (x.contains("|") & (cells(x) >= 3))
    return F.size(F.filter(F.slice(lines, 1, head), tabular)) >= least


def without_prefixes(lines: Column, markers: list[str]) -> Column:
    """Lines that begin with none of the markers."""
    return F.filter(lines, lambda x: ~F.exists(F.array(*map(F.lit, markers)), lambda m: x.startswith(m)))


def amount_of(c: Column) -> Column:
    """F15 on a matched value: commas, brackets, currency and unit off, as a double."""
    return F.regexp_replace(F.regexp_extract(c, r"(-?\s*[\d,]+(?:\.\d+)?)", 1), r"[,\s]", "").try_cast("double")


def line_value(line: Column) -> Column:
    """struct of kind (numbered, or labelled), label, value_text and value of lines like
    `3. Bridges  1,234` and `label: Rs. 1,234.5 crore`; nulls where there is none, and for noise.
    Only lines with a digit or comma, and a dash, colon or wide gap, are looked at closely."""

    def of(t: Column) -> Column:
        numbered = F.when(t.rlike(r"^\d"), F.struct(F.regexp_extract(t, NUMBERED, 2).alias("label"), F.regexp_extract(t, NUMBERED, 3).alias("text")))
        # a label has 220 characters at most: nothing before the first end of one needs to be tried
        near = let(F.regexp_instr(t, F.lit(VALUE_AHEAD)), lambda at: F.when(at > 0, F.substring(t, F.greatest(F.lit(1), at - 217), F.lit(1 << 30))))
        labelled = let(near, lambda n: F.struct(F.regexp_replace(stripped(F.regexp_extract(n, LABELLED, 1)), r"\s{2,}", " ").alias("label"), stripped(F.regexp_extract(n, LABELLED, 2)).alias("text")))
        # a numbered line is taken as such, whatever else it may look like
        row = lambda kind, x: F.struct(F.lit(kind).alias("kind"), F.substring(x["label"], 1, 220).alias("label"), x["text"].alias("value_text"), amount_of(x["text"]).alias("value"))
        other = let(labelled, lambda x: F.when(x["label"] != "", row("labelled", x)))
        return let(numbered, lambda x: F.when(F.coalesce(x["label"], F.lit("")) == "", other).when(stripped(x["label"]) != "", row("numbered", F.struct(stripped(x["label"]).alias("label"), x["text"].alias("text")))))

    none = F.struct(*[F.lit(None).cast(kind).alias(name) for name, kind in (("kind", "string"), ("label", "string"), ("value_text", "string"), ("value", "double"))])
    return F.coalesce(let(stripped(line), lambda t: F.when(t.rlike(r"[\d,]") & t.rlike(r"[:–—-]|\s{2}") & ~is_noise(t), of(t))), none)


def key_values(df: DataFrame, line: str) -> DataFrame:
    """df with the columns of line_value() for the rows whose line has a value: each line is looked at once."""
    found = F.filter(F.array(line_value(F.col(line))), lambda x: x["label"].isNotNull())
    return df.withColumn("_kv", F.explode(found)).select(*df.columns, "_kv.*")


def key_value(line: Column) -> Column:
    """struct of label and value of line_value()."""
    x = line_value(line)
    return F.struct(x["label"].alias("label"), x["value"].alias("value"))


def numbers(text: Column) -> Column:
    """All numbers of a text, commas dropped, in order."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({NUMBER})"), F.lit(1)), lambda x: F.regexp_replace(x, ",", "").try_cast("double"))


def table_row(cells: Column) -> Column:
    """struct of name, text, value and col_no of a table's row: the value is the first number
    that a cell begins to show, the name the first cell; nulls for a row without text."""
    full = F.filter(cells, lambda x: F.coalesce(x, F.lit("")) != "")
    whole = F.array_join(full, " | ")
    shown = F.filter(F.transform(full, lambda x: F.regexp_extract(x, f"({NUMBER})", 1)), lambda x: x != "")
    first = F.regexp_replace(stripped(F.try_element_at(cells, F.lit(1))), r"\s{2,}", " ")
    some = F.size(shown) > 0
    name = F.when(some & (first != ""), F.substring(first, 1, 220)).otherwise("table_row")
    col_no = F.coalesce(F.array_position(F.transform(cells, lambda x: stripped(x) != ""), True), F.lit(0))
    there = F.coalesce(whole, F.lit("")) != ""
    fields = {"name": name, "text": F.when(F.size(shown) == 1, F.element_at(shown, 1)).otherwise(whole), "value": F.when(some, F.regexp_replace(F.try_element_at(shown, F.lit(1)), ",", "").try_cast("double")), "col_no": col_no.cast("int")}
    return F.struct(*[F.when(there, x).alias(n) for n, x in fields.items()])


def two_last_numbers(chunk: Column, renames: Mapping[str, str] | None = None) -> Column:
    """struct of label, first and second of a numbered row's text: the label before its first
    number, and its last two numbers; nulls for totals and rows with fewer than two numbers."""
    body = F.regexp_extract(F.coalesce(chunk, F.lit("")), r"^\d+\s+(.+)$", 1)
    found = numbers(F.regexp_replace(body, "-", " "))
    label = F.regexp_replace(F.regexp_replace(stripped(F.regexp_extract(body, r"^([^\d]*)", 1)), r"\s+", " "), "-$", "")
    named = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in renames.items() for x in kv]), label), label) if renames else label
    good = (F.size(found) >= 2) & (label != "") & ~F.lower(label).startswith("total")
    return F.struct(F.when(good, named).alias("label"), F.when(good, F.try_element_at(found, F.lit(-2))).alias("first"), F.when(good, F.try_element_at(found, F.lit(-1))).alias("second"))


def marked_row(line: Column, mark: str = "AG,") -> Column:
    """struct of label and value of lines like `AG, Label 1,234`; nulls otherwise."""
    p = rf"^{mark}\s*(.+?)\s+([\d,]+)$"
    t = F.regexp_replace(stripped(line), r"\s+", " ")
    value = F.regexp_replace(F.regexp_extract(t, p, 2), ",", "").try_cast("double")
    return F.struct(F.when(value.isNotNull(), F.regexp_extract(t, p, 1)).alias("label"), value.alias("value"))


def year_candidates(df: DataFrame, first: Column, last: Column, template: Column) -> DataFrame:
    """Df with one row for each fiscal year from first to last: label (2019-20) and url, the template
    in which {year} is the label. Rows without a first or last year, or with none between them, have no candidates."""
    years = F.when(first <= last, F.sequence(first, last))
    out = df.withColumn("_year", F.explode(years)).withColumn("label", F.format_string("%d-%02d", "_year", (F.col("_year") + 1) % 100))
    return out.withColumn("url", F.replace(template, F.lit("{year}"), F.col("label"))).drop("_year")


def text_urls(df: DataFrame, key: str, *columns: str, pattern: str = r"https?://[^\s\"'<>\\]+") -> DataFrame:
    """Key and url of every distinct URL in columns of any type, nested ones as their JSON, in order of first sight."""
    flat = F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]))
    found = F.array_distinct(F.regexp_extract_all(F.regexp_replace(flat, r"\\\\/", "/"), F.lit(f"({pattern})"), F.lit(1)))
    return df.select(key, F.posexplode(found).alias("pos", "url"))


def link_variants(url: Column, base: str) -> Column:
    """A link resolved against the page's address, followed by the variants under which sites also serve it:
    without www., and with /sites/default/files/ for /system/files/; without repeats."""
    absolute = resolved(F.lit(base), url)
    bare = F.when(absolute.startswith("https://www."), F.concat(F.lit("https://"), F.substring(absolute, 13, 1 << 20)))
    moved = F.when(absolute.contains("/system/files/") & ~absolute.contains("/sites/default/files/"), F.replace(absolute, F.lit("/system/files/"), F.lit("/sites/default/files/")))
    return F.array_distinct(F.array_compact(F.array(absolute, bare, moved)))


def links(df: DataFrame, key: str, html: str) -> DataFrame:
    """Href targets of a page, first seen first, without repeats."""
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(r"""(?i)href\s*=\s*["']([^"'\s>]+)"""), F.lit(1)))
    return df.select(key, F.posexplode(found).alias("pos", "url"))


def resolved_links(df: DataFrame, key: str, html: str, url: str) -> DataFrame:
    """The distinct targets of a page's links, resolved against the page's address (or its
    first <base href>, itself resolved) and in normal form, in order of first sight. Targets that
    aren't http(s) are left out, and so is the page itself."""
    own = F.regexp_extract(F.coalesce(F.col(html), F.lit("")), r"""(?i)<base\b[^>]*?\bhref\s*=\s*["']([^"'>]+)""", 1)
    pages = df.select(key, html, F.col(url).alias("_page"), F.when(own == "", F.col(url)).otherwise(resolved(F.col(url), own)).alias("_base"))
    bare = pages.withColumn(html, F.regexp_replace(html, r"(?i)<base\b[^>]*>", ""))
    found = links(bare, key, html).join(pages.select(key, "_page", "_base"), key)
    target = found.select(key, "pos", normal_url(F.col("_page")).alias("_page"), resolved(F.col("_base"), F.regexp_replace("url", "(?i)&amp;", "&")).alias("url")).withColumn("url", normal_url(F.col("url")))
    other = target.where(F.col("url").rlike("^https?://") & (F.col("url") != F.col("_page")))
    return other.groupBy(key, "url").agg(F.min("pos").alias("pos")).select(key, "pos", "url")


def json_records(payload: Column, schema: str) -> Column:
    """Rows of a payload that is a bare list or has them under records, data or result."""
    array = f"array<struct<{schema}>>"
    under = [F.from_json(payload, f"{k} {array}")[k] for k in ("records", "data", "result")]
    return F.coalesce(F.when(F.trim(payload).startswith("["), F.from_json(payload, array)), *under)


def merged_json(trace: Column, **more: Column) -> Column:
    """a JSON object of strings with keys added or replaced, keys sorted."""
    old = F.coalesce(F.from_json(trace, "map<string,string>"), F.create_map().cast("map<string,string>"))
    names = F.array(*map(F.lit, more))
    new = F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(names, k)), F.create_map(*[x for k, v in more.items() for x in (F.lit(k), v.cast("string"))]))
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(new))))


def is_pdf(content: Column) -> Column:
    """the payload's first bytes."""
    return F.substring(content, 1, 5) == F.lit(b"%PDF-")


def per_document(df: DataFrame, key: str, text: str, parse: Callable[[str], list[dict]], fields: str) -> DataFrame:
    """1 document to n rows by a Python parser; a document that fails gives one error row.

    fields: the parser's columns as DDL. Batches stream through; documents don't depend on each other.
    """
    names = [f.split()[0] for f in fields.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, t in zip(batch[key], batch[text], strict=True):
                try:
                    out += [{key: k, **{n: r.get(n) for n in names}, "error": None} for r in parse(t or "")]
                except Exception as e:  # noqa: BLE001  the error is the row
                    out.append({key: k, **dict.fromkeys(names), "error": f"{type(e).__name__}: {e}"})
                if len(out) >= 10_000:
                    yield pd.DataFrame(out, columns=[key, *names, "error"])
                    out = []
            yield pd.DataFrame(out, columns=[key, *names, "error"])

    return df.select(key, text).mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, {fields}, error string")
