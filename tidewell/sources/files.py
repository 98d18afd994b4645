"""Text tables and workbooks read on executors, each file by its own rules.

A folder's files may differ in encoding, separator and columns. A first pass reads what each file
calls its columns; only the distinct lists of names come to the driver. A second pass reads the
rows, file by file and batch by batch, into the union of all columns. Files' bytes stay on the
executors; a file is read by one task and has to fit into it.
"""

from __future__ import annotations

import csv as _csv
import io as _io
import re
import zipfile
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import missing
from ..functions.names import header

#: Rows of an Arrow batch.
BATCH = 4096
#: Marks at a file's beginning that name its encoding; else the encodings that are tried, in this order.
MARKS = ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16"))
ENCODINGS = ("utf-8", "cp1252", "latin-1")


def decoded(data: bytes) -> tuple[str, str]:
    """A file's text and its encoding: by its mark, or the first that the whole file is valid in."""
    for mark, name in MARKS:
        if data.startswith(mark):
            try:
                return data.decode(name), name
            except UnicodeDecodeError:
                break
    for name in ENCODINGS:
        try:
            return data.decode(name), name
        except UnicodeDecodeError:
            continue
    raise AssertionError("latin-1 reads any bytes")


def text_rows(data: bytes, sep: str = ",") -> Iterator[list[str]]:
    """The rows of a text table, header first, without blank ones; quoted cells may hold
    separators, quotes (doubled) and line ends. A comma-separated table of one column whose header has tabs is a tab-separated one."""
    text, _ = decoded(data)
    first = text.split("\n", 1)[0]
    if sep == "," and "\t" in first and len(next(_csv.reader([first]), [])) <= 1:
        sep = "\t"
    old = _csv.field_size_limit(max(len(text), 1 << 17))
    try:
        yield from (row for row in _csv.reader(_io.StringIO(text, newline=""), delimiter=sep) if any(c.strip() for c in row))
    finally:
        _csv.field_size_limit(old)


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _place(ref: str) -> int:
    """0 for column A."""
    n = 0
    for ch in re.match(r"[A-Z]*", ref).group():
        n = 26 * n + ord(ch) - 64
    return n - 1


def _dated(book: zipfile.ZipFile) -> set[int]:
    """The cell styles of a workbook that show a number as a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")): re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "")) for f in root.iter(f"{_MAIN}numFmt")}
    known = {*range(14, 23), *range(45, 48), *(i for i, code in own.items() if re.search(r"[dmyhs]", code, re.IGNORECASE))}
    formats = root.find(f"{_MAIN}cellXfs")
    return {i for i, x in enumerate(formats if formats is not None else []) if int(x.get("numFmtId", 0)) in known}


def workbook_rows(data: bytes) -> Iterator[list[str]]:
    """The rows of a workbook's first sheet as text, header first, without blank ones. Shared, inline
    and formula texts; numbers as they are stored; days as yyyy-mm-dd hh:mm:ss; rows are read one by one."""
    book = zipfile.ZipFile(_io.BytesIO(data))
    names = set(book.namelist())
    shared = []
    if "xl/sharedStrings.xml" in names:
        shared = ["".join(t.text or "" for t in s.iter(f"{_MAIN}t")) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
    sheet = "xl/worksheets/sheet1.xml"
    if "xl/workbook.xml" in names and "xl/_rels/workbook.xml.rels" in names:
        first = next(ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"), None)
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        if first is not None and targets.get(first.get(f"{_REL}id")):
            target = targets[first.get(f"{_REL}id")]
            sheet = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    dated = _dated(book)

    def value(c) -> str:
        kind, v = c.get("t", "n"), c.findtext(f"{_MAIN}v")
        if kind == "inlineStr":
            return "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
        if v is None:
            return ""
        if kind == "s":
            return shared[int(v)]
        if kind == "b":
            return "True" if v == "1" else "False"
        if kind == "n" and int(c.get("s", 0)) in dated:
            return (datetime(1899, 12, 30) + timedelta(seconds=round(float(v) * 86400))).strftime("%Y-%m-%d %H:%M:%S")
        return v

    with book.open(sheet) as f:
        for _, row in ElementTree.iterparse(f):
            if row.tag == f"{_MAIN}row":
                cells: list[str] = []
                for i, c in enumerate(row.iter(f"{_MAIN}c")):
                    at = _place(c.get("r", "")) if c.get("r") else i
                    cells += [""] * (at - len(cells)) + [value(c)]
                if any(x.strip() for x in cells):
                    yield cells
                row.clear()


def _names(row: list[str]) -> list[str]:
    """A header row's names in normal form; empty ones by their place, clashes with _2, _3, ..."""
    seen: dict[str, int] = {}
    out = []
    for i, name in enumerate(row):
        name = header(name.lstrip("\ufeff")) or f"column_{i + 1}"
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out


def read(spark: SparkSession, path: str, rows: Callable[[bytes], Iterator[list[str]]], with_path: str | None = None) -> DataFrame:
    """The rows of all files of a path or pattern, all text, missing-value marks as null.

    rows: (a file's bytes) -> its rows, header first. Columns are those of all files, in the order
    of the files' names and of their columns, null where a file lacks one. Cells beyond a file's
    header are left out; a file without rows has none. with_path: a further column for the file's
    path. An error in a file is an error of the read that names the file.
    """
    found = spark.read.format("binaryFile").load(path).select("path", "content")

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                names = _names(next(_rows(at, data.as_py(), rows), []))
                yield pa.RecordBatch.from_pydict({"path": [at], "names": pa.array([names], pa.list_(pa.string()))})

    lists = found.mapInArrow(named, "path string, names array<string>").groupBy("names").agg(F.min("path").alias("path")).orderBy("path").collect()
    columns = list(dict.fromkeys(n for r in lists for n in r.names))
    out_columns = [*columns, *([with_path] if with_path else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                lines = _rows(at, data.as_py(), rows)
                own = _names(next(lines, []))
                held: list[list[str]] = []

                def table(held: list[list[str]], own: list[str] = own, at: str = at) -> pa.RecordBatch:
                    cells = {n: pa.array([r[i] if i < len(r) else None for r in held], pa.string()) for i, n in enumerate(own)}
                    if with_path:
                        cells[with_path] = pa.array([at] * len(held), pa.string())
                    return pa.RecordBatch.from_pydict({n: cells[n] if n in cells else pa.nulls(len(held), pa.string()) for n in out_columns})

                for line in lines:
                    held.append(line)
                    if len(held) == BATCH:
                        yield table(held)
                        held = []
                if held:
                    yield table(held)

    if not columns:
        return spark.createDataFrame([], ", ".join(f"`{n}` string" for n in out_columns) or "column_1 string")
    schema = ", ".join(f"`{n}` string" for n in out_columns)
    return found.mapInArrow(run, schema).select(*[missing(F.col(f"`{n}`")).alias(n) if n in columns else F.col(f"`{n}`") for n in out_columns])


def _rows(path: str, data: bytes, rows: Callable[[bytes], Iterator[list[str]]]) -> Iterator[list[str]]:
    try:
        yield from rows(data)
    except Exception as e:
        raise ValueError(f"{path}: {e}") from e


def text_tables(spark: SparkSession, path: str, sep: str = ",", with_path: str | None = None) -> DataFrame:
    """The text tables of a path or pattern in one read, whatever each file's encoding, separator and columns."""
    return read(spark, path, lambda data: text_rows(data, sep), with_path)


def workbooks(spark: SparkSession, path: str, with_path: str | None = None) -> DataFrame:
    """The first sheets of the workbooks (xlsx) of a path or pattern in one read."""
    return read(spark, path, workbook_rows, with_path)
