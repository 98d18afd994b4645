"""Scans and sinks."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import partial, reduce

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.coerce import missing
from ..functions.names import file_alias, normal_headers, with_missing

PROVENANCE = ("source_type", "source_id", "metric_category", "dataset_source")


def table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet scan; only the given columns are read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def as_view(spark: SparkSession, path: str) -> str:
    """Registers a file as a view; the view's name."""
    name = file_alias(path)
    spark.read.parquet(path).createOrReplaceTempView(name)
    return name


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str | None:
    """The first path that is there, in any store that Spark reads."""
    return next((p for p in paths if exists(spark, p)), None)


def safe(spark: SparkSession, query: Callable[[], DataFrame], schema: str, evaluate: bool = False) -> DataFrame:
    """The query, or an empty typed table if it can't be analysed (with evaluate: or run)."""
    try:
        df = query()
        if evaluate:
            df.write.format("noop").mode("overwrite").save()
        return df
    except AnalysisException:
        return spark.createDataFrame([], schema)
    except PySparkException:
        if not evaluate:
            raise
        return spark.createDataFrame([], schema)


#: Encodings that a text is tried in, in this order.
ENCODINGS = ("UTF-8", "windows-1252", "ISO-8859-1")
#: What windows-1252 has in the places of Latin-1's control characters; Spark reads only the latter.
_WINDOWS = {chr(b): bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def csv(spark: SparkSession, path: str, sep: str = ",", encoding: str | None = None) -> DataFrame:
    """All text, headers in normal form, missing-value marks as null.

    Without an encoding, each file is read by its own: see files.text_tables(). With one, by
    Spark's reader, also files that one task can't hold; a byte order mark goes, and a table of
    one column whose header has tabs is read again as tab-separated.
    """
    if encoding is None:
        return _files().text_tables(spark, path, sep)
    windows = encoding.lower() == "windows-1252"
    read = lambda s: spark.read.csv(path, header=True, sep=s, encoding="ISO-8859-1" if windows else encoding, multiLine=True, escape='"')
    df = read(sep)
    if sep == "," and len(df.columns) == 1 and "\t" in df.columns[0]:
        df = read("\t")
    if windows:
        table = str.maketrans(_WINDOWS)
        df = df.select(*[F.translate(F.col(f"`{c}`"), "".join(_WINDOWS), "".join(_WINDOWS.values())).alias(c.translate(table)) for c in df.columns])
    df = normal_headers(df.toDF(*[c.lstrip("\ufeff") for c in df.columns]))
    return df.select(*[missing(F.col(f"`{c}`")).alias(c) for c in df.columns])


def encoding_of(spark: SparkSession, path: str, sample: int = 1 << 16) -> str:
    """The first of ENCODINGS that the beginning of a file is valid in."""
    head = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, sample).alias("head")).first()
    data = bytes(head.head) if head else b""
    for name in ENCODINGS:
        try:
            data.decode({"windows-1252": "cp1252"}.get(name, name))
            return name
        except UnicodeDecodeError as e:
            if name == "UTF-8" and e.start >= len(data) - 3 and len(data) == sample:
                return name  # a character that the sample cuts
    return ENCODINGS[-1]


def manual(spark: SparkSession, root: str, source_id: str) -> DataFrame | None:
    """What lies in the drop folder for a source: its csv, json, parquet, xlsx and pdf
    files, <id>.ext before <id>_*.ext, all of them by name union; None without any. A pdf is one
    row of metadata: its name, size and checksum."""
    found: list[DataFrame] = []
    for pattern in (f"{root}/{source_id}.{{}}", f"{root}/{source_id}_*.{{}}"):
        for ext, read in READERS.items():
            if exists(spark, pattern.format(ext)):
                found.append(read(spark, pattern.format(ext)))
    return union_by_name(found) if found else None


def _pdf(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").cast("string").alias("size_bytes"), F.sha2("content", 256).alias("sha256"), F.lit("metadata_only").alias("status"))


def _files():
    from . import files

    return files


#: The readers by extension, in the order in which they are tried.
READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv": csv,
    "json": lambda spark, path: normal_headers(spark.read.json(path, multiLine=True)),
    "parquet": lambda spark, path: normal_headers(spark.read.parquet(path)),
    "xlsx": lambda spark, path: _files().workbooks(spark, path),
    "pdf": _pdf,
}


def payload_kind(content_type: Column, url: Column) -> Column:
    """How a payload is to be read: json by its content type; else by the URL's ending; csv for anything else."""
    ending = F.lower(F.regexp_extract(F.regexp_replace(F.coalesce(url, F.lit("")), r"[?#].*$", ""), r"(\.[A-Za-z0-9]+)$", 1))
    return F.when(F.lower(F.coalesce(content_type, F.lit(""))).contains("json") | (ending == ".json"), "json").when(ending.isin(".xls", ".xlsx"), "sheet").when(ending.isin(".txt", ".tsv"), "tsv").otherwise("csv")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON document's rows; a missing file has none."""
    return spark.read.schema(schema).option("multiLine", True).json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def placeholder(spark: SparkSession, source_id: str, status: str) -> DataFrame:
    """One status row for a source without input."""
    return spark.range(1).select(F.lit(source_id).alias("source_id"), F.lit(status).alias("status"), F.lit(0).cast("bigint").alias("row_count"))


def first_non_empty(readers: Sequence[Callable[[], DataFrame | None]]) -> DataFrame | None:
    """The first reader's table that has a row; a reader that can't read counts as empty."""
    for read in readers:
        try:
            df = read()
        except AnalysisException:
            continue
        if df is not None and not df.isEmpty():
            return df
    return None


def provenance(df: DataFrame, retrieved_at: str, **values: str) -> DataFrame:
    """Provenance columns where missing; retrieved_at always."""
    return with_missing(df, {**{k: values.get(k) for k in PROVENANCE}, "retrieved_at": retrieved_at}, overwrite=("retrieved_at",))


def union_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """All columns of all tables, null where a table lacks one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def write(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet, by partition columns; a table without columns is an error before anything is written."""
    if not df.columns:
        raise ValueError("a table needs columns; give an empty table its schema")
    df.write.mode(mode).partitionBy(*by).parquet(path)


def write_json(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "overwrite", text: bool = False) -> None:
    """A JSON document a line, nulls kept; with text, df's one column is the JSON itself."""
    if text:
        df.coalesce(1).write.mode(mode).text(path)
    else:
        df.write.mode(mode).option("ignoreNullFields", False).partitionBy(*by).json(path)


def snapshot(df: DataFrame, path: str, at: str) -> str:
    """A raw table as it was at a time, next to earlier ones; the folder."""
    out = f"{path}/raw_{at}"
    write(df, out, mode="errorifexists")
    return out


def merged(spark: SparkSession, path: str) -> DataFrame:
    """All files below a path, with the columns of all of them."""
    return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(path)


def rebased(path: Column, old_root: str, new_root: str) -> Column:
    """Paths below old_root as paths below new_root; others stay."""
    return F.when(path.startswith(old_root + "/"), F.concat(F.lit(new_root), F.substring(path, len(old_root) + 1, 1 << 20))).otherwise(path)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and SHA-256 of every file below a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))


class _Page(InputPartition):
    def __init__(self, first: int, end: int):
        self.first, self.end = first, end


#: Tasks that pages are dealt to at most; each has pages that follow each other.
PAGE_TASKS = 200


class _Pages(DataSourceReader):
    def __init__(self, options: dict):
        module, _, name = options["fetch"].rpartition(".")
        fetch, self.limit = getattr(__import__(module, fromlist=[name]), name), int(options["limit"])
        self.fetch = partial(fetch, options["endpoint"]) if "endpoint" in options else fetch
        bound = lambda key, default: math.inf if options.get(key) == "all" else int(options.get(key, default))
        self.most, self.last = bound("pages", 200), bound("last_offset", 200_000)
        self.total = int(options["total"]) if "total" in options else None

    def _full(self, page: int) -> bool:
        return len(list(self.fetch(page * self.limit, self.limit))) == self.limit

    def partitions(self) -> list[InputPartition]:
        allowed = self.last if self.last == math.inf else self.last // self.limit + 1
        if self.total is None:  # a page that isn't full is the last: found by doubling and halving, in few requests
            low, high, end = 0, 1, min(allowed, self.most) + 1
            while high < end and self._full(high - 1):
                low, high = high, 2 * high
            high = min(high, end)
            while low + 1 < high:
                mid = (low + high) // 2
                low, high = (mid, high) if self._full(mid - 1) else (low, mid)
            pages = min(low + 1, allowed)
        else:
            pages = min(-(-self.total // self.limit), allowed)
        if pages > self.most:
            raise ValueError(f"{pages} pages of {self.limit} rows; the option pages allows {self.most}")
        each = max(1, -(-pages // PAGE_TASKS))
        return [_Page(i, min(i + each, pages)) for i in range(0, pages, each)]

    def read(self, page: InputPartition) -> Iterator[tuple]:
        for i in range(page.first, page.end):
            for row in self.fetch(i * self.limit, self.limit):
                yield (row,)


class PagedSource(DataSource):
    """A paged endpoint, a task a page, or of more than PAGE_TASKS pages several. Options: fetch (an importable function (offset, limit)
    -> JSON texts, or with the option endpoint, (endpoint, offset, limit)), limit, and total where it is known; without it, pages are read until one isn't
    full. Offsets go up to last_offset (200,000, included); more than `pages` pages (200) are an error. Either may be "all": no bound."""

    @classmethod
    def name(cls) -> str:
        return "tidewell_pages"

    def schema(self) -> str:
        return "record string"

    def reader(self, schema) -> DataSourceReader:
        return _Pages(self.options)


def stored_page(endpoint: str, offset: int, limit: int) -> list[str]:
    """A page of an endpoint that is a folder: the lines of page=<number>/, none where there is no such page."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(endpoint) if "://" in endpoint or endpoint.startswith("file:") else (fs.LocalFileSystem(), endpoint)
    lines: list[str] = []
    for info in store.get_file_info(fs.FileSelector(f"{root}/page={offset // limit}", allow_not_found=True)):
        if not info.base_name.startswith(("_", ".")):
            with store.open_input_stream(info.path) as f:
                lines += f.read().decode().splitlines()
    return lines


def scratch_dir(spark: SparkSession) -> str:
    """A folder that driver and executors share: spark.checkpoint.dir. Where that is unset, one in the
    warehouse, if all machines see it: on a cluster, a warehouse in a local folder is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local") and (warehouse.startswith(("file:", "/")) or "://" not in warehouse):
        raise ValueError("spark.checkpoint.dir is unset, and the warehouse is a local folder: set it to a folder that driver and executors share")
    return warehouse + "/tidewell-scratch"
