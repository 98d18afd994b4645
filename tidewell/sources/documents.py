"""JSON documents as sinks (K02, K04, K10, K11): many tasks write, the driver publishes all or nothing.

A document is a folder of parts and a manifest. Each task writes one part under a name that no
reader looks at; when all have ended, the driver names the parts in the manifest, which appears
at once by a rename. Readers begin at the manifest, so they see the document before or after a
write and never half of it. A write that fails leaves no part behind.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from . import io

MANIFEST, FORMAT = "_manifest.json", "tidewell_document"
#: Bytes of a document that may be put together into one file by the driver.
SINGLE_BYTES = 64 << 20


def _store(path: str):
    """File system and path: pyarrow's for a URI with a scheme, else the local or mounted one."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


@dataclass
class _Part(WriterCommitMessage):
    name: str
    rows: int
    size: int
    sha256: str


class _Document(DataSourceWriter):
    """Options: path; head, the document's other fields as a JSON object; field, the name of its rows."""

    def __init__(self, options: dict):
        self.path, self.head, self.field = options["path"].rstrip("/"), json.loads(options.get("head", "{}")), options.get("field", "datasets")
        if self.field in self.head:
            raise ValueError(f"{self.field} is the field of the rows")
        self.run = uuid.uuid4().hex

    def write(self, rows: Iterator) -> _Part:
        store, path = _store(self.path)
        store.create_dir(path, recursive=True)
        name = f"part-{self.run}-{uuid.uuid4().hex}.json"
        digest, n, size = hashlib.sha256(), 0, 0
        try:
            with store.open_output_stream(f"{path}/_{name}") as out:
                for row in rows:
                    line = (row[0] + "\n").encode()
                    out.write(line)
                    digest.update(line)
                    n, size = n + 1, size + len(line)
        except BaseException:  # also of a task that is stopped: its part goes with it
            store.delete_file(f"{path}/_{name}")
            raise
        return _Part(name, n, size, digest.hexdigest())

    def commit(self, messages: list) -> None:
        """Gives the parts of tasks that count their names, then replaces the manifest, then drops what the old one named and what failed attempts left."""
        store, path = _store(self.path)
        parts = [m for m in messages if m is not None]
        for m in parts:
            store.move(f"{path}/_{m.name}", f"{path}/{m.name}")
        manifest = {**self.head, "rows": self.field, "row_count": sum(m.rows for m in parts), "parts": [vars(m) for m in parts]}
        with store.open_output_stream(f"{path}/_{self.run}.manifest") as out:
            out.write(json.dumps(manifest).encode())
        store.move(f"{path}/_{self.run}.manifest", f"{path}/{MANIFEST}")
        self._clean(keep={m.name for m in parts})

    def abort(self, messages: list) -> None:
        """Drops everything that this write has made; the document stays as it was. Tasks that are being
        stopped are waited for a little; a part that one still leaves has a name that no reader looks
        at, and goes with the next commit."""
        quiet = 0
        for _ in range(20):
            quiet = 0 if self._clean(keep=None) else quiet + 1
            if quiet == 4:
                break
            time.sleep(0.25)

    def _clean(self, keep: set[str] | None) -> int:
        """Drops this run's files, or, given the names that count, all other parts; how many there were."""
        from pyarrow import fs

        store, path = _store(self.path)
        dropped = 0
        for info in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            own, part = self.run in info.base_name, info.base_name.lstrip("_").startswith("part-")
            if own and keep is None or keep is not None and (own or part) and info.base_name not in keep:
                try:
                    store.delete_file(info.path)
                except FileNotFoundError:  # its task was quicker
                    continue
                dropped += 1
        return dropped


class DocumentSink(DataSource):
    """The sink of format `tidewell_document`; a row is one JSON text."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Document(self.options)


def write(df: DataFrame, path: str, field: str = "datasets", **head: str) -> None:
    """df's rows (nulls kept) as the field of a document with further fields, in
    place of the document that is there. Every task writes its own part; nothing but the parts'
    names, sizes and checksums comes to the driver."""
    spark = df.sparkSession
    spark.dataSource.register(DocumentSink)
    rows = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    # the mode of Spark's own protocol: the writer replaces the document when it commits
    rows.write.format(FORMAT).options(path=path, head=json.dumps(head), field=field).mode("append").save()


def manifest(spark: SparkSession, path: str) -> dict:
    """What the manifest of a document says; an error if there is no document."""
    store, at = _store(path.rstrip("/"))
    with store.open_input_stream(f"{at}/{MANIFEST}") as f:
        return json.loads(f.read())


def read(spark: SparkSession, path: str, schema: str, verify: bool = False) -> DataFrame:
    """The rows of a document (schema: DDL), each with the parts that the manifest names at this
    moment. verify: an error if a part isn't there as it was written, found by a scan of the parts' bytes."""
    known = manifest(spark, path)
    paths = [f"{path.rstrip('/')}/{p['name']}" for p in known["parts"] if p["rows"]]
    if not paths:
        return spark.createDataFrame([], schema)
    if verify:
        found = {os.path.basename(r.path): r.sha256 for r in spark.read.format("binaryFile").load(paths).select("path", F.sha2("content", 256).alias("sha256")).toLocalIterator()}
        wrong = [p["name"] for p in known["parts"] if p["rows"] and found.get(p["name"]) != p["sha256"]]
        if wrong:
            raise ValueError(f"{path}: parts that differ from the manifest: {', '.join(wrong)}")
    return spark.read.schema(schema).json(paths)


def single(spark: SparkSession, path: str, out: str, most: int = SINGLE_BYTES) -> None:
    """A document as one JSON file, which appears at once; only for documents of at most
    `most` bytes, as the driver puts the parts together."""
    known = manifest(spark, path)
    size = sum(p["size"] for p in known["parts"])
    if size > most:
        raise ValueError(f"{path} has {size} bytes; one file may have {most}")
    store, at = _store(path.rstrip("/"))
    rows: list[str] = []
    for p in known["parts"]:
        with store.open_input_stream(f"{at}/{p['name']}") as f:
            rows += f.read().decode().split("\n")[:-1]
    head = {k: v for k, v in known.items() if k not in ("rows", "row_count", "parts")}
    text = json.dumps(head)[:-1] + (", " if head else "") + json.dumps(known["rows"]) + ": [" + ", ".join(rows) + "]}"
    target, to = _store(out)
    target.create_dir(os.path.dirname(to), recursive=True)
    aside = f"{to}.{uuid.uuid4().hex}"
    with target.open_output_stream(aside) as f:
        f.write(text.encode())
    target.move(aside, to)
