"""Token ids as ORC tables (operator 8).

Files hold rows in ascending key order, one range of keys a file. Integer columns are
run-length encoded by ORC, each stripe has a row index, and the key column a Bloom filter, so a
reader takes stripes in parallel and skips those whose statistics or filter exclude a key.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._bpe import encoder
from ._shared import in_key_order, small_batches
from .bpe import slices


def write_tokens(docs: DataFrame, out: str, path: str, text: str = "text", key: str = "doc_id", end_id: int | None = 1, stripe_bytes: int = 64 << 20, index_rows: int = 1000) -> None:
    """Encodes every whole text, appends end_id, and writes part, row, key, n_tokens, ids to ORC files in out.

    part numbers the key ranges in ascending order and row the documents of a range, so
    (part, row) is the table's order. Texts, not ids, are shuffled, once. Null text counts as
    empty. Null keys come first; rows that repeat a key stand in the order of their texts. An
    empty table writes an empty table.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, row = encoder(path), TaskContext.get().partitionId(), 0
        end = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in slices(batches):
            flat, counts = enc.encode(batch.column(1).to_pylist())
            if len(end):
                flat = np.insert(flat, np.cumsum(counts), end[0])
                counts = counts + 1
            n = batch.num_rows
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(np.full(n, part, np.int32)),
                    "row": pa.array(np.arange(row, row + n), pa.int64()),
                    key: batch.column(0),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids": pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(flat.astype(np.int32))),
                }
            )
            row += n

    kind = docs.schema[key].dataType.simpleString()
    (
        in_key_order(docs, key, text)
        .mapInArrow(run, f"part int, row bigint, `{key}` {kind}, n_tokens bigint, ids array<int>")
        .write.option("orc.compress", "ZSTD")
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", index_rows)
        .option("orc.bloom.filter.columns", key)
        .option("orc.bloom.filter.fpp", 0.01)
        .mode("errorifexists")
        .orc(out)
    )


def read_tokens(spark: SparkSession, out: str, key: str = "doc_id", kind: str = "bigint") -> DataFrame:
    """The table that write_tokens() wrote; a filter on the key skips stripes by statistics and Bloom filter."""
    return spark.read.schema(f"part int, row bigint, `{key}` {kind}, n_tokens bigint, ids array<int>").orc(out)


def token_digests(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """From the ids that a table holds: part, row, key, n_tokens, and ids_crc32 over them as unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            at = ids.offsets.to_numpy()
            flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict({"part": batch.column(0), "row": batch.column(1), key: batch.column(2), "n_tokens": pa.array(np.diff(at), pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    return tokens.select("part", "row", key, "ids").mapInArrow(run, f"part int, row bigint, `{key}` {tokens.schema[key].dataType.simpleString()}, n_tokens bigint, ids_crc32 bigint")


def with_starts(rows: DataFrame, tokens: DataFrame) -> DataFrame:
    """Adds start: how many ids stand before the row in the table's order.

    Sums run inside each part; the parts' totals, a row for each file range, are added up apart.
    """
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("row")) - F.col("n_tokens")
    return rows.withColumn("inside", inside).join(before, "part").withColumn("start", F.col("before") + F.col("inside")).drop("before", "inside", "part", "row")
