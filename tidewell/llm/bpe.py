"""Byte-level BPE encoding and decoding by forced boundaries (operator 10)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._arrays import release
from ._bpe import encoder
from ._shared import small_batches


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, and about so many bytes, whatever the session's Arrow batch
    size is. Freed memory goes back to the system after each of the given batches."""
    for batch in batches:
        step = max(1, min(rows, batch.num_rows * size // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
        del batch
        release()


def encode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", ids: bool = True, digests: bool = True) -> DataFrame:
    """Token ids of every whole text: key, n_tokens, and ids (array<int>) and the digests of ids and of the decoded text.

    Each pre-token is cut wherever two bytes meet that are adjacent inside no vocabulary token;
    no merge crosses such a cut, so the fragments' ids, one after the other, are the library's.
    Null text counts as empty: no ids. Special tokens that stand in a text are one id, as in the
    library. Rows are independent: repeated keys, null keys and ties stay as they are; further
    columns of docs are not read. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, cut=True)
        for batch in slices(batches):
            flat, counts = enc.encode(batch.column(1).to_pylist())
            parts = np.split(flat, np.cumsum(counts)[:-1]) if len(counts) else []
            out = {key: batch.column(0), "n_tokens": pa.array(counts, pa.int64())}
            if ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(flat.astype(np.int32)))
            if digests:
                out["ids_sha256"] = pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in parts], pa.string())
                out["decoded_sha256"] = pa.array([hashlib.sha256(enc.decode(x).encode()).hexdigest() for x in parts], pa.string())
            yield pa.RecordBatch.from_pydict(out)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens bigint" + ", ids array<int>" * ids + ", ids_sha256 string, decoded_sha256 string" * digests
    return docs.select(key, text).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """Texts of arrays of token ids: key, text. Null ids give null; ids outside the vocabulary give nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, cut=True)
        for batch in slices(batches):
            rows = [None if x is None else np.array([i for i in x if i is not None and 0 <= i < len(enc.byte_at)], np.int64) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({key: batch.column(0), "text": pa.array([None if x is None else enc.decode(x) for x in rows], pa.string())})

    return encoded.select(key, ids).mapInArrow(run, f"`{key}` {encoded.schema[key].dataType.simpleString()}, text string")
