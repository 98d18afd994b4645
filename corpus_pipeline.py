"""From raw documents to packed training sequences, in four written stages.

Toxic documents go, then low-quality ones, then all but one of each group of near copies (five
words a shingle, similarity 0.8 or more); what is left is packed. Each stage reads what the one
before it wrote. A filtering stage keeps all columns of documents, and learns from the labels of
the documents that it is given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import near_dup, packing, quality, toxicity
from tidewell.llm._shared import read_table, staged, unstage
from tidewell.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the factorization machine scores below 0.5."""
    return toxicity.accepted(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the quality classifier scores 0.3 or more."""
    return quality.accepted(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each component of near copies."""
    return near_dup.first_of_each(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of at most 2048 tokens: one row a piece, with its ids' checksum."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]

#: The classifiers and the tokenizer can't be expressed in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each written as Parquet in the shared folder and read again;
    what a stage has read is deleted when its result is written."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
            if before is not None:
                unstage(before)
            before = docs
    return docs
