"""Parsers as table functions of SQL.

A parser gives n rows for a document. As a table function it is called from SQL: for each row by a
lateral join, or for each group of rows of a table argument, partitioned and ordered by what the
function itself asks for. A document that a parser fails on gives one row with the error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn


def _schema(fields: str) -> StructType:
    schema = StructType.fromDDL(fields)
    if "error" in schema.names:
        raise ValueError("the column error is the function's own")
    return schema.add("error", StringType())


def _rows(parse: Callable, given, names: list[str]) -> Iterator[tuple]:
    """The parser's rows as they come; after those that it gave before it failed, the error's row."""
    try:
        for r in parse(given):
            yield (*(r.get(n) for n in names), None)
    except Exception as e:  # noqa: BLE001  the error is the row
        yield (*[None] * len(names), f"{type(e).__name__}: {e}")


def register(spark: SparkSession, name: str, parse: Callable[[str], list[dict]], fields: str) -> None:
    """`FROM documents d, LATERAL name(d.text)`: the parser's columns (fields: DDL) and error, for
    each text (null: empty). Another number or type of arguments is an error of analysis."""
    schema = _schema(fields)

    class Parser:
        @staticmethod
        def analyze(text: AnalyzeArgument) -> AnalyzeResult:
            if text.isTable or not isinstance(text.dataType, StringType):
                raise ValueError(f"{name} takes a text")
            return AnalyzeResult(schema)

        def eval(self, text: str) -> Iterator[tuple]:
            yield from _rows(parse, text or "", schema.names[:-1])

    spark.udtf.register(name, udtf(Parser))


def register_grouped(spark: SparkSession, name: str, parse: Callable[[list[dict]], list[dict]], fields: str, key: str, order: str) -> None:
    """`FROM name(TABLE(t))`: the parser gets the rows of each key in order and gives rows of
    the key, its columns (fields: DDL) and error. The function itself asks for the partitioning and
    the order; the rows of a key, which make up a document, are held by one task. A table without
    one of the two columns is an error of analysis."""
    own = _schema(fields)

    class Grouped:
        def __init__(self) -> None:
            self.rows: list[dict] = []

        @staticmethod
        def analyze(table: AnalyzeArgument) -> AnalyzeResult:
            if not table.isTable or not {key, order} <= set(table.dataType.names):
                raise ValueError(f"{name} takes a table with the columns {key} and {order}")
            schema = StructType([table.dataType[key], *own.fields])
            return AnalyzeResult(schema, partitionBy=[PartitioningColumn(key)], orderBy=[OrderingColumn(order)])

        def eval(self, row) -> None:
            self.rows.append(row.asDict())

        def terminate(self) -> Iterator[tuple]:
            if self.rows:
                for r in _rows(parse, self.rows, own.names[:-1]):
                    yield (self.rows[0][key], *r)

    spark.udtf.register(name, udtf(Grouped))
