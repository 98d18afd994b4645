"""Tables that are updated in place by key (K03, K05): hash buckets of which only the touched ones are rewritten.

A table is a folder with one folder a bucket, by hash of the key. An upsert merges the buckets
that have new entries, writes the result aside, and then replaces these buckets by dynamic
partition overwrite. What was written aside stays until the replacement is done, so an upsert
that was cut off is finished by the next one, or repeated: both give the same table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import pick
from . import io

#: The folder of a bucket is named after this column. Spark's scans leave out what begins with an underscore.
BUCKET, _PENDING = "bucket", "_pending"


def _bucket(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table's rows with the given columns (DDL); a column that a bucket lacks is null in its rows. A missing table is empty."""
    empty = spark.createDataFrame([], schema)
    if not io.exists(spark, f"{path}/{BUCKET}=*"):
        return empty
    return spark.read.schema(f"{schema}, {BUCKET} int").parquet(path).select(*empty.columns)


def _finish(spark: SparkSession, path: str) -> int:
    """Replaces buckets by what complete upserts have written aside; drops what incomplete ones have. How many were complete."""
    folder, fs = _path(spark, f"{path}/{_PENDING}")
    if not fs.exists(folder):
        return 0
    done = 0
    for status in sorted(fs.listStatus(folder), key=lambda s: s.getModificationTime()):
        aside = status.getPath()
        if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(aside, "_SUCCESS")):
            if any(s.isDirectory() for s in fs.listStatus(aside)):
                _replace(spark.read.parquet(aside.toString()), path)
            done += 1
        fs.delete(aside, True)
    return done


def _replace(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def _aside(rows: DataFrame, path: str) -> None:
    """Writes rows aside, complete with its mark of success. A bucket is one file, or a few where it is large."""
    rows.repartition(BUCKET).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").partitionBy(BUCKET).parquet(f"{path}/{_PENDING}/{uuid.uuid4().hex}")


def merged(old: DataFrame, entries: DataFrame, keys: Sequence[str], *order: Column, best: bool = False) -> DataFrame:
    """Entries in place of old rows with their key; of several entries with a key, the first in the
    given order (which must tell them apart). best: of old rows and entries alike, the first in that order."""
    if best:
        return pick(old.unionByName(entries, allowMissingColumns=True), keys, *order)
    new = pick(entries, keys, *order) if order else entries.dropDuplicates(list(keys))
    same = [old[k].eqNullSafe(new[k]) for k in keys]
    return old.join(new, same, "left_anti").unionByName(new, allowMissingColumns=True)


def upsert(spark: SparkSession, path: str, entries: DataFrame, keys: Sequence[str], *order: Column, buckets: int = 64, best: bool = False) -> list[int]:
    """Puts entries into the table at path, in place of rows with their key; the buckets that were rewritten.

    buckets is fixed by the first upsert. Rows that no entry of the bucket names stay, and so do
    the files of other buckets. New columns are null in old rows, and columns that entries lack
    in new ones. The same entries twice change nothing more; no entries change nothing. Null
    keys are keys. With best, an entry replaces a row only if it comes first in the given order, so
    entries may arrive in any order, late or again. One upsert at a time: there is no lock.
    """
    if BUCKET in entries.columns:
        raise ValueError(f"the column {BUCKET} names the table's folders")
    _finish(spark, path)
    dealt = entries.withColumn(BUCKET, _bucket(keys, buckets))
    touched = sorted(r[0] for r in dealt.select(BUCKET).distinct().collect())  # no more than there are buckets
    if not touched:
        return []
    if io.exists(spark, f"{path}/{BUCKET}=*"):
        old = spark.read.option("mergeSchema", True).parquet(path).where(F.col(BUCKET).isin(touched))
        rows = merged(old, dealt, [BUCKET, *keys], *order, best=best)
    else:
        rows = merged(dealt.limit(0), dealt, [BUCKET, *keys], *order)
    _aside(rows, path)
    _finish(spark, path)
    return touched


def delete(spark: SparkSession, path: str, gone: DataFrame, keys: Sequence[str], buckets: int = 64) -> list[int]:
    """Takes the rows with the given keys out of the table; the buckets that were rewritten. A bucket that gets empty keeps no file."""
    _finish(spark, path)
    dealt = gone.select(*keys).withColumn(BUCKET, _bucket(keys, buckets)).distinct()
    touched = sorted(r[0] for r in dealt.select(BUCKET).distinct().collect())
    if not touched or not io.exists(spark, f"{path}/{BUCKET}=*"):
        return []
    old = spark.read.option("mergeSchema", True).parquet(path).where(F.col(BUCKET).isin(touched))
    left = old.join(dealt, [old[k].eqNullSafe(dealt[k]) for k in [BUCKET, *keys]], "left_anti")
    _aside(left, path)
    kept = {r[0] for r in left.select(BUCKET).distinct().collect()}
    had = {r[0] for r in old.select(BUCKET).distinct().collect()}
    _finish(spark, path)
    for b in had - kept:  # an overwrite by partitions leaves what gets no rows as it is
        folder, fs = _path(spark, f"{path}/{BUCKET}={b}")
        fs.delete(folder, True)
    return [b for b in touched if b in had]
