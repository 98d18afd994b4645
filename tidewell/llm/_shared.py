"""Session helpers of the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where unset one in the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/tidewell-staged"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: lineage ends here, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstage(*tables: DataFrame) -> None:
    """Deletes tables of staged() that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._staged_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def in_key_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key and text, range-partitioned and sorted by both, nulls first. Rows that share a key are
    dealt by the first characters of their texts, so that one key may hold any number of them."""
    order = [F.col(key).asc_nulls_first(), F.col(text).asc_nulls_first()]
    return docs.select(key, text).repartitionByRange(order[0], F.substring(text, 1, 64).asc_nulls_first()).sortWithinPartitions(*order)


#: A key with more than this share of a table's rows is dealt to several tasks; at most as many keys are.
HEAVY = 256


def heavy_limit(rows: int) -> int:
    """How many rows of a table with so many a key may have before it is split."""
    return max(1000, rows // HEAVY)


def _table(spark: SparkSession, found: list, like: DataFrame) -> DataFrame:
    """Collected rows as a table, without a Python worker on the executors."""
    columns = [pa.array([r[i] for r in found], to_arrow_type(f.dataType)) for i, f in enumerate(like.schema)]
    return spark.createDataFrame(pa.table(columns, names=like.columns)).select(*[F.col(f.name).cast(f.dataType) for f in like.schema])


def spread_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], by: str, counts: DataFrame, limit: int, how: str = "inner") -> DataFrame:
    """rows joined with table, which has one row a key at most. counts (keys, count) tells how many rows each key has.

    Rows of a key with more than `limit` of them are dealt to several tasks by the hash of `by`,
    and its row of the table goes to each of these. Only the heavy keys come to the driver: at
    most HEAVY of them, as each has more than that share of the rows.
    """
    heavy = counts.where(F.col("count") > limit).select(*keys, F.ceil(F.col("count") / limit).cast("int").alias("_parts"))
    found = heavy.collect()
    if not found:
        return rows.join(table, list(keys), how)
    few = F.broadcast(_table(rows.sparkSession, found, heavy))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = rows.join(few, list(keys), "left").withColumn("_salt", F.pmod(F.xxhash64(by), parts).cast("int")).drop("_parts")
    copied = table.join(few, list(keys), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return dealt.join(copied, [*keys, "_salt"], how).drop("_salt")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 1,000 rows, where the session has Spark's default of 10,000: so many
    whole texts, in the JVM's buffers and in a Python worker's, take too much of an executor."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")


def remainder(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)
