"""Windowed counts with late data, and an idempotent upsert of a stream into a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.relational import pick
from ..sources import buckets as table


def windowed(events: DataFrame, late: str = "10 minutes", size: str = "1 day") -> DataFrame:
    """Count and sum per window and type; the same for a batch and for a stream."""
    out = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events
    per = out.groupBy(F.window("ts", size).alias("window"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return per.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def upsert_stream(spark: SparkSession, events: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Writes each micro-batch as a snapshot of its own; current() gives the last row of each key.
    A batch that is run again overwrites its own snapshot, so a restart changes nothing."""

    def put(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/load={epoch:08d}")

    return events.drop("load").writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, out: str, keys: Sequence[str], seq: str) -> DataFrame:
    """The last row of each key over all snapshots: of the latest load, and within it by seq."""
    return pick(spark.read.parquet(out), keys, F.col("load").desc(), F.col(seq).desc())


def upsert_buckets(stream: DataFrame, out: str, checkpoint: str, keys: Sequence[str], *order: Column, buckets: int = 16) -> StreamingQuery:
    """Keeps the first row of each key in the given order, over all batches so far, in a table of hash
    buckets: a batch rewrites the buckets that it touches, so reading costs the same however many
    batches there were. A batch that is run again changes nothing; late rows take their place."""

    def put(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        table.upsert(batch.sparkSession, out, batch, keys, *order, buckets=buckets, best=True)
        batch.unpersist()

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
