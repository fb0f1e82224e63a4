"""Runs over files as they arrive.  The reference's way is batches that resume; the windowed counts are an extension."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def arrivals(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def resume(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """All files not yet seen through ``transform`` to ``out``; a run that starts again goes on after the last finished batch.

    Each batch writes a folder of its own, so a batch that is repeated replaces what it wrote.
    """

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, ts: str = "ts", key: str = "event_type", late: str = "10 minutes", width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Rows and the sum of ``value`` by window and key; rows later than ``late`` behind the newest are dropped."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return timed.groupBy(F.window(ts, width, slide or width), key).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(stream: DataFrame, ts: str = "ts", key: str = "user_id", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Rows by session of a key: a gap ends it."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return timed.groupBy(F.session_window(ts, gap), key).agg(F.count("*").alias("n"))
