"""Incremental results with Structured Streaming.

The reference behaviour is resumption: keys that are done are skipped.  As a
stream, arriving JSON lines are taken once by the checkpoint, keys once by the
state, and each micro-batch is appended to the results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def arrivals(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """JSON-lines files as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def once(stream: DataFrame, keys: list[str], event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """The first row of each key; with an event time the state is dropped after the
    delay, so it doesn't grow for ever."""
    if event_time is None:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_usage(calls: DataFrame, event_time: str = "ts", width: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """(start, stage, n_calls, total) of call rows by tumbling window, late ones up
    to the delay."""
    g = calls.withWatermark(event_time, delay).groupBy(F.window(event_time, width), "stage")
    return g.agg(F.count("*").alias("n_calls"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "stage", "n_calls", "total")


def process(stream: DataFrame, stage: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Run a stage on each micro-batch and append its rows.  A batch that is run
    again after a failure replaces what it has written."""

    def write(batch: DataFrame, n: int) -> None:
        stage(batch).withColumn("batch", F.lit(n)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
