"""Incremental ingestion with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronofold.sources.writers import replace_partitions


def new_files(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_a_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).format(fmt).load(path)


def run_once(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hands what is new since the last run to ``step`` and stops."""
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def snapshots_into(folder: str, by: str = "snapshot") -> Callable[[DataFrame, int], None]:
    """A step that replaces the partitions of the snapshots that a batch brings."""
    return lambda batch, _: replace_partitions(batch, folder, by)


def windowed_counts(events: DataFrame, time: str, by: list[str], window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by tumbling window; rows later than the watermark are left out."""
    return events.withWatermark(time, late).groupBy(F.window(time, window), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), *by, "n", "total")


def deduplicated(events: DataFrame, time: str, key: list[str], late: str = "2 hours") -> DataFrame:
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(key)
