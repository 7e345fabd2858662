"""Streaming forms: tumbling counts with late rows bounded by a watermark, over a folder of files that grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def event_stream(spark: SparkSession, path: str, files: int = 1) -> DataFrame:
    """The event files of a folder as they come."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(path)


def tumbling(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Count and sum for each window and type; the state of a window goes once the watermark has passed it."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def distinct_once(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Each event id once within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
