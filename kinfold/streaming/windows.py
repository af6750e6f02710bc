"""An extension beyond linkage: windowed counts that run alike on tables and on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_windows(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(window_start, event_type, n, total) per tumbling window; on a stream, rows later than ``late`` are left out."""
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp"))
    held = stamped.withWatermark("ts", late) if events.isStreaming else stamped
    counted = held.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return counted.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "total")
