"""Occurrences as a stream: the same cell arithmetic, counted by event-time window and cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.operators.grids import Template


def windowed_counts(events: DataFrame, template: Template, time: str = "ts", x: str = "x", y: str = "y", width: str = "1 day", late: str = "1 day") -> DataFrame:
    """(start, grid_idx, occurrences); works on streams and on tables. Rows later than ``late`` are left out of streams."""
    mapped = events.withColumn("grid_idx", template.intersect(F.col(x), F.col(y))).where("grid_idx is not null")
    if events.isStreaming:
        mapped = mapped.withWatermark(time, late)
    return mapped.groupBy(F.window(time, width).alias("w"), "grid_idx").agg(F.count("*").alias("occurrences")).select(F.col("w.start").alias("start"), "grid_idx", "occurrences")


def stream_to_parquet(events: DataFrame, template: Template, path: str, checkpoint: str, **options):
    """Append closed windows to a Parquet table; exactly once through the sink's log."""
    return windowed_counts(events, template, **options).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").start()
