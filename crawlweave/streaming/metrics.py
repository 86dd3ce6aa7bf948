"""Crawl metrics over a live outcome log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_window_counts(events: DataFrame, length: str = "5 minutes", delay: str = "10 minutes",
                         by: tuple[str, ...] = ()) -> DataFrame:
    """Counts per window, emitted once the watermark closes it; later rows are dropped. Combines before the shuffle."""
    return (events.withWatermark("ts", delay).groupBy(F.window("ts", length).alias("w"), *by)
            .agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), *by, "n"))
