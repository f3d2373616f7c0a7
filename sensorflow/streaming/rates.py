"""Events per second over sliding windows on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.streaming.ingest import DELAY


def reading_rate_stream(
    rows: DataFrame, ts: str = "ts", window: str = "5 minutes", slide: str = "1 minute", delay: str = DELAY
) -> DataFrame:
    """Counts per window; a window is emitted once the watermark has passed its end."""
    span = F.window(ts, window, slide)
    return (
        rows.withWatermark(ts, delay)
        .groupBy(span)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            F.col("window.start").alias("window_start"),
            "events",
            (
                F.col("events")
                / (F.unix_seconds("window.end") - F.unix_seconds("window.start")).cast("double")
            ).alias("per_second"),
        )
    )
