"""Events per second over a sliding window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sliding_rate(
    rows: DataFrame, ts: str = "ts", keys: Sequence[str] = (), window_minutes: int = 5, slide_minutes: int = 1
) -> DataFrame:
    """Count and rate per window start.

    Rows are counted per slide first; only those counts are copied to the windows they belong to, so the
    exchange carries one row per slide and task whatever the number of events.
    """
    if window_minutes % slide_minutes:
        raise ValueError("the window must be a multiple of the slide")
    slide = F.floor(F.unix_seconds(ts) / (slide_minutes * 60)) * (slide_minutes * 60)
    per_slide = rows.groupBy(*keys, slide.alias("_slide")).agg(F.count(F.lit(1)).alias("_n"))
    steps = window_minutes // slide_minutes
    back = F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("_back")
    return (
        per_slide.select("*", back)
        .groupBy(
            *keys, F.timestamp_seconds(F.col("_slide") - F.col("_back") * slide_minutes * 60).alias("window_start")
        )
        .agg(F.sum("_n").alias("events"))
        .withColumn("per_second", F.col("events") / F.lit(window_minutes * 60.0))
    )
