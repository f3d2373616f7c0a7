"""Operational log lines to metric rows, and alerts on them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The two kinds of metric lines and their time format.
SOURCES = ("Channel Health Check", "System Health Metrics")
LINE_TIME = "yyyy-MM-dd HH:mm:ss.SSS XXX"

# Metric -> (raise when above, raise when below, text).
BACKLOG_LIMITS = {
    "SensorData Queue": (1000.0, None, "High sensor data queue"),
    "Anomaly Queue": (100.0, None, "High anomaly queue"),
}
RESOURCE_LIMITS = {
    "WorkingSetMB": (1000.0, None, "High memory usage"),
    "CPUUsagePercent": (80.0, None, "High CPU usage"),
    "AvailableMemoryMB": (None, 500.0, "Low available memory"),
    "ThreadCount": (100.0, None, "High thread count"),
}


def parse_ops_log(lines: DataFrame) -> DataFrame:
    """``value`` text lines -> (ts, source, metric, value); other lines are left out."""
    text = F.col("value")
    source = F
    for name in SOURCES:
        source = source.when(text.contains(f"] {name} - "), F.lit(name))
    pairs = F.transform(
        F.split(F.split(text, " - ", 2)[1], ", "),
        lambda pair: F.struct(
            F.split_part(pair, F.lit(": "), F.lit(1)).alias("metric"),
            F.split_part(pair, F.lit(": "), F.lit(2)).try_cast("double").alias("value"),
        ),
    )
    return (
        lines.withColumn("source", source)
        .filter(F.col("source").isNotNull())
        .select(
            F.try_to_timestamp(F.substring_index(text, " [", 1), F.lit(LINE_TIME)).alias("ts"),
            "source",
            F.inline(pairs),
        )
    )


def limit_alerts(metrics: DataFrame, limits: Mapping[str, tuple[float | None, float | None, str]]) -> DataFrame:
    """Metric rows beyond their limit, with the limit and a text."""
    high = low = label = F
    for metric, (most, least, words) in limits.items():
        hit = F.col("metric") == metric
        high = high.when(hit, F.lit(most))
        low = low.when(hit, F.lit(least))
        label = label.when(hit, F.lit(words))
    return (
        metrics.filter(F.col("metric").isin(*limits))
        .withColumns({"_high": high.cast("double"), "_low": low.cast("double"), "alert": label})
        .filter((F.col("value") > F.col("_high")) | (F.col("value") < F.col("_low")))
        .select("ts", "metric", "value", F.coalesce("_high", "_low").alias("threshold"), "alert")
    )


def backlog_alerts(metrics: DataFrame) -> DataFrame:
    return limit_alerts(metrics, BACKLOG_LIMITS)


def resource_alerts(metrics: DataFrame) -> DataFrame:
    return limit_alerts(metrics, RESOURCE_LIMITS)
