"""Latest values, series, newest findings and batch summaries.

Every "newest n" is a row_number filter or a sort with limit: both become a limit per task before rows move.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.functions.numeric import above, is_number

CHARTED = ("temperature", "humidity")


def newest_per(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The last n rows of each key in (ts, reading_id) order."""
    order = Window.partitionBy(*keys).orderBy(F.desc("ts"), F.desc("reading_id"))
    return rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= n).drop("_rank")


def latest_readings(readings: DataFrame) -> DataFrame:
    return newest_per(readings, ["device_id", "sensor_type"], 1)


def latest_with_alert(readings: DataFrame, anomalies: DataFrame, as_of: datetime, hold: timedelta) -> DataFrame:
    """Latest reading per device and sensor, flagged while an anomaly is younger than ``hold``."""
    now = F.lit(as_of).cast("timestamp")
    since = F.lit(as_of - hold).cast("timestamp")
    alerts = (
        anomalies.filter((F.col("detected_at") >= since) & (F.col("detected_at") <= now))
        .groupBy("device_id", "sensor_type")
        .agg(F.max("detected_at").alias("alerted_at"))
    )
    latest = latest_readings(readings.filter(F.col("ts") <= now))
    return latest.join(alerts, ["device_id", "sensor_type"], "left").withColumn(
        "has_alert", F.col("alerted_at").isNotNull()
    )


def readings_on_alert(readings: DataFrame, anomalies: DataFrame, hold: timedelta, delay: str | None = None) -> DataFrame:
    """Readings beside each anomaly of their device and sensor that is not older than ``hold`` at their time.

    With ``delay`` both sides are streams, and state is kept for ``hold`` and ``delay`` at most.
    """
    alerts = anomalies.select(
        F.col("device_id").alias("_device"), F.col("sensor_type").alias("_type"), F.col("detected_at").alias("alerted_at"), F.col("reading_id").alias("alert_id")
    )
    if delay is not None:
        readings, alerts = readings.withWatermark("ts", delay), alerts.withWatermark("alerted_at", delay)
    held = F.expr(f"INTERVAL {int(hold.total_seconds())} SECONDS")
    same = (F.col("device_id") == F.col("_device")) & (F.col("sensor_type") == F.col("_type"))
    recent = (F.col("alerted_at") <= F.col("ts")) & (F.col("alerted_at") >= F.col("ts") - held)
    return readings.join(alerts, same & recent).drop("_device", "_type")


def chart_series(readings: DataFrame, points: int = 50) -> DataFrame:
    """Last points of each charted type, all devices in one series."""
    charted = readings.withColumn("series", F.lower("sensor_type")).filter(F.col("series").isin(*CHARTED))
    return newest_per(charted.select("series", "reading_id", "ts", "value"), ["series"], points)


def recent_anomalies(anomalies: DataFrame, n: int = 10) -> DataFrame:
    return (
        anomalies.withColumn("severity_percent", F.floor(F.col("severity") * 100 + 0.5))
        .orderBy(F.desc("detected_at"), F.desc("reading_id"))
        .limit(n)
    )


def activity_log(readings: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Readings and anomalies as log rows."""
    received = readings.select(
        "ts",
        F.lit("info").alias("level"),
        "reading_id",
        "device_id",
        F.concat(
            "device_id", F.lit(" sent "), "sensor_type", F.lit(" "),
            F.col("value").cast("string"), "unit",
        ).alias("message"),
    )
    warned = anomalies.select(
        F.col("detected_at").alias("ts"),
        F.lit("warning").alias("level"),
        "reading_id",
        "device_id",
        F.concat("device_id", F.lit(" finding: "), "description").alias("message"),
    )
    return received.unionByName(warned)


def recent_activity(readings: DataFrame, anomalies: DataFrame, n: int = 100) -> DataFrame:
    newest = (F.desc("ts"), F.desc("level"), F.desc("reading_id"))
    return activity_log(readings, anomalies).orderBy(*newest).limit(n)


def high_value_readings(readings: DataFrame, limit: float = 20.0) -> DataFrame:
    return readings.filter(above(F.col("value"), F.lit(limit)))


def batch_summary(readings: DataFrame, limit: float = 20.0, sample: int = 5) -> DataFrame:
    """Totals of a batch and its first few high values in (ts, reading_id) order, one item per row."""
    totals = readings.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(above(F.col("value"), F.lit(limit))).alias("filtered")
    ).unpivot([], ["total", "filtered"], "item", "n")
    first = high_value_readings(readings, limit).orderBy("ts", "reading_id").limit(sample)
    return totals.unionByName(
        first.select(F.lit("sample").alias("item"), "reading_id", "value"), allowMissingColumns=True
    )


def sensor_profile(readings: DataFrame) -> DataFrame:
    """Count, mean, population variance and deviation per type."""
    return (
        readings.filter(is_number(F.col("value")))
        .groupBy("sensor_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("value").alias("mean"),
            F.var_pop("value").alias("variance"),
            F.stddev_pop("value").alias("std_dev"),
            F.min("value").alias("lowest"),
            F.max("value").alias("highest"),
        )
    )
