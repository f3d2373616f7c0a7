"""Findings as stored anomalies, and their severity grades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def severity_level(severity: Column) -> Column:
    return (
        F.when(severity >= 0.8, F.lit("critical"))
        .when(severity >= 0.6, F.lit("high"))
        .when(severity >= 0.4, F.lit("medium"))
        .when(severity >= 0.2, F.lit("low"))
        .otherwise("none")
    )


def triage(findings: DataFrame) -> DataFrame:
    return findings.withColumn("level", severity_level(F.col("severity")))


def as_anomalies(findings: DataFrame) -> DataFrame:
    """Stored form: real anomalies only, with an id that is the same on every run."""
    return findings.filter("is_anomaly").select(
        F.sha2(F.concat_ws("|", F.col("reading_id").cast("string"), "method", "type"), 256).alias("anomaly_id"),
        "device_id",
        "sensor_type",
        "type",
        "severity",
        "description",
        F.col("ts").alias("detected_at"),
        "reading_id",
        "method",
    )
