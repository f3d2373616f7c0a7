"""Cleaning and enrichment of single rows, and the ordered chain of such steps."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.limits import CLEAN_DEFAULT, CLEAN_RULES, EXPECTED_RANGES, by_contained_type
from sensorflow.functions.numeric import is_finite, is_number, outside, round_half_even

ENRICHMENT = (
    "temperature_f",
    "temperature_k",
    "pressure_psi",
    "pressure_inhg",
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "quality_score",
    "quality_level",
    "data_age_minutes",
    "is_fresh",
)


def clean(rows: DataFrame) -> DataFrame:
    """Repair, clamp and round ``value``; id, time, metadata, quality and status stay."""
    value, low, high = F.col("value"), F.col("_rule.low"), F.col("_rule.high")
    clamped = (
        F.when(low.isNull(), value)
        .when(~is_finite(value), (low + high) / 2)
        .otherwise(F.greatest(low, F.least(high, value)))
    )
    return (
        rows.withColumn("_rule", by_contained_type(F.lower("sensor_type"), CLEAN_RULES, CLEAN_DEFAULT))
        .withColumn("_clamped", F.when(value.isNotNull(), clamped))
        .withColumn("value", round_half_even(F.col("_clamped"), F.col("_rule.scale")))
        .drop("_rule", "_clamped")
    )


def quality_score(value: Column, in_range: Column, age_minutes: Column) -> Column:
    """Deductions in a fixed order: the sum of doubles depends on it."""
    zero = F.lit(0.0)
    score = F.lit(1.0)
    score = score - F.when(~is_finite(value), F.lit(0.5)).otherwise(zero)
    score = score - F.when(~in_range, F.lit(0.2)).otherwise(zero)
    score = score - F.when(age_minutes > 10, F.lit(0.1)).otherwise(zero)
    score = score - F.when(age_minutes > 60, F.lit(0.2)).otherwise(zero)
    return F.greatest(score, zero)


def quality_level(score: Column) -> Column:
    return (
        F.when(score >= 0.9, F.lit("Excellent"))
        .when(score >= 0.7, F.lit("Good"))
        .when(score >= 0.5, F.lit("Fair"))
        .when(score >= 0.3, F.lit("Poor"))
        .otherwise("Critical")
    )


def enrich(rows: DataFrame, as_of: datetime) -> DataFrame:
    """Add unit conversions, calendar fields, quality score and freshness as of a given moment."""
    value, ts, kind = F.col("value"), F.col("ts"), F.col("_kind")
    low, high = F.col("_expected.low"), F.col("_expected.high")
    celsius = kind.contains("temperature") & (F.lower("unit") == "celsius")
    hectopascal = kind.contains("pressure") & (F.lower("unit") == "hpa")
    present = value.isNotNull()
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(ts)) / F.lit(6e7)
    return (
        rows.withColumn("_kind", F.lower("sensor_type"))
        .withColumn("_expected", by_contained_type(kind, EXPECTED_RANGES))
        .withColumns(
            {
                "temperature_f": F.when(celsius, value * 9 / 5 + 32),
                "temperature_k": F.when(celsius, value + 273.15),
                "pressure_psi": F.when(hectopascal, value * 0.0145038),
                "pressure_inhg": F.when(hectopascal, value * 0.02953),
                "hour_of_day": F.when(present, F.hour(ts)),
                "day_of_week": F.when(present, F.date_format(ts, "EEEE")),
                "is_weekend": F.when(present, F.dayofweek(ts).isin(1, 7)),
                "in_expected_range": F.when(
                    present, F.col("_expected").isNull() | (is_number(value) & ~outside(value, low, high))
                ),
                "data_age_minutes": F.when(present, age),
            }
        )
        .withColumn(
            "quality_score",
            F.when(present, quality_score(value, F.col("in_expected_range"), F.col("data_age_minutes"))),
        )
        .withColumn("quality_level", F.when(present, quality_level(F.col("quality_score"))))
        .withColumn("is_fresh", F.col("data_age_minutes") < 5)
        .drop("_kind", "_expected")
    )


class Step(NamedTuple):
    name: str
    priority: int
    guard: Column
    apply: Callable[[DataFrame], DataFrame]


def cleaning_step() -> Step:
    return Step("DataCleaning", 1, F.col("value").isNotNull(), clean)


def enrichment_step(as_of: datetime) -> Step:
    return Step("DataEnrichment", 5, F.lit(True), lambda rows: enrich(rows, as_of))


def processing_step(name: str, as_of: datetime) -> Step:
    """Step by name, case-insensitive; cleaning when the name is unknown."""
    steps = {"datacleaning": cleaning_step(), "dataenrichment": enrichment_step(as_of)}
    return steps.get(name.lower(), steps["datacleaning"])


def run_steps(rows: DataFrame, steps: Sequence[Step]) -> tuple[DataFrame, list[str]]:
    """Apply the steps by priority; each leaves a struct column that says what it did."""
    traces = []
    for step in sorted(steps, key=lambda s: s.priority):
        trace = f"_step{len(traces)}"
        rows = step.apply(rows.withColumns({"_before": F.col("value"), "_ran": step.guard}))
        entry = F.struct(
            F.lit(step.name).alias("step"),
            F.lit(step.priority).alias("priority"),
            F.col("_before").alias("value_before"),
            F.col("value").alias("value_after"),
            _metadata_count(rows).alias("metadata_count"),
            F.col("_ran").alias("ran"),
        )
        rows = rows.withColumn(trace, entry).drop("_before", "_ran")
        traces.append(trace)
    return rows, traces


def processing_trace(rows: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """One row per reading and step that ran."""
    done, traces = run_steps(rows, steps)
    return (
        done.select("reading_id", F.explode(F.array(*traces)).alias("t"))
        .select("reading_id", "t.*")
        .filter("ran")
        .drop("ran")
    )


def _metadata_count(rows: DataFrame) -> Column:
    count = F.coalesce(F.cardinality("metadata"), F.lit(0)) if "metadata" in rows.columns else F.lit(0)
    for name in ENRICHMENT:
        if name in rows.columns:
            count = count + F.col(name).isNotNull().cast("int")
    return count
