"""Human-readable descriptions. Not part of any compared result: engines differ in number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def value_text(value: Column, unit: Column) -> Column:
    return F.concat(value.cast("string"), F.lit(" "), unit)


def location_text(location: Column) -> Column:
    altitude = F.when(
        location["altitude"].isNotNull(),
        F.concat(F.lit(" ("), location["altitude"].cast("string"), F.lit("m)")),
    ).otherwise("")
    return F.concat(
        location["latitude"].cast("string"), F.lit(", "), location["longitude"].cast("string"), altitude
    )


def describe_rolling(value: Column, kind: Column, low: Column, high: Column, percent: Column) -> Column:
    bounds = F.concat(
        F.lit("reading "), value.cast("string"), F.lit(" lies outside ["),
        low.cast("string"), F.lit(", "), high.cast("string"), F.lit("]"),
    )
    change = F.coalesce(F.format_string("%.1f", percent), F.lit("∞"))
    return (
        F.when(kind == "OutOfRange", bounds)
        .when(kind == "SuddenSpike", F.concat(F.lit("jump up by "), change, F.lit("% of the previous value")))
        .when(kind == "SuddenDrop", F.concat(F.lit("fall by "), change, F.lit("% of the previous value")))
        .when(kind == "FlatLine", F.lit("no change over the last readings"))
    )


def describe_zscore(kind: Column, z: Column, threshold: float) -> Column:
    return (
        F.when(kind == "NetworkTimeout", F.lit("too few earlier readings for a z-score"))
        .when(kind == "FlatLine", F.lit("earlier readings are all equal"))
        .otherwise(
            F.format_string("z-score %.2f, limit %.2f", z, F.lit(threshold))
        )
    )


def describe_bounds(value: Column, low: Column, high: Column) -> Column:
    side = F.when(value < low, F.lit("below")).otherwise("above")
    return F.format_string("%.2f is %s the bounds [%.2f, %.2f]", value, side, low, high)


def describe_iqr(kind: Column, value: Column, low: Column, high: Column, found: Column) -> Column:
    return (
        F.when(kind == "NetworkTimeout", F.lit("too few earlier readings for quartile bounds"))
        .when(found, F.format_string("%.2f outside the quartile bounds [%.2f, %.2f]", value, low, high))
        .otherwise(F.format_string("%.2f inside the quartile bounds [%.2f, %.2f]", value, low, high))
    )


def describe_trend(kind: Column, ema: Column, expected: Column, value: Column, deviation: Column) -> Column:
    return F.when(
        kind == "NetworkTimeout", F.lit("too few recent readings for a trend")
    ).otherwise(
        F.format_string(
            "average %.2f, expected %.2f, got %.2f, off by %.2f%%",
            ema, expected, value, deviation * 100,
        )
    )
