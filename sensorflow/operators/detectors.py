"""Detectors that score readings against a profile of the history of their sensor type.

Each detector has two halves: ``profile`` reduces the history to one row per sensor type, ``judge`` turns
one reading and its profile into a verdict. Batch detection, routing and stream scoring share the halves.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.limits import ROUTES, STATIC_BOUNDS, TIMESERIES_TYPES, Bounds, by_contained_type, by_exact_type
from sensorflow.functions.numeric import above, below, capped, is_number, ratio
from sensorflow.functions.text import describe_bounds, describe_iqr, describe_trend, describe_zscore
from sensorflow.operators.joins import attach, settle
from sensorflow.operators.lookups import in_range
from sensorflow.operators.quartiles import index_quantiles
from sensorflow.operators.trend import linear_trend, moving_average
from sensorflow.schemas import FINDING

KEY = "sensor_type"
MIN_HISTORY = 10
MIN_RECENT = 5
ZSCORE_LIMIT = 2.5
DEVIATION_LIMIT = 0.3
IQR_LOOKBACK = timedelta(days=7)
TREND_LOOKBACK = timedelta(hours=24)
QUARTILES = {"q1": 0.25, "q3": 0.75}


@dataclass(frozen=True)
class Detector:
    """``judge()`` gives ``type`` (null = no finding), ``severity``, ``description`` and numbers.

    It may also give ``method`` where one detector works in several ways.
    """

    name: str
    method: str
    threshold: float
    can_handle: Callable[[Column], Column]
    judge: Callable[[], dict[str, Column]]
    profile: Callable[[DataFrame, datetime], DataFrame] | None = None
    numbers: tuple[str, ...] = field(default=())
    lookup: Callable[[], dict[str, Column]] = field(default=dict)

    def attach_profile(self, rows: DataFrame, history: DataFrame, as_of: datetime) -> DataFrame:
        """Add the profile columns and the fixed values ``judge`` reads."""
        rows = rows.withColumns(self.lookup())
        return rows if self.profile is None else attach(rows, self.profile(history, as_of), KEY)

    def verdict(self, numbers: tuple[str, ...] = ()) -> Column:
        found = {"method": F.lit(self.method)} | self.judge()
        return F.struct(*[found[n].alias(n) for n in ("type", "severity", "method", "description", *numbers)])

    def score(self, profiled: DataFrame) -> DataFrame:
        """Findings among rows that already carry the profile columns."""
        verdict = self.verdict(self.numbers)
        return (
            profiled.filter(F.col("value").isNotNull())
            .withColumn("_verdict", verdict)
            .filter(F.col("_verdict.type").isNotNull())
            .select(
                *[c for c in FINDING if c not in ("type", "severity", "is_anomaly", "method")],
                "_verdict.type",
                "_verdict.severity",
                (F.col("_verdict.severity") > 0).alias("is_anomaly"),
                "_verdict.method",
                *[F.col("_verdict")[n].alias(n) for n in self.numbers],
                "_verdict.description",
            )
        )

    def detect(self, scored: DataFrame, history: DataFrame, as_of: datetime) -> DataFrame:
        return self.score(self.attach_profile(scored, history, as_of))


def _spike_or_drop(value: Column, reference: Column) -> Column:
    return F.when(value > reference, F.lit("SuddenSpike")).otherwise("SuddenDrop")


def _any_type(sensor_type: Column) -> Column:
    return F.coalesce(sensor_type, F.lit("")) != ""


def zscore_profile(history: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return settle(
        history.filter(is_number(F.col("value")))
        .groupBy(KEY)
        .agg(
            F.count(F.lit(1)).alias("z_count"),
            F.avg("value").alias("z_mean"),
            F.stddev_pop("value").alias("z_std"),
        )
    )


def zscore_detector(threshold: float = ZSCORE_LIMIT) -> Detector:
    def judge() -> dict[str, Column]:
        value, mean, std = F.col("value"), F.col("z_mean"), F.col("z_std")
        count = F.coalesce(F.col("z_count"), F.lit(0))
        known = count >= MIN_HISTORY
        z = F.when(known, F.abs(ratio(value - mean, std)))
        kind = (
            F.when(~known, F.lit("NetworkTimeout"))
            .when(std == 0, F.lit("FlatLine"))
            .when(above(z, F.lit(threshold)), _spike_or_drop(value, mean))
        )
        severity = F.when(known & (std != 0), capped(z / threshold)).otherwise(0.0)
        return {
            "type": kind,
            "severity": severity,
            "z_score": z,
            "mean": F.when(known, mean),
            "std_dev": F.when(known, std),
            "history_count": count,
            "threshold": F.lit(threshold),
            "description": describe_zscore(kind, z, threshold),
        }

    return Detector(
        "statistical",
        "StatisticalAnomalyDetection",
        threshold,
        _any_type,
        judge,
        zscore_profile,
        ("z_score", "mean", "std_dev", "history_count", "threshold"),
    )


def has_static_bounds(sensor_type: Column, bounds: Mapping[str, Bounds] = STATIC_BOUNDS) -> Column:
    return F.lower(sensor_type).isin(*bounds) if bounds else F.lit(False)


def _bounds_lookup(bounds: Mapping[str, Bounds]) -> dict[str, Column]:
    return {"_bounds": by_exact_type(F.lower(KEY), bounds)}


def _judge_bounds() -> dict[str, Column]:
    value, low, high = F.col("value"), F.col("_bounds.low"), F.col("_bounds.high")
    under, over = below(value, low), above(value, high)
    kind = F.when(under, F.lit("SuddenDrop")).when(over, F.lit("SuddenSpike"))
    distance = F.when(under, ratio(low - value, F.abs(low))).otherwise(ratio(value - high, F.abs(high)))
    return {
        "type": kind,
        "severity": capped(F.coalesce(distance, F.lit(1.0))),
        "min": low,
        "max": high,
        "is_below": under,
        "is_above": over,
        "description": describe_bounds(value, low, high),
    }


def bounds_detector(bounds: Mapping[str, Bounds] = STATIC_BOUNDS) -> Detector:
    """Fixed bounds for known types only."""
    return Detector(
        "bounds",
        "ThresholdAnomalyDetection",
        1.0,
        lambda t: has_static_bounds(t, bounds),
        _judge_bounds,
        None,
        ("min", "max", "is_below", "is_above"),
        lambda: _bounds_lookup(bounds),
    )


def iqr_profile(history: DataFrame, as_of: datetime, bounds: Mapping[str, Bounds] = STATIC_BOUNDS) -> DataFrame:
    open_types = in_range(history, as_of - IQR_LOOKBACK, None).filter(~has_static_bounds(F.col(KEY), bounds))
    return index_quantiles(open_types, KEY, "value", QUARTILES).withColumnRenamed("n", "q_count")


def _judge_iqr() -> dict[str, Column]:
    value, q1, q3 = F.col("value"), F.col("q1"), F.col("q3")
    count = F.coalesce(F.col("q_count"), F.lit(0))
    known = count >= MIN_HISTORY
    iqr = q3 - q1
    low, high = q1 - iqr * 1.5, q3 + iqr * 1.5
    under, over = known & below(value, low), known & above(value, high)
    kind = (
        F.when(~known, F.lit("NetworkTimeout"))
        .when(under, F.lit("SuddenDrop"))
        .when(over, F.lit("SuddenSpike"))
        .otherwise("OutOfRange")
    )
    return {
        "type": kind,
        "severity": F.when(under | over, F.lit(0.8)).otherwise(0.0),
        "lower": F.when(known, low),
        "upper": F.when(known, high),
        "q1": F.when(known, q1),
        "q3": F.when(known, q3),
        "iqr": F.when(known, iqr),
        "history_count": count,
        "description": describe_iqr(kind, value, low, high, under | over),
    }


IQR_NUMBERS = ("lower", "upper", "q1", "q3", "iqr", "history_count")


def iqr_detector() -> Detector:
    """Quartile bounds, for any type handed in."""
    return Detector(
        "iqr",
        "ThresholdAnomalyDetection_Dynamic",
        1.0,
        _any_type,
        _judge_iqr,
        lambda history, as_of: iqr_profile(history, as_of, {}),
        IQR_NUMBERS,
    )


def threshold_detector(bounds: Mapping[str, Bounds] = STATIC_BOUNDS) -> Detector:
    """Fixed bounds for known types, quartile bounds for the others."""

    def judge() -> dict[str, Column]:
        fixed, dynamic = _judge_bounds(), _judge_iqr()
        known = F.col("_bounds").isNotNull()
        picked = {c: F.when(known, fixed[c]).otherwise(dynamic[c]) for c in ("type", "severity", "description")}
        method = F.when(known, F.lit("ThresholdAnomalyDetection")).otherwise("ThresholdAnomalyDetection_Dynamic")
        return picked | {"method": method} | {n: F.when(~known, dynamic[n]) for n in IQR_NUMBERS}

    return Detector(
        "threshold",
        "ThresholdAnomalyDetection",
        1.0,
        _any_type,
        judge,
        lambda history, as_of: iqr_profile(history, as_of, bounds),
        IQR_NUMBERS,
        lambda: _bounds_lookup(bounds),
    )


def trend_profile(history: DataFrame, as_of: datetime) -> DataFrame:
    average = moving_average(history, KEY, as_of, TREND_LOOKBACK)
    slope = linear_trend(history, KEY, as_of, TREND_LOOKBACK)
    return settle(
        average.join(slope, KEY).select(KEY, F.col("history_count").alias("e_count"), "ema", "trend")
    )


def trend_detector(sensitivity: float = DEVIATION_LIMIT) -> Detector:
    def judge() -> dict[str, Column]:
        value, ema, trend = F.col("value"), F.col("ema"), F.col("trend")
        count = F.coalesce(F.col("e_count"), F.lit(0))
        known = count >= MIN_RECENT
        expected = F.when(known, ema + trend)
        deviation = F.abs(value - expected) / F.greatest(F.abs(expected), F.lit(1.0))
        kind = F.when(~known, F.lit("NetworkTimeout")).when(
            above(deviation, F.lit(sensitivity)), _spike_or_drop(value, expected)
        )
        return {
            "type": kind,
            "severity": F.when(known, capped(deviation / sensitivity)).otherwise(0.0),
            "ema": F.when(known, ema),
            "trend": F.when(known, trend),
            "expected": expected,
            "deviation": deviation,
            "history_count": count,
            "description": describe_trend(kind, ema, expected, value, deviation),
        }

    def can_handle(sensor_type: Column) -> Column:
        return by_contained_type(F.lower(sensor_type), [(t, True) for t in TIMESERIES_TYPES], False)

    return Detector(
        "timeseries",
        "TimeSeriesAnomalyDetection",
        sensitivity,
        can_handle,
        judge,
        trend_profile,
        ("ema", "trend", "expected", "deviation", "history_count"),
    )


def all_detectors() -> dict[str, Detector]:
    return {d.name: d for d in (zscore_detector(), trend_detector(), threshold_detector())}


def detector(name: str) -> Detector:
    """Detector by name, case-insensitive; z-score when the name is unknown."""
    known = all_detectors()
    return known.get(name.lower(), known["statistical"])


def route(sensor_type: Column) -> Column:
    return by_contained_type(F.lower(sensor_type), ROUTES, "statistical")


def routed_anomalies(scored: DataFrame, history: DataFrame, as_of: datetime) -> DataFrame:
    """Each reading judged by the detector of its type, in one pass over the scored rows."""
    detectors = all_detectors()
    routed = scored.filter(F.col("value").isNotNull()).withColumn("_route", route(F.col(KEY)))
    chosen = history.withColumn("_route", route(F.col(KEY)))
    verdict = F
    for name, each in detectors.items():
        part = chosen.filter(F.col("_route") == name).drop("_route")
        routed = each.attach_profile(routed, part, as_of)
        verdict = verdict.when(F.col("_route") == name, each.verdict())
    return (
        routed.withColumn("_verdict", verdict)
        .filter(F.col("_verdict.type").isNotNull())
        .select(
            "reading_id",
            "device_id",
            "sensor_type",
            "ts",
            "value",
            "_verdict.type",
            "_verdict.severity",
            (F.col("_verdict.severity") > 0).alias("is_anomaly"),
            "_verdict.method",
            F.col("_route").alias("detector"),
            "_verdict.description",
        )
    )


def compatible_detectors(readings: DataFrame) -> DataFrame:
    """One row per sensor type and detector that accepts it."""
    accepts = [F.when(d.can_handle(F.col(KEY)), F.lit(name)) for name, d in all_detectors().items()]
    return (
        readings.select(KEY)
        .distinct()
        .select(KEY, F.explode(F.array_compact(F.array(*accepts))).alias("detector"))
    )
