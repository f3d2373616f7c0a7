"""Exponential average and linear trend of the recent values of each group.

The average is the closed form of the fold (weight 0.3 * 0.7^k for the k-th newest row, seed weight
0.7^(n-1)). Rows are ranked inside time slots of each group, and the slots of a group, at most ``SLOTS``,
are combined with the number of newer rows behind them. No group is ranked as a whole.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.functions.numeric import is_number
from sensorflow.operators.lookups import in_range

SLOTS = 86_400
ALPHA = 0.3
TREND_POINTS = 10


def recent(rows: DataFrame, as_of: datetime, lookback: timedelta) -> DataFrame:
    """Rows not older than ``lookback`` that hold a number."""
    return in_range(rows, as_of - lookback, None).filter(is_number(F.col("value")))


def moving_average(rows: DataFrame, key: str, as_of: datetime, lookback: timedelta) -> DataFrame:
    """``history_count`` and ``ema`` per key over the recent rows."""
    keep = 1 - ALPHA
    start = F.unix_micros(F.lit(as_of - lookback).cast("timestamp"))
    width = max(1, int(lookback.total_seconds() * 1e6) // SLOTS)
    slotted = recent(rows, as_of, lookback).select(
        key, "value", "ts", "reading_id", F.floor((F.unix_micros("ts") - start) / width).alias("_slot")
    )
    newest_first = Window.partitionBy(key, "_slot").orderBy(F.desc("ts"), F.desc("reading_id"))
    slots = (
        slotted.withColumn("_newer", F.row_number().over(newest_first) - 1)
        .groupBy(key, "_slot")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum(F.col("value") * ALPHA * F.pow(F.lit(keep), F.col("_newer"))).alias("_sum"),
            F.min_by("value", F.struct("ts", "reading_id")).alias("_first"),
        )
    )
    later = Window.partitionBy(key).orderBy(F.desc("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    return (
        slots.withColumn("_after", F.coalesce(F.sum("_n").over(later), F.lit(0)))
        .groupBy(key)
        .agg(
            F.sum("_n").alias("history_count"),
            F.sum(F.col("_sum") * F.pow(F.lit(keep), F.col("_after"))).alias("_weighted"),
            F.min_by("_first", "_slot").alias("_seed"),
        )
        .select(
            key,
            "history_count",
            (F.col("_weighted") + F.pow(F.lit(keep), F.col("history_count")) * F.col("_seed")).alias("ema"),
        )
    )


def linear_trend(rows: DataFrame, key: str, as_of: datetime, lookback: timedelta) -> DataFrame:
    """Least-squares slope over the newest values; 0 where it is undefined.

    The rank filter becomes a per-task limit below the exchange, so a hot group ships few rows.
    """
    newest_first = Window.partitionBy(key).orderBy(F.desc("ts"), F.desc("reading_id"))
    last = (
        recent(rows, as_of, lookback)
        .select(key, "value", "ts", "reading_id")
        .withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") <= TREND_POINTS)
    )
    slope = F.regr_slope("value", -F.col("_rank").cast("double"))
    return last.groupBy(key).agg(F.nanvl(F.coalesce(slope, F.lit(0.0)), F.lit(0.0)).alias("trend"))
