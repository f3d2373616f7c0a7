"""Lookups over stored readings and anomalies. Filters stay plain, so they reach the scan."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def by_id(readings: DataFrame, reading_id) -> DataFrame:
    return readings.filter(F.col("reading_id") == F.lit(reading_id))


def in_range(rows: DataFrame, start: datetime | None, end: datetime | None, ts: str = "ts") -> DataFrame:
    """Both ends inclusive, either may be open. Stored rows are also bounded by their day,
    with a day to spare for other time zones, which prunes folders; readings are dated by
    ``ts``, anomalies by ``detected_at``."""
    by_day = ts in ("ts", "detected_at") and "event_date" in rows.columns
    if start is not None:
        first = F.lit(start).cast("timestamp")
        rows = rows.filter(F.col(ts) >= first)
        rows = rows.filter(F.col("event_date") >= F.date_sub(first, 1)) if by_day else rows
    if end is not None:
        last = F.lit(end).cast("timestamp")
        rows = rows.filter(F.col(ts) <= last)
        rows = rows.filter(F.col("event_date") <= F.date_add(last, 1)) if by_day else rows
    return rows


def by_device(
    readings: DataFrame, device_id: str, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    return in_range(readings.filter(F.col("device_id") == device_id), start, end)


def by_type(
    readings: DataFrame, sensor_type: str, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Case-sensitive."""
    return in_range(readings.filter(F.col("sensor_type") == sensor_type), start, end)


def anomalies_by_device(
    anomalies: DataFrame, device_id: str | None = None, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    if device_id is not None:
        anomalies = anomalies.filter(F.col("device_id") == device_id)
    return in_range(anomalies, start, end, "detected_at")


def live(readings: DataFrame, tombstones: DataFrame) -> DataFrame:
    """Readings that were not deleted."""
    return readings.join(tombstones.select("reading_id"), "reading_id", "left_anti")


def find(readings: DataFrame, condition: str | Column) -> DataFrame:
    return readings.filter(condition)


def single(readings: DataFrame, condition: str | Column) -> DataFrame:
    """At most two rows: none, the one match, or proof that there is more than one."""
    return readings.filter(condition).limit(2)


def count(readings: DataFrame, condition: Column | None = None) -> DataFrame:
    """Number of rows, number that match, and whether any does."""
    match = F.lit(True) if condition is None else condition
    return readings.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(match).alias("matching"),
        (F.count_if(match) > 0).alias("any_match"),
    )


def page(
    readings: DataFrame,
    condition: str | Column,
    order_by: str,
    ascending: bool = True,
    skip: int = 0,
    take: int = 50,
) -> DataFrame:
    """One page in a total order: the reading id breaks ties."""
    key = F.col(order_by).asc() if ascending else F.col(order_by).desc()
    return readings.filter(condition).orderBy(key, F.col("reading_id").asc()).offset(skip).limit(take)


def newest(rows: DataFrame, key: str, at: str) -> DataFrame:
    """Of each key the row with the greatest ``at``; a per-task limit below the exchange drops the others early.

    All columns break ties, nested ones as text, so that a repeated task picks the same row.
    """
    nested = ("map", "struct", "array")
    rest = [F.to_json(F.struct(_in_order(n, t))) if t.startswith(nested) else F.col(n) for n, t in rows.dtypes]
    order = Window.partitionBy(key).orderBy(F.desc(at), *rest)
    return rows.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def _in_order(name: str, kind: str) -> Column:
    """Entries of a map have no order of their own."""
    return (F.array_sort(F.map_entries(name)) if kind.startswith("map") else F.col(name)).alias("v")


def current(versions: DataFrame) -> DataFrame:
    """Newest version of each reading."""
    return newest(versions, "reading_id", "updated_at")


def register_views(spark: SparkSession, **frames: DataFrame) -> None:
    """Make frames available to SQL text under their names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
