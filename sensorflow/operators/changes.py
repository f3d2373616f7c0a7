"""Change events between successive versions of a reading, and quality changes along a series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.payload import no_metadata
from sensorflow.operators.series import HOT_ROWS, numbered, over_series


def change_events(versions: DataFrame, hot_rows: int = HOT_ROWS, metadata: Column | None = None) -> DataFrame:
    """One row per event.

    Created for the first version; value updated for each later one, equal or not; quality and status
    only when they differ; location for each version that has one. ``sequence`` numbers a reading's
    versions, so that those of one time have ids of their own; versions equal in all columns are
    interchangeable. ``metadata`` is what the caller notes with the events of a version.
    """
    carried = ("value", "unit", "quality", "status")
    noted = (no_metadata() if metadata is None else metadata).alias("metadata")
    kept = versions.select("reading_id", "device_id", "updated_at", *carried, "location", noted)
    order = ["updated_at", *carried, "device_id", "location"]
    seen = over_series(
        numbered(kept, ["reading_id"], order, "sequence", hot_rows),
        ["reading_id"],
        order,
        1,
        lambda w: {"_before": F.lag(F.struct(*carried)).over(w), "_first": F.lag(F.lit(1)).over(w).isNull()},
        hot_rows,
    )
    before, later = F.col("_before"), ~F.col("_first")
    events = F.array(
        F.when(F.col("_first"), F.lit("SensorDataCreated")),
        F.when(later, F.lit("SensorValueUpdated")),
        F.when(later & ~before["quality"].eqNullSafe(F.col("quality")), F.lit("SensorQualityChanged")),
        F.when(F.col("location").isNotNull(), F.lit("SensorLocationUpdated")),
        F.when(later & ~before["status"].eqNullSafe(F.col("status")), F.lit("SensorStatusChanged")),
    )
    kind = F.col("event_type")

    def only(event: str, column):
        return F.when(kind == event, column)

    return seen.withColumn("event_type", F.explode(events)).filter(kind.isNotNull()).select(
        F.sha2(
            F.concat_ws("|", *[F.col(c).cast("string") for c in ("reading_id", "event_type")], F.unix_micros("updated_at").cast("string"), F.col("sequence").cast("string")),
            256,
        ).alias("event_id"),
        "event_type",
        F.lit(1).alias("version"),
        "sequence",
        "metadata",
        "reading_id",
        "device_id",
        F.col("updated_at").alias("occurred_on"),
        only("SensorValueUpdated", before["value"]).alias("old_value"),
        F.when(kind.isin("SensorDataCreated", "SensorValueUpdated"), F.col("value")).alias("new_value"),
        only("SensorValueUpdated", before["unit"]).alias("old_unit"),
        F.when(kind.isin("SensorDataCreated", "SensorValueUpdated"), F.col("unit")).alias("new_unit"),
        only("SensorQualityChanged", before["quality"]).alias("old_quality"),
        only("SensorQualityChanged", F.col("quality")).alias("new_quality"),
        only("SensorStatusChanged", before["status"]).alias("old_status"),
        only("SensorStatusChanged", F.col("status")).alias("new_status"),
        only("SensorLocationUpdated", F.col("location")).alias("location"),
    )


def quality_transitions(readings: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Readings whose quality differs from the previous reading of the same device and sensor."""
    seen = over_series(
        readings.select("reading_id", "device_id", "sensor_type", "ts", "quality"),
        ["device_id", "sensor_type"],
        ["ts", "reading_id"],
        1,
        lambda w: {"old_quality": F.lag("quality").over(w)},
        hot_rows,
    )
    changed = F.col("old_quality").isNotNull() & (F.col("old_quality") != F.col("quality"))
    return seen.filter(changed).withColumnRenamed("quality", "new_quality")
