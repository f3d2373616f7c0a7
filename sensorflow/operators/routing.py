"""Channels a reading or anomaly goes to, deliveries to subscribers, and outbound envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.payload import enum_code
from sensorflow.schemas import QUALITY, STATUS

#: Messages of a channel that one task takes; a channel with more is spread over salts.
SALT_ROWS = 1_000_000
#: At most so many channels are spread; with more, each salt takes more messages.
SPREAD_CHANNELS = 1 << 16
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _targets(pairs: list[tuple[Column, str]]) -> Column:
    return F.explode(F.array(*[F.struct(c.alias("channel"), F.lit(e).alias("event")) for c, e in pairs]))


def route_readings(readings: DataFrame) -> DataFrame:
    """Three rows per reading: everyone, the device's group, the sensor type's group."""
    targets = _targets(
        [
            (F.lit("all"), "SensorDataReceived"),
            (F.concat(F.lit("device_"), "device_id"), "DeviceDataReceived"),
            (F.concat(F.lit("sensor_"), "sensor_type"), "SensorTypeDataReceived"),
        ]
    )
    return readings.withColumn("_to", targets).select(*readings.columns, "_to.channel", "_to.event")


def route_anomalies(anomalies: DataFrame) -> DataFrame:
    """Three rows per anomaly: everyone, the device's group, the alerts group."""
    targets = _targets(
        [
            (F.lit("all"), "AnomalyDetected"),
            (F.concat(F.lit("device_"), "device_id"), "DeviceAnomalyDetected"),
            (F.lit("alerts"), "AlertReceived"),
        ]
    )
    return anomalies.withColumn("_to", targets).select(*anomalies.columns, "_to.channel", "_to.event")


def channel_salts(routed: DataFrame, salt_rows: int = SALT_ROWS) -> list[tuple[str, int]]:
    """Channels with more than ``salt_rows`` messages, and over how many salts each is spread."""
    counts = routed.groupBy("channel").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > salt_rows)
    total = counts.agg(F.sum("n")).first()[0] or 0
    limit = max(salt_rows, total // SPREAD_CHANNELS)
    return [(r["channel"], -(-r["n"] // limit)) for r in counts.filter(F.col("n") > limit).collect()]


def deliveries(routed: DataFrame, subscriptions: DataFrame, salt_rows: int = SALT_ROWS) -> DataFrame:
    """One row per routed message and subscriber of its channel.

    "All", "alerts" and the sensor types' channels hold large parts of all messages. Channels are counted first
    (a partial sum per task); messages of those above ``salt_rows`` are spread over as many salts as their size asks
    for and their subscribers copied to each. No other channel is copied.
    """
    large = channel_salts(routed, salt_rows)
    readers = subscriptions.select("channel", "subscriber")
    if not large:
        return routed.join(readers, "channel")
    salts = F.broadcast(routed.sparkSession.createDataFrame(large, "channel string, _salts bigint"))
    spread = F.pmod(F.xxhash64("reading_id"), F.coalesce("_salts", F.lit(1)))
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)) - 1)
    messages = routed.join(salts, "channel", "left").withColumn("_salt", spread).drop("_salts")
    readers = readers.join(salts, "channel", "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return messages.join(readers, ["channel", "_salt"]).drop("_salt")


def to_envelopes(readings: DataFrame) -> DataFrame:
    """Outbound message per reading: topic and JSON body, enumerations as codes."""
    location = F.col("location")
    body = F.struct(
        F.col("reading_id").cast("string").alias("Id"),
        F.col("device_id").alias("DeviceId"),
        F.col("sensor_type").alias("SensorType"),
        F.struct(F.col("value").alias("Value"), F.col("unit").alias("Unit")).alias("Value"),
        F.col("ts").alias("Timestamp"),
        F.when(
            location.isNotNull(),
            F.struct(
                location["latitude"].alias("Latitude"),
                location["longitude"].alias("Longitude"),
                location["altitude"].alias("Altitude"),
            ),
        ).alias("Location"),
        F.col("metadata").alias("Metadata"),
        enum_code(F.col("quality"), QUALITY).alias("Quality"),
        enum_code(F.col("status"), STATUS).alias("Status"),
    )
    return readings.select(
        "reading_id",
        "device_id",
        "ts",
        F.concat(F.lit("sensors/"), "device_id", F.lit("/data")).alias("topic"),
        F.to_json(body, TIMES).alias("payload"),
    )


def anomaly_envelopes(anomalies: DataFrame) -> DataFrame:
    body = F.struct(
        F.col("anomaly_id").alias("Id"),
        F.col("device_id").alias("DeviceId"),
        F.col("sensor_type").alias("SensorType"),
        F.col("type").alias("Type"),
        F.col("severity").alias("Severity"),
        F.col("description").alias("Description"),
        F.col("detected_at").alias("DetectedAt"),
        F.col("reading_id").cast("string").alias("ReadingId"),
    )
    return anomalies.select(
        "reading_id",
        "device_id",
        "detected_at",
        F.concat(F.lit("alerts/"), "device_id", F.lit("/anomaly")).alias("topic"),
        F.to_json(body, TIMES).alias("payload"),
    )
