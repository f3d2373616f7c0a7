"""Schemas and enumerations of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

LOCATION = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("altitude", T.DoubleType()),
    ]
)

READINGS = T.StructType(
    [
        T.StructField("reading_id", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("location", LOCATION),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("quality", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

# What the store adds to a reading.
AUDIT = T.StructType(
    [
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("deleted_at", T.TimestampType()),
        T.StructField("is_deleted", T.BooleanType()),
    ]
)

MESSAGES = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("received_at", T.TimestampType()),
    ]
)

# Body of a JSON message on the wire. Quality and status may come as code or as name.
PAYLOAD = T.StructType(
    [
        T.StructField("Id", T.StringType()),
        T.StructField("DeviceId", T.StringType()),
        T.StructField("SensorType", T.StringType()),
        T.StructField(
            "Value",
            T.StructType([T.StructField("Value", T.DoubleType()), T.StructField("Unit", T.StringType())]),
        ),
        T.StructField("Timestamp", T.TimestampType()),
        T.StructField(
            "Location",
            T.StructType(
                [
                    T.StructField("Latitude", T.DoubleType()),
                    T.StructField("Longitude", T.DoubleType()),
                    T.StructField("Altitude", T.DoubleType()),
                ]
            ),
        ),
        T.StructField("Metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("Quality", T.StringType()),
        T.StructField("Status", T.StringType()),
        T.StructField("_broken", T.StringType()),
    ]
)

# Names and codes of the enumerations.
QUALITY = {"Unknown": 0, "Good": 1, "Warning": 2, "Critical": 3, "Offline": 4}
STATUS = {"Unknown": 0, "Active": 1, "Inactive": 2, "Maintenance": 3, "Error": 4, "Calibrating": 5}
ANOMALY_TYPES = ("OutOfRange", "SuddenSpike", "SuddenDrop", "FlatLine", "NetworkTimeout", "DataCorruption")

# Columns every detector returns, before its own numbers.
FINDING = ("reading_id", "device_id", "sensor_type", "ts", "value", "type", "severity", "is_anomaly", "method")
