"""Small readings frames for hand-made cases."""

from __future__ import annotations

from datetime import datetime, timedelta

from sensorflow.schemas import READINGS

START = datetime(2024, 1, 1)


def readings(spark, items, unit="unit", step=timedelta(minutes=1)):
    """``items``: dicts of readings fields; missing ones get defaults, time advances by ``step``."""
    rows = []
    for i, item in enumerate(items):
        row = {
            "reading_id": f"r{i:05d}",
            "device_id": "d1",
            "sensor_type": "temperature",
            "value": 0.0,
            "unit": unit,
            "ts": START + i * step,
            "location": None,
            "metadata": {},
            "quality": "Good",
            "status": "Active",
        } | item
        rows.append(tuple(row[name] for name in READINGS.fieldNames()))
    return spark.createDataFrame(rows, READINGS)


def series(spark, sensor_type, values, device="d1"):
    return readings(spark, [{"sensor_type": sensor_type, "value": float(v), "device_id": device} for v in values])
