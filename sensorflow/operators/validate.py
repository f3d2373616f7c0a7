"""Required-field and range rules; good rows and dead letters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.numeric import outside


class Rule(NamedTuple):
    """A named condition; a warning is reported but does not reject the row."""

    name: str
    priority: int
    broken: Column
    warning: bool = False


def default_rules() -> list[Rule]:
    """The built-in rules; callers append their own."""
    latitude, longitude = F.col("location.latitude"), F.col("location.longitude")
    return [
        Rule("device_id is required", 1, F.coalesce(F.col("device_id"), F.lit("")) == ""),
        Rule("sensor_type is required", 2, F.coalesce(F.col("sensor_type"), F.lit("")) == ""),
        Rule("unit is required", 3, F.col("unit").isNull()),
        Rule("latitude must be between -90 and 90", 4, outside(latitude, F.lit(-90.0), F.lit(90.0))),
        Rule("longitude must be between -180 and 180", 5, outside(longitude, F.lit(-180.0), F.lit(180.0))),
    ]


def with_errors(rows: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Add ``errors`` and ``warnings``: names of the broken rules in priority order."""
    ordered = sorted(default_rules() if rules is None else rules, key=lambda r: r.priority)

    def broken(warning: bool) -> Column:
        hits = [F.when(r.broken, F.lit(r.name)) for r in ordered if r.warning == warning]
        return F.array_compact(F.array(*hits)).cast("array<string>")

    return rows.withColumns({"errors": broken(False), "warnings": broken(True)})


def valid(checked: DataFrame, processed_at: datetime | None = None) -> DataFrame:
    """Rows without errors, stamped."""
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp")
    return checked.filter(F.size("errors") == 0).drop("errors", "warnings").withColumn("processed_at", stamp)


def dead(checked: DataFrame) -> DataFrame:
    """Rows with errors, all columns kept."""
    return checked.filter(F.size("errors") > 0)
