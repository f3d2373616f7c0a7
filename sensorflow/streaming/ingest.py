"""Messages to checked readings on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.operators import messages, validate

#: How late a row may be, and how far its clock may be ahead of its arrival.
DELAY = "10 minutes"
AHEAD = "10 minutes"


def not_ahead(ahead: str = AHEAD) -> validate.Rule:
    """One wrong clock would move the watermark for all devices."""
    limit = F.col("received_at") + F.expr(f"INTERVAL {ahead}")
    return validate.Rule("ts must not be ahead of its arrival", 6, F.col("ts") > limit)


def ingest_stream(received: DataFrame, id_column: str | None = None, ahead: str = AHEAD) -> DataFrame:
    """Parsed rows of the subscribed topics with ``errors``: a broken payload, or the rules a row breaks."""
    rules = [*validate.default_rules(), not_ahead(ahead)]
    checked = validate.with_errors(messages.parse_messages(received, id_column), rules)
    broken = F.col("parse_error")
    return checked.withColumn(
        "errors", F.when(broken.isNotNull(), F.array(broken)).otherwise(F.col("errors"))
    )


def newest_copies(checked: DataFrame) -> DataFrame:
    """Of good rows with the same id the one that arrived last; the choice is the same on every run."""
    good = F.size("errors") == 0
    last = Window.partitionBy("reading_id").orderBy(F.desc("received_at"), "topic", "payload")
    return checked.filter(good).withColumn("_copy", F.row_number().over(last)).filter("_copy = 1").drop("_copy")


def good_rows(checked: DataFrame) -> DataFrame:
    return validate.valid(checked).drop("parse_error", "topic", "payload", "received_at")


def dead_letters(checked: DataFrame) -> DataFrame:
    return validate.dead(checked).select("topic", "payload", "received_at", "errors")


def once(readings: DataFrame, delay: str = DELAY) -> DataFrame:
    """Each reading id once, as far back as rows may be late."""
    return readings.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["reading_id"])
