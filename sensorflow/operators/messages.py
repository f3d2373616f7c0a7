"""Messages (topic, payload, received_at) to readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.payload import (
    enum_name,
    is_json,
    no_metadata,
    parse_json,
    parse_pairs,
    topic_device,
    topic_matches,
)
from sensorflow.schemas import LOCATION, QUALITY, STATUS

MALFORMED = "payload is not valid"


def subscribed(messages: DataFrame) -> DataFrame:
    return messages.filter(topic_matches(F.col("topic")))


def message_id() -> Column:
    """Same id for the same message on every run, so that a repeated task yields the same rows."""
    return F.sha2(F.concat_ws("|", "topic", "payload", F.unix_micros("received_at").cast("string")), 256)


def parse_messages(messages: DataFrame, id_column: str | None = None) -> DataFrame:
    """Readings of the subscribed topics; ``parse_error`` is set where the payload is broken.

    A JSON body without a device takes the device of the topic and keeps only type, value and unit.
    """
    own_id = message_id() if id_column is None else F.col(id_column).cast("string")
    body = F.col("payload")
    parsed = subscribed(messages).withColumns(
        {"_json": F.when(is_json(body), parse_json(body)), "_pairs": F.when(~is_json(body), parse_pairs(body))}
    )
    # A filter on the result would be pushed down and parse again for every field it reads; it is not
    # pushed below a generator.
    read = parsed.withColumn(
        "_read", F.explode(F.array(F.struct(F.col("_json").alias("json"), F.col("_pairs").alias("pairs"))))
    )
    doc, pairs, whole = F.col("_read.json"), F.col("_read.pairs"), F.col("_whole")
    read = read.withColumn("_whole", doc.isNotNull() & (F.coalesce(doc["DeviceId"], F.lit("")) != ""))

    def kept(column: Column) -> Column:
        return F.when(whole, column)

    place = doc["Location"]
    location = kept(
        F.when(
            place.isNotNull(),
            F.struct(
                place["Latitude"].alias("latitude"),
                place["Longitude"].alias("longitude"),
                place["Altitude"].alias("altitude"),
            ),
        )
    ).cast(LOCATION)
    return read.select(
        F.coalesce(kept(doc["Id"]), own_id).alias("reading_id"),
        F.when(whole, doc["DeviceId"]).otherwise(topic_device(F.col("topic"))).alias("device_id"),
        F.coalesce(doc["SensorType"], pairs["sensor_type"]).alias("sensor_type"),
        F.coalesce(doc["Value"]["Value"], pairs["value"]).alias("value"),
        F.coalesce(doc["Value"]["Unit"], pairs["unit"]).alias("unit"),
        F.coalesce(kept(doc["Timestamp"]), F.col("received_at")).alias("ts"),
        location.alias("location"),
        F.coalesce(kept(doc["Metadata"]), pairs["metadata"], no_metadata()).alias("metadata"),
        enum_name(kept(doc["Quality"]), QUALITY, "Good").alias("quality"),
        enum_name(kept(doc["Status"]), STATUS, "Active").alias("status"),
        F.when(doc["_broken"].isNotNull(), F.lit(MALFORMED)).alias("parse_error"),
        "topic",
        "payload",
        "received_at",
    )


def parsed_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("parse_error").isNull()).drop("parse_error", "topic", "payload", "received_at")


def broken_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("parse_error").isNotNull()).select("topic", "payload", "received_at", "parse_error")
