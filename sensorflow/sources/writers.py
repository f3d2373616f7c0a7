"""Writers by URI. Files are overwritten; Kafka gets key and value columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.sources.uris import FilePath, KafkaTopic, parse_uri

# Text formats would cut timestamps to milliseconds.
TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def as_text(rows: DataFrame) -> DataFrame:
    """One JSON document per row in ``value``."""
    return rows.select(F.to_json(F.struct("*"), TIMES).alias("value"))


def flat_columns(rows: DataFrame) -> DataFrame:
    """Struct, map and array columns as JSON text, for formats without nesting."""
    nested = (T.StructType, T.MapType, T.ArrayType)
    return rows.select(
        *[
            F.to_json(f.name, TIMES).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in rows.schema.fields
        ]
    )


def as_kafka(rows: DataFrame, key: str = "device_id") -> DataFrame:
    return rows.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*"), TIMES).alias("value"))


def envelopes_as_kafka(envelopes: DataFrame) -> DataFrame:
    """Outbound messages keyed by their device topic, the form the reader expects."""
    return envelopes.select(F.col("topic").alias("key"), F.col("payload").alias("value"))


def write_readings(rows: DataFrame, path: str) -> None:
    fmt = parse_uri(path if "/" in path else f"./{path}").fmt
    if fmt == "json":
        rows.write.mode("overwrite").options(**TIMES).json(path)
    elif fmt == "csv":
        flat_columns(rows).write.mode("overwrite").options(header=True, **TIMES).csv(path)
    else:
        as_text(rows).write.mode("overwrite").text(path)


def write_kafka(rows: DataFrame, sink: KafkaTopic) -> None:
    writer = as_kafka(rows).write.format("kafka").option("kafka.bootstrap.servers", sink.servers)
    writer.option("topic", sink.topic).save()


def open_sink(rows: DataFrame, uri: str) -> None:
    sink = parse_uri(uri)
    if isinstance(sink, FilePath):
        write_readings(rows, sink.path)
    else:
        write_kafka(rows, sink)
