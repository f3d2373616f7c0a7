"""Readings as JSON or XML text and back."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
XML_DECLARATION = '<?xml version="1.0" encoding="utf-8"?>'

# Field names on the wire.
DOCUMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("deviceId", T.StringType()),
        T.StructField("sensorType", T.StringType()),
        T.StructField(
            "value",
            T.StructType([T.StructField("value", T.DoubleType()), T.StructField("unit", T.StringType())]),
        ),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField(
            "location",
            T.StructType(
                [
                    T.StructField("latitude", T.DoubleType()),
                    T.StructField("longitude", T.DoubleType()),
                    T.StructField("altitude", T.DoubleType()),
                ]
            ),
        ),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
        T.StructField("quality", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)


def document() -> Column:
    """The columns of a readings row as one struct with wire names."""
    return F.struct(
        F.col("reading_id").cast("string").alias("id"),
        F.col("device_id").alias("deviceId"),
        F.col("sensor_type").alias("sensorType"),
        F.struct(F.col("value"), F.col("unit")).alias("value"),
        F.col("ts").alias("timestamp"),
        F.col("location"),
        F.col("metadata"),
        F.col("quality"),
        F.col("status"),
    )


def to_json(doc: Column) -> Column:
    """Compact JSON; absent fields are left out and an absent document is ``null``."""
    return F.coalesce(F.to_json(doc, {"timestampFormat": TIMESTAMP_FORMAT}), F.lit("null"))


def from_json(text: Column) -> Column:
    absent = text.isNull() | text.isin("", "null")
    return F.when(~absent, F.from_json(text, DOCUMENT, {"timestampFormat": TIMESTAMP_FORMAT}))


#: Any text can be a metadata key, but not an element's name: entries carry their key as an attribute.
ENTRIES = "struct<entry: array<struct<_key: string, _VALUE: string>>>"

def _xml_schema() -> str:
    """DDL of the document as XML holds it."""
    return ", ".join(f"{f.name} {ENTRIES if f.name == 'metadata' else f.dataType.simpleString()}" for f in DOCUMENT.fields)


def to_xml(doc: Column) -> Column:
    """XML on one line with a declaration; an absent document is ``<null />``."""
    entries = F.transform(F.map_entries(doc["metadata"]), lambda e: F.struct(e["key"].alias("_key"), e["value"].alias("_VALUE")))
    held = F.when(doc["metadata"].isNotNull(), F.struct(entries.alias("entry")))
    doc = F.when(doc.isNotNull(), F.struct(*[(held if n == "metadata" else doc[n]).alias(n) for n in DOCUMENT.fieldNames()]))
    body = F.to_xml(doc, {"rowTag": "SensorData", "timestampFormat": TIMESTAMP_FORMAT, "indent": ""})
    return F.coalesce(F.concat(F.lit(XML_DECLARATION), F.btrim(body, F.lit("\n"))), F.lit("<null />"))


def from_xml(text: Column) -> Column:
    absent = text.isNull() | text.isin("", "<null />")
    options = {"rowTag": "SensorData", "timestampFormat": TIMESTAMP_FORMAT, "ignoreSurroundingSpaces": "false"}
    read = F.from_xml(text, _xml_schema(), options)

    def document(doc: Column) -> Column:
        pairs = F.transform(doc["metadata"]["entry"], lambda e: F.struct(e["_key"].alias("key"), F.coalesce(e["_VALUE"], F.lit("")).alias("value")))
        metadata = F.coalesce(F.map_from_entries(pairs), F.create_map().cast("map<string,string>"))
        return F.struct(*[(metadata if n == "metadata" else doc[n]).alias(n) for n in DOCUMENT.fieldNames()])

    return F.when(~absent, F.transform(F.array(read), document)[0])


class Format(NamedTuple):
    name: str
    write: Callable[[Column], Column]
    read: Callable[[Column], Column]


JSON = Format("json", to_json, from_json)
XML = Format("xml", to_xml, from_xml)
CONTENT_TYPES = {
    "application/json": JSON,
    "json": JSON,
    "application/xml": XML,
    "xml": XML,
    "text/xml": XML,
}


def serializer(content_type: str | None) -> Format:
    """Format for a content type, case-insensitive; JSON when it is unknown."""
    return CONTENT_TYPES.get((content_type or "").lower(), JSON)
