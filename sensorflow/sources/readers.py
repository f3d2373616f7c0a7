"""Readings, messages and log lines from files and Kafka. Schemas are always given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.schemas import LOCATION, MESSAGES, READINGS
from sensorflow.sources.uris import FilePath, KafkaTopic, parse_uri

NESTED = ("location", "metadata")


def csv_schema(schema: T.StructType = READINGS) -> T.StructType:
    """CSV form of a schema: nested columns hold JSON text."""
    return T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in NESTED else f.dataType) for f in schema.fields]
    )


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """Readings from a json or csv path; any other extension gives raw text lines in ``value``."""
    fmt = parse_uri(path if "/" in path else f"./{path}").fmt
    if fmt == "json":
        return spark.read.schema(READINGS).json(path)
    if fmt == "csv":
        flat = spark.read.option("header", True).schema(csv_schema()).csv(path)
        return flat.withColumns(
            {
                "location": F.from_json("location", LOCATION),
                "metadata": F.from_json("metadata", "map<string,string>"),
            }
        )
    return spark.read.text(path)


BROKEN = "_broken"


def checked_file(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Readings of a json or csv path, a line each, with ``_broken``: the text of a line that doesn't fit, else null.

    A line fits if it can be parsed as a whole and each cell has its type; a CSV's nested cells must hold fitting JSON. A CSV's
    header, and any line equal to it, is skipped.
    """
    fmt = parse_uri(path if "/" in path else f"./{path}").fmt
    permissive = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    if fmt not in ("json", "csv"):
        raise ValueError(f"no lines with a schema in {path}")
    broken = T.StructField(BROKEN, T.StringType())
    lines = spark.read.text(path).filter(F.btrim("value") != "")
    if fmt == "json":
        read = F.from_json("value", T.StructType([*READINGS.fields, broken]), permissive)
    else:
        if header:
            lines = lines.filter(F.col("value") != ",".join(READINGS.fieldNames()))
        read = F.from_csv("value", T.StructType([*csv_schema().fields, broken]).toDDL(), permissive)
    # the whole line is parsed, also where a query reads some of its fields only
    rows = lines.select("value", F.explode(F.array(read)).alias("r"))
    cells = {n: F.col("r")[n] for n in READINGS.fieldNames()}
    fits = F.col("r").isNotNull() & F.col("r")[BROKEN].isNull()
    if fmt == "csv":
        place = F.from_json(cells["location"], T.StructType([*LOCATION.fields, broken]), permissive)
        noted = F.from_json(cells["metadata"], "map<string,string>")
        rows = rows.select("value", "r", F.explode(F.array(F.struct(place.alias("place"), noted.alias("noted")))).alias("n"))
        place, noted = F.col("n.place"), F.col("n.noted")
        fits &= cells["location"].isNull() | (place.isNotNull() & place[BROKEN].isNull())
        fits &= cells["metadata"].isNull() | noted.isNotNull()
        kept = F.struct(*[place[f].alias(f) for f in LOCATION.fieldNames()])
        cells |= {"location": F.when(place.isNotNull(), kept), "metadata": noted}
    return rows.select(*[F.when(fits, c).alias(n) for n, c in cells.items()], F.when(~fits, F.col("value")).alias(BROKEN))


def fitting_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(BROKEN).isNull()).drop(BROKEN)


def file_dead_letters(checked: DataFrame) -> DataFrame:
    """The text of each line that doesn't fit."""
    return checked.filter(F.col(BROKEN).isNotNull()).select(F.col(BROKEN).alias("line"))


def read_messages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(MESSAGES).format(fmt).load(path)


def message_stream(
    spark: SparkSession, path: str, fmt: str = "json", max_files: int = 1000, max_bytes: str | None = None
) -> DataFrame:
    """Messages as they arrive in a folder; the limits hold back what one batch takes."""
    reader = spark.readStream.schema(MESSAGES).format(fmt).option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = spark.readStream.schema(MESSAGES).format(fmt).option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def kafka_options(source: KafkaTopic) -> dict[str, str]:
    return {"kafka.bootstrap.servers": source.servers, "subscribe": source.topic}


def kafka_stream(spark: SparkSession, source: KafkaTopic, max_offsets: int = 1_000_000) -> DataFrame:
    raw = spark.readStream.format("kafka").options(**kafka_options(source)).option("maxOffsetsPerTrigger", max_offsets)
    return from_kafka(raw.load())


def kafka_batch(
    spark: SparkSession, source: KafkaTopic, start: str = "earliest", end: str = "latest"
) -> DataFrame:
    raw = spark.read.format("kafka").options(**kafka_options(source))
    return from_kafka(raw.option("startingOffsets", start).option("endingOffsets", end).load())


def from_kafka(raw: DataFrame) -> DataFrame:
    """Kafka columns -> messages. A broker topic has no levels, so the device topic travels as the key."""
    return raw.select(
        F.coalesce(F.col("key").cast("string"), F.col("topic")).alias("topic"),
        F.col("value").cast("string").alias("payload"),
        F.col("timestamp").alias("received_at"),
    )


def open_source(spark: SparkSession, uri: str) -> DataFrame:
    """Kafka URIs open as a stream of messages, paths as a batch by extension."""
    source = parse_uri(uri)
    if isinstance(source, FilePath):
        return read_readings(spark, source.path)
    return kafka_stream(spark, source)
