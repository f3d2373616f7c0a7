"""Readings, messages and the other inputs derived from the given tables.

Every view is a row-by-row mapping of whole tables; the numbers only decide which shape a row takes.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime(2024, 1, 24)
ENRICH_AS_OF = datetime(2024, 1, 31)
ALERT_HOLD = timedelta(hours=6)

READINGS_SQL = """
SELECT event_id AS reading_id, concat('dev_', user_id) AS device_id,
 CASE event_type WHEN 'click' THEN 'temperature' WHEN 'view' THEN 'humidity' WHEN 'purchase' THEN 'pressure'
                 WHEN 'signup' THEN 'voltage' ELSE 'vibration' END AS sensor_type,
 CASE event_type WHEN 'click' THEN value - 45 WHEN 'view' THEN value - 10 WHEN 'purchase' THEN 950 + value
                 WHEN 'signup' THEN value / 10 ELSE CAST(floor(value / 100) AS DOUBLE) END AS value,
 CASE event_type WHEN 'click' THEN 'celsius' WHEN 'view' THEN 'percent' WHEN 'purchase' THEN 'hpa'
                 WHEN 'signup' THEN 'V' ELSE 'mm/s' END AS unit,
 ts,
 CAST(40.7 AS DOUBLE) + (user_id % 100) / CAST(1000 AS DOUBLE) AS latitude,
 CAST(-74.0 AS DOUBLE) - (user_id % 100) / CAST(1000 AS DOUBLE) AS longitude,
 CASE WHEN event_id % 100 < 85 THEN 'Good' WHEN event_id % 100 < 95 THEN 'Warning'
      WHEN event_id % 100 < 99 THEN 'Critical' ELSE 'Offline' END AS quality,
 CASE WHEN event_id % 50 = 7 THEN 'Maintenance' WHEN event_id % 50 = 9 THEN 'Error' ELSE 'Active' END AS status
FROM {events}
"""


# Times are instants, so that time filters reach the scan; the file stores them without a zone.
EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(EVENTS) if name == "events" else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def as_readings(events: DataFrame) -> DataFrame:
    """Events mapped to the readings schema."""
    flat = events.sparkSession.sql(READINGS_SQL, events=events)
    return flat.select(
        "reading_id",
        "device_id",
        "sensor_type",
        "value",
        "unit",
        "ts",
        F.struct("latitude", "longitude", F.lit(None).cast("double").alias("altitude")).alias("location"),
        F.create_map().cast("map<string,string>").alias("metadata"),
        "quality",
        "status",
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(table(spark, sf_dir, "events"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).filter(F.col("ts") < F.lit(AS_OF).cast("timestamp"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).filter(F.col("ts") >= F.lit(AS_OF).cast("timestamp"))


def dirty_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with faults: empty device, missing type or unit, latitude off the globe."""
    n = F.col("reading_id")
    place = F.col("location")
    moved = F.struct(
        F.when(n % 43 == 0, place["latitude"] + 90).otherwise(place["latitude"]).alias("latitude"),
        place["longitude"].alias("longitude"),
        place["altitude"].alias("altitude"),
    )
    return readings(spark, sf_dir).withColumns(
        {
            "device_id": F.when(n % 31 == 0, F.lit("")).otherwise(F.col("device_id")),
            "sensor_type": F.when(n % 37 != 0, F.col("sensor_type")),
            "unit": F.when(n % 41 != 0, F.col("unit")),
            "location": moved,
        }
    )


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reading in two versions; the second, an hour later, has another value, quality and status."""
    first = readings(spark, sf_dir).withColumn("updated_at", F.col("ts"))
    second = first.withColumns(
        {
            "value": F.col("value") + 1,
            "quality": F.lit("Warning"),
            "status": F.when(F.col("status") == "Active", F.lit("Active")).otherwise("Inactive"),
            "updated_at": F.col("ts") + F.expr("INTERVAL 1 HOUR"),
        }
    )
    return first.unionByName(second)


def tied_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some readings have a third version at the time of their second."""
    rows = versions(spark, sf_dir)
    second = rows.filter((F.col("updated_at") > F.col("ts")) & (F.col("reading_id") % 10 == 0))
    return rows.unionByName(second.withColumns({"value": F.col("value") + 1, "quality": F.lit("Critical")}))


def rich_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with an altitude here and there, and metadata whose keys and values are no plain words."""
    n, place = F.col("reading_id"), F.col("location")
    location = F.struct(place["latitude"].alias("latitude"), place["longitude"].alias("longitude"), F.when(n % 3 == 0, (n % 500).cast("double")).alias("altitude"))
    noted = F.create_map(F.lit("bat level"), (n % 100).cast("string"), F.lit('<q&"a">'), F.concat(F.lit("x < "), n.cast("string")))
    return readings(spark, sf_dir).withColumns({"location": location, "metadata": F.when(n % 4 != 0, noted).otherwise(F.col("metadata"))})


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line per reading; some are cut off, some have a text for the value."""
    n = F.col("reading_id")
    value = F.when(n % 47 == 0, F.lit('"high"')).otherwise(F.floor("value").cast("string"))
    line = F.concat(
        F.lit('{"reading_id":"'), n.cast("string"), F.lit('","device_id":"'), "device_id", F.lit('","sensor_type":"'), "sensor_type",
        F.lit('","value":'), value, F.lit(',"unit":"'), "unit", F.lit('"}'),
    )
    return readings(spark, sf_dir).select(F.when(n % 53 == 0, F.left(line, F.length(line) - 1)).otherwise(line).alias("value"))


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line per reading in the order of the columns; some have a text for the value, some a broken location."""
    n = F.col("reading_id")
    value = F.when(n % 47 == 0, F.lit("high")).otherwise(F.floor("value").cast("string"))
    place = F.when(n % 59 == 0, F.lit("{oops")).otherwise(F.lit(""))
    return readings(spark, sf_dir).select(
        F.concat_ws(",", n.cast("string"), "device_id", "sensor_type", value, "unit", F.lit(""), place, F.lit(""), "quality", "status").alias("value")
    )


def tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deleted ids: the keys of finished orders."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return orders.select(F.col("o_orderkey").alias("reading_id"))


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer follows one device; the desk of each nation follows the alerts, some an own sensor type, each region all."""
    own = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("device_dev_"), F.col("c_custkey") % 150).alias("channel"),
        F.concat(F.lit("customer_"), F.col("c_custkey")).alias("subscriber"),
    )
    alerts = table(spark, sf_dir, "nation").select(
        F.lit("alerts").alias("channel"), F.concat(F.lit("desk_"), F.col("n_nationkey")).alias("subscriber")
    )
    kinds = F.element_at(F.array(*map(F.lit, ("temperature", "humidity", "pressure", "voltage", "vibration"))), (F.col("n_nationkey") % 5 + 1).cast("int"))
    types = table(spark, sf_dir, "nation").filter("n_nationkey < 8").select(
        F.concat(F.lit("sensor_"), kinds).alias("channel"), F.concat(F.lit("lab_"), F.col("n_nationkey")).alias("subscriber")
    )
    everything = table(spark, sf_dir, "region").select(F.lit("all").alias("channel"), F.concat(F.lit("archive_"), F.col("r_regionkey")).alias("subscriber"))
    return own.unionByName(alerts).unionByName(types).unionByName(everything)


def as_messages(readings: DataFrame) -> DataFrame:
    """A message per reading in five payload shapes; some topics are not subscribed."""
    n, device, kind = F.col("reading_id"), F.col("device_id"), F.col("sensor_type")
    whole = F.floor("value").cast("bigint").cast("string")
    body = F.concat(
        F.lit('"SensorType":"'), kind, F.lit('","Value":{"Value":'), whole, F.lit(',"Unit":"'), "unit", F.lit('"}}')
    )
    topic = (
        F.when(n % 40 == 0, F.concat(F.lit("other/"), device, F.lit("/data")))
        .when(n % 2 == 0, F.concat(F.lit("sensors/"), device, F.lit("/data")))
        .otherwise(F.concat(F.lit("iot/"), device, F.lit("/telemetry")))
    )
    payload = (
        F.when(n % 5 == 0, F.concat(F.lit('{"DeviceId":"'), device, F.lit('",'), body))
        .when(n % 5 == 1, F.concat(F.lit(' {"DeviceId":"",'), body))
        .when(n % 5 == 2, F.concat(kind, F.lit(":"), whole, F.lit(",battery:"), (n % 100).cast("string"), F.lit(",bad")))
        .when(n % 5 == 3, F.concat(kind, F.lit(":abc")))
        .when(n % 10 == 4, F.lit("a:b:c"))
        .otherwise("{broken")
    )
    return readings.select(
        "reading_id", topic.alias("topic"), payload.alias("payload"), F.col("ts").alias("received_at")
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(readings(spark, sf_dir))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log line per event: queue depths for views and clicks, process metrics for the others."""
    events = table(spark, sf_dir, "events")
    n, value = F.col("event_id"), F.col("value")
    whole = F.floor(value * 4).cast("bigint").cast("string")
    queues = F.concat(
        F.lit("Channel Health Check - SensorData Queue: "), F.floor(value * 10).cast("bigint").cast("string"),
        F.lit(", Anomaly Queue: "), (n % 150).cast("string"),
    )
    process = F.concat(
        F.lit("System Health Metrics - WorkingSetMB: "), F.floor(value * 5).cast("bigint").cast("string"),
        F.lit(", CPUUsagePercent: "), (n % 101).cast("string"),
        F.lit(", AvailableMemoryMB: "), whole,
        F.lit(", ThreadCount: "), (n % 130).cast("string"),
    )
    return events.select(
        F.concat(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"),
            F.lit(" +00:00 [INF] "),
            F.when(F.col("event_type").isin("view", "click"), queues).otherwise(process),
        ).alias("value")
    )
