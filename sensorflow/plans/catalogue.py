"""The named queries: each takes a session and a data folder and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.functions import formats, payload
from sensorflow.operators import (
    anomalies,
    changes,
    detectors,
    lookups,
    messages,
    opslog,
    profiles,
    quartiles,
    rates,
    rolling,
    routing,
    transform,
    trend,
    validate,
    views,
)
from sensorflow.plans import fixtures as fx
from sensorflow.session import fresh_folder
from sensorflow.sources import readers, versions, writers
from sensorflow.sources.commits import commit
from sensorflow.sources.store import open_readings
from sensorflow.streaming import continuous, ingest
from sensorflow.streaming import rates as stream_rates
from sensorflow.streaming.ingest import once
from sensorflow.streaming.rolling import last_reports, rolling_query

Query = Callable[[SparkSession, str], DataFrame]

READING = ("reading_id", "device_id", "sensor_type", "value", "unit", "ts", "quality", "status")
FINDING = ("reading_id", "device_id", "sensor_type", "type", "severity", "is_anomaly", "method")
DEVICE = "dev_7"
RANGE = (datetime(2024, 1, 5), datetime(2024, 1, 20))


def comparable(rows: DataFrame) -> DataFrame:
    """Doubles to six decimals, integers to bigint, so that both engines print the same."""
    columns = []
    for f in rows.schema.fields:
        column = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            rounded = F.floor(column * 1e6 + 0.5) / F.lit(1e6)
            column = F.when(F.abs(column) < 9e12, rounded).otherwise(column).alias(f.name)  # NaN and infinity stay
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint").alias(f.name)
        columns.append(column)
    return rows.select(*columns)


def found_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.as_anomalies(rolling.rolling_anomalies(fx.readings(spark, sf_dir)))


def to_envelopes(spark, sf_dir):
    """Topic and, read back from the body, what was sent."""
    sent = routing.to_envelopes(fx.readings(spark, sf_dir)).withColumn("body", payload.parse_json(F.col("payload")))
    return sent.select(
        "reading_id",
        "topic",
        F.col("body.DeviceId").alias("device_id"),
        F.col("body.SensorType").alias("sensor_type"),
        F.col("body.Value.Value").alias("value"),
        F.col("body.Value.Unit").alias("unit"),
        F.col("body.Timestamp").alias("sent_at"),
        F.col("body.Location.Latitude").alias("latitude"),
        F.col("body.Quality").cast("bigint").alias("quality_code"),
        F.col("body.Status").cast("bigint").alias("status_code"),
    )


def anomaly_envelopes(spark, sf_dir):
    sent = routing.anomaly_envelopes(found_anomalies(spark, sf_dir))
    body = F.from_json("payload", "DeviceId string, SensorType string, Type string, Severity double")
    return sent.withColumn("body", body).select(
        "reading_id",
        "topic",
        F.col("body.DeviceId").alias("device_id"),
        F.col("body.SensorType").alias("sensor_type"),
        F.col("body.Type").alias("type"),
        F.col("body.Severity").alias("severity"),
    )


def route_readings(spark, sf_dir):
    return routing.route_readings(fx.readings(spark, sf_dir)).select("reading_id", "channel", "event")


def route_anomalies(spark, sf_dir):
    return routing.route_anomalies(found_anomalies(spark, sf_dir)).select("reading_id", "channel", "event")


def deliveries(spark, sf_dir):
    routed = route_readings(spark, sf_dir).unionByName(route_anomalies(spark, sf_dir))
    return routing.deliveries(routed, fx.subscriptions(spark, sf_dir))


def batch_summary(spark, sf_dir):
    return views.batch_summary(fx.readings(spark, sf_dir))


def high_value_readings(spark, sf_dir):
    return views.high_value_readings(fx.readings(spark, sf_dir)).select(*READING)


def validate_readings(spark, sf_dir):
    checked = validate.with_errors(fx.dirty_readings(spark, sf_dir))
    return validate.valid(checked, fx.ENRICH_AS_OF).select(*READING, "processed_at")


def dead_letters(spark, sf_dir):
    checked = validate.with_errors(fx.dirty_readings(spark, sf_dir))
    return validate.dead(checked).select("reading_id", "ts", F.concat_ws("; ", "errors").alias("errors"))


def reading_by_id(spark, sf_dir):
    return lookups.by_id(fx.readings(spark, sf_dir), 321).select(*READING)


def readings_by_device(spark, sf_dir):
    return lookups.by_device(fx.readings(spark, sf_dir), DEVICE, *RANGE).select(*READING)


def readings_by_type(spark, sf_dir):
    return lookups.by_type(fx.readings(spark, sf_dir), "temperature", *RANGE).select(*READING)


def anomalies_by_device(spark, sf_dir):
    found = lookups.anomalies_by_device(found_anomalies(spark, sf_dir), DEVICE, *RANGE)
    return found.select("anomaly_id", "reading_id", "device_id", "sensor_type", "type", "severity", "detected_at")


def live_readings(spark, sf_dir):
    return lookups.live(fx.readings(spark, sf_dir), fx.tombstones(spark, sf_dir)).select(*READING)


def find_readings(spark, sf_dir):
    return lookups.find(fx.readings(spark, sf_dir), "quality = 'Critical' AND value > 50").select(*READING)


def count_readings(spark, sf_dir):
    return lookups.count(fx.readings(spark, sf_dir), F.col("sensor_type") == "humidity")


def page_readings(spark, sf_dir):
    page = lookups.page(fx.readings(spark, sf_dir), "status = 'Active'", "value", ascending=False, skip=100, take=50)
    return page.select(*READING)


def current_readings(spark, sf_dir):
    return lookups.current(fx.versions(spark, sf_dir)).select(*READING, "updated_at")


def clean_readings(spark, sf_dir):
    return transform.clean(fx.readings(spark, sf_dir)).select(*READING)


def enrich_readings(spark, sf_dir):
    rows = transform.enrich(fx.readings(spark, sf_dir), fx.ENRICH_AS_OF)
    return rows.select("reading_id", "value", "in_expected_range", *transform.ENRICHMENT)


def processing_trace(spark, sf_dir):
    steps = [transform.enrichment_step(fx.ENRICH_AS_OF), transform.cleaning_step()]
    return transform.processing_trace(fx.readings(spark, sf_dir), steps)


def rolling_anomalies(spark, sf_dir):
    found = rolling.rolling_anomalies(fx.readings(spark, sf_dir))
    return found.select(*FINDING, "ts", "value", "prev_value", "pct_change", "variance10")


def anomaly_triage(spark, sf_dir):
    graded = anomalies.triage(rolling.rolling_anomalies(fx.readings(spark, sf_dir)))
    return graded.select("reading_id", "device_id", "sensor_type", "type", "severity", "level")


def _detect(detector: detectors.Detector, spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detector.detect(fx.scored(spark, sf_dir), fx.history(spark, sf_dir), fx.AS_OF)
    return found.select(*FINDING, *detector.numbers)


def zscore_anomalies(spark, sf_dir):
    return _detect(detectors.zscore_detector(), spark, sf_dir)


def threshold_anomalies(spark, sf_dir):
    return _detect(detectors.bounds_detector(), spark, sf_dir)


def iqr_anomalies(spark, sf_dir):
    unknown = ~detectors.has_static_bounds(F.col("sensor_type"))
    found = detectors.threshold_detector().detect(
        fx.scored(spark, sf_dir).filter(unknown), fx.history(spark, sf_dir), fx.AS_OF
    )
    return found.select(*FINDING, *detectors.IQR_NUMBERS)


def iqr_all_types(spark, sf_dir):
    return _detect(detectors.iqr_detector(), spark, sf_dir)


def ema_trend_anomalies(spark, sf_dir):
    return _detect(detectors.trend_detector(), spark, sf_dir)


def routed_anomalies(spark, sf_dir):
    found = detectors.routed_anomalies(fx.scored(spark, sf_dir), fx.history(spark, sf_dir), fx.AS_OF)
    return found.select(*FINDING, "detector")


def detector_compatibility(spark, sf_dir):
    return detectors.compatible_detectors(fx.readings(spark, sf_dir))


def latest_readings(spark, sf_dir):
    return views.latest_readings(fx.readings(spark, sf_dir)).select(*READING)


def latest_with_alert(spark, sf_dir):
    rows = views.latest_with_alert(
        fx.readings(spark, sf_dir), found_anomalies(spark, sf_dir), fx.AS_OF, fx.ALERT_HOLD
    )
    return rows.select("reading_id", "device_id", "sensor_type", "value", "ts", "alerted_at", "has_alert")


def chart_series(spark, sf_dir):
    return views.chart_series(fx.readings(spark, sf_dir))


def recent_anomalies(spark, sf_dir):
    newest = views.recent_anomalies(found_anomalies(spark, sf_dir))
    return newest.select("reading_id", "device_id", "sensor_type", "type", "detected_at", "severity_percent")


def recent_activity(spark, sf_dir):
    log = views.recent_activity(fx.readings(spark, sf_dir), found_anomalies(spark, sf_dir))
    return log.select("ts", "level", "reading_id", "device_id")


def sensor_profile(spark, sf_dir):
    return views.sensor_profile(fx.readings(spark, sf_dir))


def sensor_quartiles(spark, sf_dir):
    picked = quartiles.index_quantiles(fx.readings(spark, sf_dir), "sensor_type", "value", detectors.QUARTILES)
    return picked.withColumn("iqr", F.col("q3") - F.col("q1"))


def sensor_ema(spark, sf_dir):
    return trend.moving_average(fx.history(spark, sf_dir), "sensor_type", fx.AS_OF, detectors.TREND_LOOKBACK)


def sensor_trend(spark, sf_dir):
    return trend.linear_trend(fx.history(spark, sf_dir), "sensor_type", fx.AS_OF, detectors.TREND_LOOKBACK)


def reading_rate(spark, sf_dir):
    return rates.sliding_rate(fx.readings(spark, sf_dir))


def anomaly_rate(spark, sf_dir):
    return rates.sliding_rate(found_anomalies(spark, sf_dir), ts="detected_at", keys=["type"])


def message_rate(spark, sf_dir):
    received = messages.subscribed(fx.messages(spark, sf_dir))
    return rates.sliding_rate(received, ts="received_at")


def change_events(spark, sf_dir):
    source = F.create_map(F.lit("source"), F.col("status"))
    events = changes.change_events(fx.tied_versions(spark, sf_dir), metadata=source)
    place = F.col("location")
    flat = events.withColumns({"latitude": place["latitude"], "longitude": place["longitude"], "source": F.col("metadata")["source"]})
    return flat.drop("location", "metadata")


def quality_transitions(spark, sf_dir):
    return changes.quality_transitions(fx.readings(spark, sf_dir))


def parse_messages(spark, sf_dir):
    parsed = messages.parse_messages(fx.messages(spark, sf_dir), "reading_id")
    return parsed.select(
        F.col("reading_id").cast("bigint").alias("reading_id"),
        "device_id",
        "sensor_type",
        "value",
        "unit",
        "ts",
        F.col("metadata")["battery"].alias("battery"),
        F.cardinality("metadata").alias("metadata_count"),
        F.col("parse_error").isNotNull().alias("is_broken"),
    )


def serialize_json(spark, sf_dir):
    """The whole document, but for the number texts, which are compared as numbers."""
    text = formats.to_json(formats.document())
    number = r'"value":-?[0-9][0-9.E-]*,|"latitude":-?[0-9][0-9.E-]*,"longitude":-?[0-9][0-9.E-]*'
    return (
        fx.readings(spark, sf_dir)
        .withColumn("document", text)
        .select(
            "reading_id",
            F.regexp_replace("document", number, "#").alias("frame"),
            F.get_json_object("document", "$.value.value").cast("double").alias("value"),
            F.get_json_object("document", "$.location.longitude").cast("double").alias("longitude"),
        )
    )


def _roundtrip(fmt: formats.Format, spark: SparkSession, sf_dir: str) -> DataFrame:
    back = (
        fx.rich_readings(spark, sf_dir)
        .withColumn("text", fmt.write(formats.document()))
        .withColumn("doc", fmt.read(F.col("text")))
    )
    doc = F.col("doc")
    return back.select(
        "reading_id",
        (doc["id"] == F.col("reading_id").cast("string")).alias("same_id"),
        (F.length("text") > 0).alias("has_text"),
        doc["deviceId"].alias("device_id"),
        doc["sensorType"].alias("sensor_type"),
        doc["value"]["value"].alias("value"),
        doc["value"]["unit"].alias("unit"),
        doc["timestamp"].alias("ts"),
        doc["location"]["latitude"].alias("latitude"),
        doc["location"]["longitude"].alias("longitude"),
        doc["location"]["altitude"].alias("altitude"),
        F.cardinality(doc["metadata"]).alias("metadata_count"),
        doc["metadata"]["bat level"].alias("battery"),
        doc["metadata"]['<q&"a">'].alias("note"),
        doc["quality"].alias("quality"),
        doc["status"].alias("status"),
    )


def roundtrip_json(spark, sf_dir):
    return _roundtrip(formats.serializer("application/json"), spark, sf_dir)


def roundtrip_xml(spark, sf_dir):
    return _roundtrip(formats.serializer("text/xml"), spark, sf_dir)


def backlog_alerts(spark, sf_dir):
    return opslog.backlog_alerts(opslog.parse_ops_log(fx.log_lines(spark, sf_dir))).drop("alert")


def resource_alerts(spark, sf_dir):
    return opslog.resource_alerts(opslog.parse_ops_log(fx.log_lines(spark, sf_dir))).drop("alert")


def _store(spark: SparkSession, sf_dir: str, root: str) -> None:
    """All readings as one committed batch."""
    rows = fx.readings(spark, sf_dir).withColumn("reading_id", F.col("reading_id").cast("string"))
    versions.store_new(rows, root, 0)
    commit(spark, root, versions.ROWS, 0)


def _numbered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reading_id", F.col("reading_id").cast("bigint"))


def stored_once(spark, sf_dir):
    """Two deliveries: a third of the messages, then all of them; one stored reading per id."""
    root = fresh_folder(spark, "store")
    checked = ingest.ingest_stream(fx.messages(spark, sf_dir), "reading_id")
    continuous.store_batch(checked.filter(F.pmod(F.xxhash64("reading_id"), F.lit(3)) == 0), 0, root)
    continuous.store_batch(checked, 1, root)
    rows = _numbered(continuous.open_stored(spark, root, "readings"))
    return rows.select("reading_id", "device_id", "sensor_type", "value", "unit", "ts")


def _changed_store(spark: SparkSession, sf_dir: str) -> str:
    """Readings of open orders get their second version, those of finished orders are deleted."""
    root = fresh_folder(spark, "store")
    _store(spark, sf_dir, root)
    orders = fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("reading_id"), "o_orderstatus")
    second = fx.versions(spark, sf_dir).filter(F.col("updated_at") > F.col("ts"))
    open_ones = second.join(orders.filter("o_orderstatus = 'O'"), "reading_id", "left_semi")
    versions.update(open_ones.withColumn("reading_id", F.col("reading_id").cast("string")), root, fx.AS_OF)
    versions.delete(fx.tombstones(spark, sf_dir), root, fx.ENRICH_AS_OF)
    return root


def stored_current_readings(spark, sf_dir):
    rows = _numbered(versions.current_rows(spark, _changed_store(spark, sf_dir)))
    return rows.select(*READING, "updated_at", "is_deleted")


def compacted_readings(spark, sf_dir):
    target = fresh_folder(spark, "compacted")
    versions.compact_store(spark, _changed_store(spark, sf_dir), target)
    rows = _numbered(open_readings(spark, target + "/readings"))
    return rows.select(*READING, "updated_at", "is_deleted")


def daily_profiles(spark, sf_dir):
    """From the states of all days, made one part of the days after the other."""
    path = fresh_folder(spark, "profiles")
    dated = fx.readings(spark, sf_dir).withColumn("event_date", F.to_date("ts"))
    days = sorted(r["event_date"] for r in dated.select("event_date").distinct().collect())
    for some in (days[::2], days[1::2]):
        profiles.refresh(dated, path, some)
    return profiles.profile(spark, path)


def file_dead_letters(spark, sf_dir):
    """Lines of JSON and CSV files: the readings that fit, and the text of those that don't."""
    folder = fresh_folder(spark, "files")
    fx.json_lines(spark, sf_dir).write.text(f"{folder}/lines.json")
    fx.csv_lines(spark, sf_dir).write.text(f"{folder}/lines.csv")
    found = []
    for fmt in ("json", "csv"):
        checked = readers.checked_file(spark, f"{folder}/lines.{fmt}", header=False)
        rows = readers.fitting_rows(checked).select(F.col("reading_id").cast("bigint").alias("reading_id"), "value")
        dead = readers.file_dead_letters(checked)
        found.append(rows.unionByName(dead, allowMissingColumns=True).withColumn("format", F.lit(fmt)))
    return found[0].unionByName(found[1])


def written_files(spark, sf_dir):
    """Readings written as JSON and as CSV and read back."""
    folder = fresh_folder(spark, "files")
    rows = fx.rich_readings(spark, sf_dir).withColumn("reading_id", F.col("reading_id").cast("string"))
    found = []
    for fmt in ("json", "csv"):
        writers.open_sink(rows, f"{folder}/out.{fmt}")
        found.append(_numbered(readers.open_source(spark, f"{folder}/out.{fmt}")).withColumn("format", F.lit(fmt)))
    place, metadata = F.col("location"), F.col("metadata")
    return found[0].unionByName(found[1]).select(
        "format", *READING, place["latitude"].alias("latitude"), place["altitude"].alias("altitude"), metadata["bat level"].alias("battery"), metadata['<q&"a">'].alias("note")
    )


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.as_readings(spark.readStream.schema(fx.EVENTS).parquet(f"{sf_dir}/events*.parquet"))


def _finished(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Run a stream over all it has into a new folder and read the result."""
    folder = fresh_folder(spark, "stream")
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/rows")
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def rolling_anomalies_stream(spark, sf_dir):
    folder = fresh_folder(spark, "rolling")

    def sink(found: DataFrame, batch_id: int) -> None:
        found.write.mode("overwrite").parquet(f"{folder}/rows/batch_id={batch_id}")

    rolling_query(once(_event_stream(spark, sf_dir)), f"{folder}/checkpoint", sink).awaitTermination()
    found = spark.read.parquet(f"{folder}/rows")
    return found.select(*FINDING, "ts", "value", "prev_value", "pct_change", "variance10")


def rolling_anomalies_shuffled_stream(spark, sf_dir):
    """Events arrive up to two days late, in five deliveries; the reports that hold in the end."""
    folder, delay = fresh_folder(spark, "shuffled"), 2 * 86_400
    rows = fx.readings(spark, sf_dir)
    arrival = F.unix_seconds("ts") + F.pmod(F.xxhash64("reading_id"), F.lit(delay))
    start, stop = rows.agg(F.min(F.unix_seconds("ts")), F.max(F.unix_seconds("ts")) + delay).first()

    def sink(reported: DataFrame, batch_id: int) -> None:
        reported.write.mode("overwrite").parquet(f"{folder}/rows/batch_id={batch_id}")

    for turn in range(5 if start is not None else 0):
        low, high = (start + (stop - start) * t // 5 for t in (turn, turn + 1))
        rows.filter((arrival >= low) & (arrival < high)).write.parquet(f"{folder}/in/part={turn}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in/*")
        rolling_query(
            once(stream, f"{delay} seconds"), f"{folder}/checkpoint", sink, delay=f"{delay} seconds"
        ).awaitTermination()
    found = last_reports(spark.read.parquet(f"{folder}/rows"))
    return found.select(*FINDING, "ts", "value", "prev_value", "pct_change", "variance10")


def scored_stream(spark, sf_dir):
    arriving = _event_stream(spark, sf_dir).filter(F.col("ts") >= F.lit(fx.AS_OF).cast("timestamp"))
    detector = detectors.zscore_detector()
    found = detector.detect(arriving, fx.history(spark, sf_dir), fx.AS_OF)
    return _finished(spark, found.select(*FINDING, *detector.numbers))


def alert_hold_stream(spark, sf_dir):
    """Readings and anomalies as two streams; of each reading the last anomaly that is not too old for it."""
    folder = fresh_folder(spark, "alerts")
    found_anomalies(spark, sf_dir).write.parquet(folder)
    alerts = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
    held = views.readings_on_alert(_event_stream(spark, sf_dir), alerts, fx.ALERT_HOLD, ingest.DELAY)
    pairs = _finished(spark, held.select("reading_id", "alert_id", "alerted_at"))
    return pairs.groupBy("reading_id").agg(F.count(F.lit(1)).alias("alerts"), F.max("alerted_at").alias("alerted_at"))


def reading_rate_stream(spark, sf_dir):
    """Windows that the watermark has closed when all events are read."""
    return _finished(spark, stream_rates.reading_rate_stream(_event_stream(spark, sf_dir)))


def ingest_stream(spark, sf_dir):
    received = fx.as_messages(_event_stream(spark, sf_dir))
    rows = ingest.good_rows(ingest.ingest_stream(received, "reading_id"))
    return _finished(
        spark,
        rows.select(
            F.col("reading_id").cast("bigint").alias("reading_id"), "device_id", "sensor_type", "value", "unit", "ts"
        ),
    )


QUERIES: tuple[Query, ...] = (
    rolling_anomalies,
    anomaly_triage,
    zscore_anomalies,
    threshold_anomalies,
    iqr_anomalies,
    iqr_all_types,
    ema_trend_anomalies,
    routed_anomalies,
    detector_compatibility,
    validate_readings,
    dead_letters,
    clean_readings,
    enrich_readings,
    processing_trace,
    parse_messages,
    serialize_json,
    roundtrip_json,
    roundtrip_xml,
    reading_by_id,
    readings_by_device,
    readings_by_type,
    anomalies_by_device,
    live_readings,
    find_readings,
    count_readings,
    page_readings,
    current_readings,
    high_value_readings,
    batch_summary,
    latest_readings,
    latest_with_alert,
    chart_series,
    recent_anomalies,
    recent_activity,
    sensor_profile,
    sensor_quartiles,
    sensor_ema,
    sensor_trend,
    reading_rate,
    anomaly_rate,
    message_rate,
    change_events,
    quality_transitions,
    route_readings,
    route_anomalies,
    deliveries,
    to_envelopes,
    anomaly_envelopes,
    backlog_alerts,
    resource_alerts,
    rolling_anomalies_stream,
    rolling_anomalies_shuffled_stream,
    scored_stream,
    ingest_stream,
    stored_once,
    stored_current_readings,
    compacted_readings,
    daily_profiles,
    file_dead_letters,
    written_files,
    alert_hold_stream,
    reading_rate_stream,
)


def queries() -> dict[str, Query]:
    def finished(query: Query) -> Query:
        return lambda spark, sf_dir: comparable(query(spark, sf_dir))

    return {q.__name__: finished(q) for q in QUERIES}
