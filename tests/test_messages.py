"""Parsing of topics and payloads, and the way back."""

from datetime import datetime

import pytest
from rows import readings

from pyspark.sql import functions as F
from sensorflow.functions import formats
from sensorflow.operators import messages, opslog, routing
from sensorflow.schemas import MESSAGES

AT = datetime(2024, 1, 1, 12)

CASES = [
    ("sensors/d1/data", "temperature:25.5,humidity:60.2", ("d1", "temperature", 25.5, "unit", {"humidity": "60.2"})),
    ("iot/d2/telemetry", "temperature: 25.5 , x:1:2, y", ("d2", "temperature", 25.5, "unit", {})),
    ("sensors/d1/data", "temperature:abc", ("d1", "temperature", 0.0, "unit", {})),
    ("sensors/d1/data", "temperature:25.5f", ("d1", "temperature", 0.0, "unit", {})),
    ("sensors/d1/data", "temperature:1e2", ("d1", "temperature", 100.0, "unit", {})),
    ("sensors/d1/data", "\tt :-.5", ("d1", "t", -0.5, "unit", {})),
    ("sensors/d1/data", "t:1,a:1,b:2, a : 3 ", ("d1", "t", 1.0, "unit", {"a": "3", "b": "2"})),
    ("sensors/d1/data", "", ("d1", "unknown", 0.0, "unknown", {})),
    ("sensors/d1/data", "a:b:c", ("d1", "unknown", 0.0, "unknown", {})),
    ("sensors/d1/data", "a:b:c,k:v", ("d1", "unknown", 0.0, "unknown", {})),
    (
        "sensors/d1/data",
        '{"DeviceId":"","SensorType":"ph","Value":{"Value":7,"Unit":"pH"},"Quality":3,"Metadata":{"a":"b"}}',
        ("d1", "ph", 7.0, "pH", {}),
    ),
    (
        "sensors/d1/data",
        ' \n{"DeviceId":"d9","SensorType":"ph","Value":{"Value":7.5,"Unit":"pH"},"Metadata":{"a":"b"}}',
        ("d9", "ph", 7.5, "pH", {"a": "b"}),
    ),
    ("sensors/d1/data", '{"deviceid":"d9","SensorType":"ph"}', ("d1", "ph", None, None, {})),
]


def received(spark, pairs):
    return spark.createDataFrame([(t, p, AT) for t, p in pairs], MESSAGES)


def test_cases(spark):
    rows = messages.parse_messages(received(spark, [(t, p) for t, p, _ in CASES])).collect()
    got = {(r.topic, r.payload): r for r in rows}
    for topic, payload, expected in CASES:
        r = got[(topic, payload)]
        assert (r.device_id, r.sensor_type, r.value, r.unit, r.metadata) == expected, payload
        assert r.parse_error is None and r.ts == AT


@pytest.mark.parametrize("payload", ["{broken", '{"Value":{"Value":"abc","Unit":"u"},"DeviceId":"d"}', '{"DeviceId":'])
def test_broken_json(spark, payload):
    parsed = messages.parse_messages(received(spark, [("sensors/d1/data", payload)]))
    assert messages.parsed_rows(parsed).isEmpty()
    assert messages.broken_rows(parsed).first().payload == payload


@pytest.mark.parametrize(
    "topic,kept",
    [
        ("sensors/d1/data", True),
        ("iot/d1/telemetry", True),
        ("other/d1/data", False),
        ("sensors/d1/x/data", False),
        ("sensors/d1/telemetry", False),
        ("a/sensors/d1/data", False),
    ],
)
def test_subscriptions(spark, topic, kept):
    assert messages.subscribed(received(spark, [(topic, "x")])).isEmpty() != kept


def test_ids_repeat(spark):
    frame = received(spark, [("sensors/d1/data", "t:1"), ("sensors/d1/data", "t:2")])
    first = {r.reading_id for r in messages.parse_messages(frame).collect()}
    assert first == {r.reading_id for r in messages.parse_messages(frame).collect()} and len(first) == 2


def samples(spark):
    return readings(
        spark,
        [
            {"location": (40.5, -74.25, None), "metadata": {"k": "v"}, "quality": "Warning", "status": "Error"},
            {"location": (1.0, 2.0, 3.5), "value": 1.25, "ts": datetime(2024, 5, 6, 7, 8, 9, 123456)},
            {"value": -0.001, "sensor_type": 'odd "<&> type', "unit": "°C"},
        ],
    )


def test_envelope_comes_back(spark):
    sent = samples(spark)
    wire = routing.to_envelopes(sent).select("topic", "payload", F.col("ts").alias("received_at"))
    back = messages.parsed_rows(messages.parse_messages(wire)).select(*sent.columns)
    assert sorted(back.collect()) == sorted(sent.collect())


@pytest.mark.parametrize("content_type", ["application/json", "XML", "text/xml"])
def test_documents_come_back(spark, content_type):
    fmt = formats.serializer(content_type)
    sent = samples(spark)
    doc = fmt.read(F.col("text"))
    back = sent.withColumn("text", fmt.write(formats.document())).select(
        doc["id"].alias("reading_id"),
        doc["deviceId"].alias("device_id"),
        doc["sensorType"].alias("sensor_type"),
        doc["value"]["value"].alias("value"),
        doc["value"]["unit"].alias("unit"),
        doc["timestamp"].alias("ts"),
        doc["location"].alias("location"),
    )
    assert sorted(back.collect()) == sorted(sent.select(*back.columns).collect())


def test_document_text(spark):
    rows = samples(spark).orderBy("reading_id").limit(1)
    text = rows.select(formats.to_json(formats.document()).alias("j"), formats.to_xml(formats.document()).alias("x")).first()
    assert text.j == (
        '{"id":"r00000","deviceId":"d1","sensorType":"temperature","value":{"value":0.0,"unit":"unit"},'
        '"timestamp":"2024-01-01T00:00:00.000000Z","location":{"latitude":40.5,"longitude":-74.25},'
        '"metadata":{"k":"v"},"quality":"Warning","status":"Error"}'
    )
    assert text.x.startswith('<?xml version="1.0" encoding="utf-8"?><SensorData><id>r00000</id>')
    assert "\n" not in text.x


def test_absent_documents(spark):
    row = spark.range(1).select(
        formats.to_json(F.lit(None).cast(formats.DOCUMENT)).alias("j"),
        formats.to_xml(F.lit(None).cast(formats.DOCUMENT)).alias("x"),
        formats.from_json(F.lit("null")).alias("a"),
        formats.from_json(F.lit("")).alias("b"),
        formats.from_xml(F.lit("<null />")).alias("c"),
    ).first()
    assert (row.j, row.x, row.a, row.b, row.c) == ("null", "<null />", None, None, None)
    assert formats.serializer("text/plain").name == "json" and formats.serializer(None).name == "json"


LOG = """2025-06-02 15:06:32.298 -07:00 [INF] Channel Health Check - SensorData Queue: 1000, Anomaly Queue: 0
2025-06-02 15:07:32.308 -07:00 [INF] Channel Health Check - SensorData Queue: 10, Anomaly Queue: 150
2025-06-02 15:08:00.000 -07:00 [INF] Something else - WorkingSetMB: 9999
2025-06-02 15:10:33.343 -07:00 [INF] System Health Metrics - WorkingSetMB: 95.11, CPUUsagePercent: 3.36, AvailableMemoryMB: 45632, ThreadCount: 27
2025-06-02 15:15:33.343 -07:00 [INF] System Health Metrics - WorkingSetMB: 1200, CPUUsagePercent: 85, AvailableMemoryMB: 400, ThreadCount: 101"""


def test_log_alerts(spark, tmp_path):
    (tmp_path / "worker.txt").write_text(LOG)
    metrics = opslog.parse_ops_log(spark.read.text(str(tmp_path)))
    assert metrics.count() == 12
    backlog = opslog.backlog_alerts(metrics).collect()
    assert [(r.metric, r.value, r.threshold, r.ts) for r in backlog] == [
        ("Anomaly Queue", 150.0, 100.0, datetime(2025, 6, 2, 22, 7, 32, 308000))
    ]
    found = {(r.metric, r.value, r.threshold) for r in opslog.resource_alerts(metrics).collect()}
    assert found == {
        ("WorkingSetMB", 1200.0, 1000.0),
        ("CPUUsagePercent", 85.0, 80.0),
        ("AvailableMemoryMB", 400.0, 500.0),
        ("ThreadCount", 101.0, 100.0),
    }


def test_texts(spark):
    from sensorflow.functions import text
    from sensorflow.operators import rolling

    row = spark.createDataFrame([(1.5, "V", (1.0, 2.0, None), (1.0, 2.0, 3.0))], "v double, u string, a struct<latitude:double,longitude:double,altitude:double>, b struct<latitude:double,longitude:double,altitude:double>")
    got = row.select(
        text.value_text(F.col("v"), F.col("u")), text.location_text(F.col("a")), text.location_text(F.col("b"))
    ).first()
    assert tuple(got) == ("1.5 V", "1.0, 2.0", "1.0, 2.0 (3.0m)")
    values = [{"value": v} for v in (20.0, 20.0, 90.0, 40.0, 50.0)]
    found = rolling.rolling_anomalies(readings(spark, values)).orderBy("ts").collect()
    assert [r.description for r in found] == [
        "reading 90.0 lies outside [-40.0, 85.0]",
        "fall by 55.6% of the previous value",
    ]
