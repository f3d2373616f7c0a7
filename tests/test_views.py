"""Lookups, views, routes and change events on small frames."""

from datetime import datetime, timedelta

from rows import START, readings

from pyspark.sql import functions as F
from sensorflow.operators import anomalies, changes, detectors, lookups, rates, rolling, routing, views
from sensorflow.plans import fixtures


def ids(frame):
    return sorted(r.reading_id for r in frame.collect())


def test_range_ends_are_inclusive(spark):
    rows = readings(spark, [{} for _ in range(5)])
    minute = timedelta(minutes=1)
    assert ids(lookups.by_device(rows, "d1", START + minute, START + 3 * minute)) == ["r00001", "r00002", "r00003"]
    assert ids(lookups.by_device(rows, "d1", start=START + 4 * minute)) == ["r00004"]
    assert ids(lookups.by_type(rows, "Temperature")) == []


def test_single_and_count(spark):
    rows = readings(spark, [{"value": 1.0}, {"value": 2.0}, {"value": 2.0}])
    assert lookups.single(rows, "value = 1").count() == 1
    assert lookups.single(rows, "value = 2").count() == 2
    assert lookups.count(rows, F.col("value") > 5).first().asDict() == {"total": 3, "matching": 0, "any_match": False}


def test_pages_cover_everything_once(spark):
    rows = readings(spark, [{"value": float(i % 3)} for i in range(20)])
    seen = []
    for skip in range(0, 20, 7):
        seen += [r.reading_id for r in lookups.page(rows, "true", "value", skip=skip, take=7).collect()]
    assert len(seen) == 20 and len(set(seen)) == 20


def test_views_answer_sql(spark):
    rows = readings(spark, [{"value": 1.0}, {"value": 30.0}])
    lookups.register_views(spark, readings=rows)
    assert spark.sql("SELECT count(*) AS n FROM readings WHERE value > :low", {"low": 20}).first().n == 1
    spark.catalog.dropTempView("readings")


def test_deleted_rows_stay_out(spark):
    rows = readings(spark, [{} for _ in range(4)])
    gone = spark.createDataFrame([("r00001",), ("r00001",), ("zzz",)], "reading_id string")
    assert ids(lookups.live(rows, gone)) == ["r00000", "r00002", "r00003"]


def test_alert_is_held_for_a_while(spark):
    rows = readings(spark, [{"device_id": "a"}, {"device_id": "b"}])
    found = spark.createDataFrame([("a", "temperature", START)], "device_id string, sensor_type string, detected_at timestamp")

    def flagged(seconds):
        now = START + timedelta(minutes=1, seconds=seconds)
        got = views.latest_with_alert(rows, found, now, timedelta(seconds=65)).collect()
        return {r.device_id: r.has_alert for r in got}

    assert flagged(5) == {"a": True, "b": False}
    assert flagged(6) == {"a": False, "b": False}


def test_newest_per_takes_the_last(spark):
    rows = readings(spark, [{"value": float(i), "ts": START} for i in range(9)])
    assert ids(views.newest_per(rows, ["device_id"], 2)) == ["r00007", "r00008"]


def test_summary_without_high_values(spark):
    got = views.batch_summary(readings(spark, [{"value": 20.0}, {"value": float("nan")}])).collect()
    assert sorted((r["item"], r.n) for r in got) == [("filtered", 0), ("total", 2)]


def test_empty_input_keeps_the_schema(spark):
    empty = readings(spark, [])
    now = START
    for frame in (
        rolling.rolling_anomalies(empty),
        detectors.routed_anomalies(empty, empty, now),
        detectors.threshold_detector().detect(empty, empty, now),
        views.latest_readings(empty),
        views.sensor_profile(empty),
        rates.sliding_rate(empty),
        routing.route_readings(empty),
        changes.quality_transitions(empty),
    ):
        assert frame.columns and frame.isEmpty()


def test_sliding_rate(spark):
    rows = readings(spark, [{"ts": START + timedelta(seconds=s)} for s in (0, 59, 60, 200)])
    got = {r.window_start: (r.events, r.per_second) for r in rates.sliding_rate(rows).collect()}
    assert len(got) == 8
    assert got[START] == (4, 4 / 300)
    assert got[START - timedelta(minutes=4)] == (2, 2 / 300)
    assert got[START + timedelta(minutes=3)] == (1, 1 / 300)


def test_change_events(spark):
    def version(i, **fields):
        return {"reading_id": "x", "ts": START + timedelta(minutes=i)} | fields

    rows = readings(
        spark,
        [
            version(0, value=5.0, quality="Good", status="Active", location=(1.0, 2.0, None)),
            version(1, value=5.0, quality="Good", status="Error"),
            version(2, value=5.0, quality="Warning", status="Active"),
        ],
    ).withColumn("updated_at", F.col("ts"))
    for hot in (2_000_000, 1):
        got = changes.change_events(rows, hot_rows=hot).orderBy("occurred_on", "event_type").collect()
        assert [r.event_type for r in got] == [
            "SensorDataCreated",
            "SensorLocationUpdated",
            "SensorStatusChanged",
            "SensorValueUpdated",
            "SensorQualityChanged",
            "SensorStatusChanged",
            "SensorValueUpdated",
        ]
        value = [r for r in got if r.event_type == "SensorValueUpdated"]
        assert [(r.old_value, r.new_value) for r in value] == [(5.0, 5.0), (5.0, 5.0)]
        status = [(r.old_status, r.new_status) for r in got if r.event_type == "SensorStatusChanged"]
        assert status == [("Active", "Error"), ("Error", "Active")]
        assert len({r.event_id for r in got}) == len(got)


def test_three_routes_per_row(spark, sf_dir):
    rows = fixtures.readings(spark, sf_dir)
    assert routing.route_readings(rows).count() == 3 * rows.count()
    found = anomalies.as_anomalies(rolling.rolling_anomalies(rows))
    routed = routing.route_anomalies(found)
    assert routed.count() == 3 * found.count()
    assert routed.filter("channel = 'alerts'").count() == found.count()


def test_deliveries_do_not_depend_on_salts(spark, sf_dir):
    rows = fixtures.readings(spark, sf_dir)
    routed = routing.route_readings(rows).select("reading_id", "channel", "event")
    readers = fixtures.subscriptions(spark, sf_dir).unionByName(
        spark.createDataFrame([("all", "s1"), ("all", "s2")], "channel string, subscriber string")
    )
    plain = routed.join(readers, "channel")
    for salts in (1, 5, 64):
        got = routing.deliveries(routed, readers, salts)
        assert got.exceptAll(plain.select(*got.columns)).isEmpty()
        assert got.count() == plain.count()


def test_compatible_detectors(spark):
    rows = readings(spark, [{"sensor_type": "Air_Flow"}, {"sensor_type": "door"}])
    got = {(r.sensor_type, r.detector) for r in detectors.compatible_detectors(rows).collect()}
    assert got == {
        ("Air_Flow", "statistical"),
        ("Air_Flow", "timeseries"),
        ("Air_Flow", "threshold"),
        ("door", "statistical"),
        ("door", "threshold"),
    }


def test_recent_anomalies_percent(spark):
    rows = spark.createDataFrame(
        [(f"r{i}", datetime(2024, 1, 1, 0, i), i / 16) for i in range(12)],
        "reading_id string, detected_at timestamp, severity double",
    )
    got = views.recent_anomalies(rows).collect()
    assert [r.reading_id for r in got] == [f"r{i}" for i in range(11, 1, -1)]
    assert [r.severity_percent for r in got][:3] == [69, 63, 56]
