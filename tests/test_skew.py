"""Hot channels, versions of one time, odd metadata and long payloads."""

import time

import pytest
from rows import START, readings

from pyspark.sql import functions as F
from sensorflow.functions import formats, payload
from sensorflow.operators import changes, routing
from sensorflow.plans import fixtures


def test_salted_channels_deliver_the_same(spark, sf_dir):
    routed = routing.route_readings(fixtures.readings(spark, sf_dir)).select("reading_id", "channel", "event")
    subscriptions = fixtures.subscriptions(spark, sf_dir)
    want = routing.deliveries(routed, subscriptions)
    salts = dict(routing.channel_salts(routed, 50))
    total = routed.filter("channel = 'all'").count()
    assert salts["all"] == -(-total // 50) and {c for c in salts if c.startswith("sensor_")} and routing.channel_salts(routed, 10**9) == []
    got = routing.deliveries(routed, subscriptions, 50).select(*want.columns)
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
    # no salt of a hot channel holds four times the median
    spread = routed.filter("channel = 'all'").groupBy(F.pmod(F.xxhash64("reading_id"), F.lit(salts["all"]))).count()
    sizes = sorted(r["count"] for r in spread.collect())
    assert sizes[-1] <= 4 * sizes[len(sizes) // 2]


def test_versions_of_one_time_have_ids_of_their_own(spark):
    items = [{"reading_id": "a", "value": float(v), "ts": START, "location": (1.0, 2.0, None)} for v in (3, 1, 2, 2)]
    versions = readings(spark, items).withColumn("updated_at", F.col("ts"))
    for hot_rows in (10**6, 1):
        events = changes.change_events(versions, hot_rows, metadata=F.create_map(F.lit("by"), F.lit("test"))).collect()
        assert len({e.event_id for e in events}) == len(events) == 8
        created = [e for e in events if e.event_type == "SensorDataCreated"]
        updated = sorted((e for e in events if e.event_type == "SensorValueUpdated"), key=lambda e: e.sequence)
        assert [(e.sequence, e.new_value) for e in created] == [(1, 1.0)]
        assert [(e.sequence, e.old_value, e.new_value) for e in updated] == [(2, 1.0, 2.0), (3, 2.0, 2.0), (4, 2.0, 3.0)]
        assert all(e.metadata == {"by": "test"} for e in events)


@pytest.mark.parametrize("content_type", ["application/json", "text/xml"])
def test_any_metadata_survives(spark, content_type):
    odd = [{"bat level": "3", "<a&b>": "x < y", "k": " sp ", "1": "2", 'q"': "\"'", "n": ""}, {}, {"only": "one"}]
    fmt = formats.serializer(content_type)
    rows = readings(spark, [{"metadata": m, "location": (1.5, None, 7.25)} for m in odd])
    back = rows.select("reading_id", fmt.read(fmt.write(formats.document())).alias("d")).orderBy("reading_id").collect()
    assert [r.d.metadata for r in back] == odd
    assert {tuple(r.d.location) for r in back} == {(1.5, None, 7.25)}


def test_pairs_are_parsed_in_one_pass(spark):
    texts = ["t:1," + ",".join(f"k{i % 7000}:v{i}" for i in range(10_000)), "t:1,a:1,b:2,a:3,bad, c : 4 ,:5,x:y:z", "t:1", "x"]
    rows = spark.createDataFrame([(t,) for t in texts], "p string").select(payload.parse_pairs(F.col("p")).alias("r"))
    rows.collect()
    began = time.perf_counter()
    long, some, one, none = rows.collect()
    assert time.perf_counter() - began < 5
    assert len(long.r.metadata) == 7000 and long.r.metadata["k1"] == "v7001" and long.r.metadata["k6999"] == "v6999"
    assert some.r.metadata == {"a": "3", "b": "2", "c": "4", "": "5"} and one.r.metadata == none.r.metadata == {}
