"""Results do not depend on partitions or on how hot a series counts as."""

import random
from datetime import timedelta

import pytest
from rows import START, readings

from pyspark.sql import functions as F
from sensorflow.operators import changes, detectors, rolling, series
from sensorflow.operators.joins import attach, settle
from sensorflow.plans import fixtures
from sensorflow.schemas import READINGS

KEPT = ["reading_id", "type", "severity", "prev_value", "pct_change", "variance10"]


@pytest.fixture(scope="module")
def skewed(spark):
    """One device holds a third of all rows, with a burst and equal times; many devices share the rest."""
    rng = random.Random(11)
    items = []
    for i in range(6000):
        hot = i % 3 == 0
        second = 40_000 + i // 50 if 2000 < i < 4000 else i * 10
        items.append(
            {
                "device_id": "hot" if hot else f"d{rng.randrange(400)}",
                "sensor_type": rng.choice(["temperature", "vibration"]),
                "value": float(rng.choice([20, 20, 21, 90, 0, 22])),
                "quality": rng.choice(["Good", "Good", "Warning"]),
                "ts": START + timedelta(seconds=second),
            }
        )
    rng.shuffle(items)
    return readings(spark, items).repartition(8, "reading_id")


def test_split_series_equal_whole_ones(spark, skewed):
    want = rolling.rolling_anomalies(skewed).select(*KEPT)
    assert want.count() > 1000
    for hot_rows in (1, 3, 20, 500):
        got = rolling.rolling_anomalies(skewed, hot_rows=hot_rows).select(*KEPT)
        assert got.count() == want.count()
        assert got.exceptAll(want).isEmpty(), hot_rows


def test_split_quality_transitions(spark, skewed):
    want = changes.quality_transitions(skewed)
    for hot_rows in (1, 50):
        got = changes.quality_transitions(skewed, hot_rows=hot_rows).select(*want.columns)
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_one_id_with_many_versions(spark):
    items = [{"reading_id": "same", "value": float(i), "status": "Active"} for i in range(500)]
    items += [{"reading_id": f"r{i}", "value": 1.0} for i in range(500)]
    versions = readings(spark, items).withColumn("updated_at", F.col("ts"))
    want = changes.change_events(versions).drop("metadata")
    got = changes.change_events(versions, hot_rows=10).drop("metadata")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    assert want.filter("event_type = 'SensorValueUpdated'").count() == 499


def test_partition_counts(spark, sf_dir):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = set()
    try:
        for partitions in (1, 4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
            rows = fixtures.readings(spark, sf_dir).repartition(partitions)
            routed = detectors.routed_anomalies(
                fixtures.scored(spark, sf_dir).repartition(partitions), fixtures.history(spark, sf_dir), fixtures.AS_OF
            )
            totals = F.count("*").alias("n"), F.sum("reading_id").alias("ids")
            seen.add((rolling.rolling_anomalies(rows).agg(*totals).first(), routed.agg(*totals).first()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(seen) == 1 and seen.pop()[0].n == 361


def test_large_profiles_join_without_broadcast(spark, monkeypatch):
    from sensorflow.operators import joins

    rows = readings(spark, [{"sensor_type": f"t{i % 7}", "value": float(i)} for i in range(70)])
    profile = settle(rows.groupBy("sensor_type").agg(F.count("*").alias("n")))
    small = attach(rows, profile, "sensor_type")
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 3)
    large = attach(rows, profile, "sensor_type")
    columns = [c for c in READINGS.fieldNames() if c != "metadata"] + ["n"]
    assert large.select(columns).exceptAll(small.select(columns)).isEmpty()
    assert large.count() == 70


@pytest.mark.parametrize("stray", ["1970-01-01", "2030-01-01", None])
def test_chunks_are_even_whatever_the_clocks_say(spark, stray):
    """Chunks hold at most twice the limit, with a stray clock and with many rows of one time."""
    at = "timestampadd(SECOND, cast(if(id < 5000, 7, id) as int), timestamp'2024-01-01')"
    if stray:
        at = f"if(id = 0, timestamp'{stray}', {at})"
    rows = spark.range(50_000).selectExpr("'d1' AS device_id", "'temperature' AS sensor_type", f"{at} AS ts", "id AS reading_id", "cast(pmod(hash(id), 60) AS double) AS value")
    keys = ["device_id", "sensor_type"]
    order = ["ts", "reading_id"]
    levels = series.hot_cuts(rows, keys, order, 2000)
    chunks = series.chunked(rows.withColumn("_bucket", series._bucket(keys)), levels, order)
    sizes = chunks.groupBy("_chunk").agg(F.count("*").alias("n")).collect()
    assert sum(r.n for r in sizes) == 50_000
    assert max(r.n for r in sizes) <= 4000
    want = rolling.rolling_anomalies(rows).select(*KEPT)
    got = rolling.rolling_anomalies(rows, hot_rows=2000).select(*KEPT)
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_a_series_of_one_single_time_is_cut_by_its_ids(spark, kind):
    rows = spark.range(200_000).selectExpr(
        "'d1' AS device_id", "'temperature' AS sensor_type", "timestamp'2024-01-01' AS ts",
        f"cast({'id' if kind == 'bigint' else 'concat(chr(97 + cast(id % 26 as int)), id)'} AS {kind}) AS reading_id", "cast(pmod(hash(id), 60) AS double) AS value",
    )
    rows = rows.withColumn("ts", F.when(F.xxhash64("reading_id") % 50 != 0, F.col("ts")))  # and some without a time
    keys, order, limit = ["device_id", "sensor_type"], ["ts", "reading_id"], 10_000
    levels = series.hot_cuts(rows, keys, order, limit)
    chunks = series.chunked(rows.withColumn("_bucket", series._bucket(keys)), levels, order)
    sizes = [r["count"] for r in chunks.groupBy("_chunk").count().collect()]
    assert sum(sizes) == 200_000 and max(sizes) <= 2 * limit
    want = rolling.rolling_anomalies(rows).select(*KEPT)
    got = rolling.rolling_anomalies(rows, hot_rows=limit).select(*KEPT)
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()


def test_numbers_along_split_series(spark, skewed):
    items = [{"reading_id": "same", "value": float(i % 7), "ts": START} for i in range(300)]
    rows = skewed.unionByName(readings(spark, items)).withColumn("device_id", F.when(F.col("device_id") != "d7", F.col("device_id")))
    keys, order = ["device_id", "sensor_type"], ["ts", "reading_id", "value"]
    want = series.numbered(rows, keys, order, "n").select("reading_id", "value", *keys, "n")
    for hot_rows in (1, 40, 500):
        got = series.numbered(rows, keys, order, "n", hot_rows).select(*want.columns)
        assert got.count() == want.count() == 6300 and got.exceptAll(want).isEmpty(), hot_rows
