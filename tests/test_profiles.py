"""Profiles from day states against one scan of all rows; alerts held on streams against the batch join."""

import math
from datetime import timedelta

import pytest
from rows import START, readings

from pyspark.sql import functions as F
from sensorflow.operators import detectors, profiles, views
from sensorflow.plans import fixtures


def dated(rows):
    return rows.withColumn("event_date", F.to_date("ts"))


def close(got, want):
    a, b = ({r.sensor_type: r for r in frame.collect()} for frame in (got, want))
    assert a.keys() == b.keys()
    for kind, row in a.items():
        for name in ("n", "mean", "variance", "std_dev", "lowest", "highest"):
            assert math.isclose(row[name], b[kind][name], rel_tol=1e-9, abs_tol=1e-9), (kind, name)


def test_merged_states_equal_one_scan(spark, sf_dir, tmp_path):
    rows = dated(fixtures.readings(spark, sf_dir)).persist()
    days = sorted(r.event_date for r in rows.select("event_date").distinct().collect())
    path = f"{tmp_path}/states"
    profiles.refresh(rows, path, days[:10])
    profiles.refresh(rows, path, days[10:])
    close(profiles.profile(spark, path), views.sensor_profile(rows))
    span = rows.filter(F.col("event_date").between(days[3], days[12]))
    close(profiles.profile(spark, path, days[3], days[12]), views.sensor_profile(span))
    # a corrected day, and one that is empty now
    changed = rows.filter(F.col("event_date") != days[5]).withColumn("value", F.when(F.col("event_date") == days[4], 1.0).otherwise(F.col("value")))
    profiles.refresh(changed, path, days[4:6])
    close(profiles.profile(spark, path), views.sensor_profile(changed))
    rows.unpersist()


def test_a_new_day_reads_that_day_alone(spark, tmp_path):
    """All other days' files are spoilt, so reading one of them would fail."""
    rows = dated(readings(spark, [{"value": float(i)} for i in range(9)], step=timedelta(hours=8)))
    rows.write.partitionBy("event_date").parquet(f"{tmp_path}/rows")
    last = (START + timedelta(days=2)).date()
    for file in (tmp_path / "rows").rglob("*.parquet"):
        if str(last) not in str(file):
            file.write_bytes(b"spoilt")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    stored = spark.read.schema(rows.schema).parquet(f"{tmp_path}/rows")
    profiles.refresh(stored, f"{tmp_path}/states", [last])
    (row,) = profiles.profile(spark, f"{tmp_path}/states").collect()
    assert (row.n, row.mean, row.lowest, row.highest) == (3, 7.0, 6.0, 8.0)


def test_odd_values(spark, tmp_path):
    items = [{"value": v, "sensor_type": t} for t, v in [("flat", 0.1)] * 9 + [("one", 5.0), ("nan", float("nan")), ("none", None)]]
    rows = dated(readings(spark, items, step=timedelta(hours=11)))
    days = [r.event_date for r in rows.select("event_date").distinct().collect()]
    profiles.refresh(rows, f"{tmp_path}/s", days)
    got = {r.sensor_type: r for r in profiles.profile(spark, f"{tmp_path}/s").collect()}
    assert set(got) == {"flat", "one"} and got["flat"].std_dev == 0.0 and got["one"].variance == 0.0
    assert profiles.profile(spark, f"{tmp_path}/nothing").isEmpty()


def test_detector_with_stored_profiles(spark, sf_dir, tmp_path):
    history = dated(fixtures.history(spark, sf_dir))
    days = [r.event_date for r in history.select("event_date").distinct().collect()]
    profiles.refresh(history, f"{tmp_path}/s", days)
    detector = detectors.zscore_detector()
    scored = fixtures.scored(spark, sf_dir)
    want = detector.detect(scored, history, fixtures.AS_OF).select("reading_id", "type")
    known = profiles.as_zscore(profiles.profile(spark, f"{tmp_path}/s"))
    got = detector.score(scored.join(F.broadcast(known), "sensor_type", "left")).select("reading_id", "type")
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()


@pytest.mark.parametrize("files", [1, 3])
def test_alerts_are_held_on_streams_as_in_batch(spark, tmp_path, files):
    rows = readings(spark, [{"device_id": f"d{i % 2}", "sensor_type": ["a", "b"][i % 3 == 0]} for i in range(60)], step=timedelta(minutes=20))
    found = rows.filter("value >= 0 AND cast(substr(reading_id, 2) AS int) % 7 = 0").withColumn("detected_at", F.col("ts"))
    hold = timedelta(hours=2)
    want = views.readings_on_alert(rows, found, hold).select("reading_id", "alert_id", "alerted_at")
    for name, frame in (("rows", rows), ("found", found)):
        ordered = frame.orderBy("ts").collect()
        step = -(-len(ordered) // files)
        for n in range(files):
            spark.createDataFrame(ordered[n * step : (n + 1) * step], frame.schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    streams = [spark.readStream.schema(f.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{n}") for n, f in (("rows", rows), ("found", found))]
    held = views.readings_on_alert(*streams, hold, "1 day").select("reading_id", "alert_id", "alerted_at")
    query = held.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out")
    query.awaitTermination()
    got = spark.read.schema(want.schema).parquet(f"{tmp_path}/out")
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
