"""What the plans must look like to hold at scale."""

import contextlib
import io
from datetime import datetime

import pytest

from sensorflow.operators import lookups, rolling, views
from sensorflow.plans import catalogue, fixtures
from sensorflow.sources import store

STREAMS = {"rolling_anomalies_stream", "scored_stream", "ingest_stream"}


def plan(frame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("simple")
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - STREAMS))
def test_no_python_and_no_cross_join(name, spark, sf_dir):
    text = plan(catalogue.queries()[name](spark, sf_dir))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition, ENSURE"):
        if bad.startswith("SinglePartition") and name in {"count_readings", "batch_summary"}:
            continue
        assert bad not in text, text


def test_rolling_has_one_exchange(spark, sf_dir):
    text = plan(rolling.rolling_anomalies(fixtures.readings(spark, sf_dir)))
    assert text.count("Exchange") == 1
    assert "hashpartitioning(device_id" in text


def test_newest_is_limited_before_the_exchange(spark, sf_dir):
    for frame in (
        views.latest_readings(fixtures.readings(spark, sf_dir)),
        views.chart_series(fixtures.readings(spark, sf_dir)),
        lookups.current(fixtures.versions(spark, sf_dir)),
    ):
        text = plan(frame)
        assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_top_rows_are_taken_per_task(spark, sf_dir):
    for name in ("recent_anomalies", "recent_activity", "page_readings"):
        assert "TakeOrderedAndProject" in plan(catalogue.queries()[name](spark, sf_dir))


def test_filters_and_columns_reach_the_scan(spark, sf_dir, tmp_path):
    path = f"{tmp_path}/store"
    from pyspark.sql import functions as F

    rows = fixtures.readings(spark, sf_dir).withColumn("reading_id", F.col("reading_id").cast("string"))
    store.store_readings(rows, path)
    stored = store.open_readings(spark, path)
    found = lookups.by_device(stored, "dev_7", datetime(2024, 1, 5), datetime(2024, 1, 20))
    text = plan(found.select("reading_id", "value"))
    assert "EqualTo(device_id,dev_7)" in text and "GreaterThanOrEqual(ts" in text
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "ReadSchema: struct<reading_id:string,device_id:string,value:double,ts:timestamp>" in text
    history = plan(fixtures.history(spark, sf_dir).groupBy("sensor_type").count())
    assert "ReadSchema: struct<ts:timestamp,event_type:string>" in history
    assert "LessThan(ts,2024-01-24" in history
