"""Cleaning, enrichment, validation: hand-made cases and properties."""

import math
from datetime import timedelta

import pytest
from rows import START, readings

from pyspark.sql import functions as F
from sensorflow.operators import transform, validate
from sensorflow.plans import fixtures


@pytest.mark.parametrize(
    "kind,value,expected",
    [
        ("temperature", 200.0, 150.0),
        ("temperature", math.nan, 25.0),
        ("temperature", 1.015, 1.01),
        ("Room_Temperature", -500.0, -100.0),
        ("humidity", 55.25, 55.2),
        ("humidity", math.inf, 50.0),
        ("humidity", -math.inf, 50.0),
        ("pressure", 2500.0, 2000.0),
        ("phase_voltage", 230.0, 14.0),
        ("voltage", 1.23456, 1.235),
        ("current", -1000.0, -100.0),
        ("vibration", math.nan, math.nan),
        ("vibration", math.inf, math.inf),
        ("vibration", 0.125, 0.12),
        ("vibration", 3e17, 3e17),
        ("vibration", None, None),
    ],
)
def test_cleaned_value(spark, kind, value, expected):
    got = transform.clean(readings(spark, [{"sensor_type": kind, "value": value}])).first().value
    if expected is not None and math.isnan(expected):
        assert math.isnan(got)
    else:
        assert got == expected


def test_cleaning_is_idempotent(spark, sf_dir):
    once = transform.clean(fixtures.readings(spark, sf_dir))
    twice = transform.clean(once).select("reading_id", F.col("value").alias("again"))
    assert once.join(twice, "reading_id").filter(~F.col("value").eqNullSafe(F.col("again"))).isEmpty()


@pytest.mark.parametrize(
    "kind,value,minutes,score,level",
    [
        ("temperature", 20.0, 0, 1.0, "Excellent"),
        ("temperature", 120.0, 0, 0.8, "Good"),
        ("temperature", 20.0, 15, 0.9, "Excellent"),
        ("temperature", 20.0, 61, 0.7, "Good"),
        ("temperature", 120.0, 61, 0.5, "Fair"),
        ("temperature", math.nan, 0, 0.3, "Poor"),
        ("temperature", math.nan, 15, 0.2, "Critical"),
        ("vibration", math.nan, 0, 0.5, "Fair"),
        ("temperature", math.nan, 61, 0.0, "Critical"),
        ("temperature", 20.0, 10, 1.0, "Excellent"),
        ("temperature", 20.0, 60, 0.9, "Excellent"),
    ],
)
def test_quality(spark, kind, value, minutes, score, level):
    rows = readings(spark, [{"sensor_type": kind, "value": value}])
    got = transform.enrich(rows, START + timedelta(minutes=minutes)).first()
    assert got.quality_score == pytest.approx(score, abs=1e-9)
    assert got.quality_level == level


def test_fresh_is_under_five_minutes(spark):
    rows = readings(spark, [{"value": 1.0}])
    assert transform.enrich(rows, START + timedelta(minutes=4, seconds=59)).first().is_fresh
    assert not transform.enrich(rows, START + timedelta(minutes=5)).first().is_fresh


def test_conversions_and_calendar(spark):
    rows = readings(
        spark,
        [
            {"sensor_type": "Temperature", "value": 100.0, "unit": "Celsius"},
            {"sensor_type": "pressure", "value": 1000.0, "unit": "hPa"},
            {"sensor_type": "temperature", "value": 100.0, "unit": "°C"},
            {"sensor_type": "temperature", "value": None, "unit": "celsius"},
        ],
    )
    hot, high, other, empty = transform.enrich(rows, START).orderBy("reading_id").collect()
    assert (hot.temperature_f, hot.temperature_k) == (212.0, 373.15)
    assert (high.pressure_psi, high.pressure_inhg) == (14.5038, pytest.approx(29.53))
    assert other.temperature_f is None and high.temperature_f is None
    assert (hot.hour_of_day, hot.day_of_week, hot.is_weekend) == (0, "Monday", False)
    assert empty.quality_score is None and empty.day_of_week is None


def test_trace_follows_priority_and_guard(spark):
    rows = readings(spark, [{"value": 200.0, "unit": "celsius"}, {"value": None}])
    steps = [transform.enrichment_step(START), transform.cleaning_step()]
    got = transform.processing_trace(rows, steps).orderBy("reading_id", "priority").collect()
    assert [(r.reading_id, r.step, r.value_before, r.value_after) for r in got] == [
        ("r00000", "DataCleaning", 200.0, 150.0),
        ("r00000", "DataEnrichment", 150.0, 150.0),
        ("r00001", "DataEnrichment", None, None),
    ]
    assert transform.processing_step("DATAENRICHMENT", START).name == "DataEnrichment"
    assert transform.processing_step("other", START).name == "DataCleaning"


def test_rules_in_order(spark):
    rows = readings(
        spark,
        [
            {"device_id": "", "sensor_type": None, "unit": None, "location": (91.0, -181.0, None)},
            {"location": (math.nan, 0.0, None)},
            {"location": (90.0, 180.0, 5.0)},
        ],
    )
    first, second, third = validate.with_errors(rows).orderBy("reading_id").collect()
    assert first.errors == [r.name for r in validate.default_rules()]
    assert second.errors == [] and third.errors == []


def test_own_rule(spark):
    rows = readings(spark, [{"value": 5.0}, {"value": -5.0}])
    rules = [*validate.default_rules(), validate.Rule("value must be positive", 0, F.col("value") <= 0)]
    checked = validate.with_errors(rows, rules)
    assert [r.errors for r in validate.dead(checked).collect()] == [["value must be positive"]]


def test_warnings_do_not_reject(spark):
    rules = [validate.Rule("value is high", 1, F.col("value") > 10, warning=True)]
    checked = validate.with_errors(readings(spark, [{"value": 50.0}]), rules)
    assert checked.first().warnings == ["value is high"]
    assert validate.valid(checked).count() == 1


def test_nothing_is_lost(spark, sf_dir):
    rows = fixtures.dirty_readings(spark, sf_dir)
    checked = validate.with_errors(rows)
    assert validate.valid(checked).count() + validate.dead(checked).count() == rows.count()
    assert "processed_at" in validate.valid(checked).columns
