"""Hand-made cases of the rolling detector, expected values worked out from its rules."""

import math

import pytest
from rows import readings, series

from pyspark.sql import functions as F
from sensorflow.functions.limits import RollingLimit
from sensorflow.operators.rolling import rolling_anomalies, rolling_scores

NAN, INF = math.nan, math.inf

CASES = [
    ("temperature", [20, 90], None),
    ("temperature", [20, 20, 90], ("OutOfRange", 0.04)),
    ("temperature", [20, 20, 80, 20], ("SuddenDrop", 0.75)),
    ("humidity", [5, 5, -5], ("OutOfRange", 0.05)),
    ("vibration", [1, 0, 0], None),
    ("vibration", [1, 0, 5], ("SuddenSpike", 1.0)),
    ("vibration", [1, 0, -5], ("SuddenDrop", 1.0)),
    ("vibration", [1, 1, 2], None),
    ("vibration", [1, 1, 2.5], ("SuddenSpike", 1.0)),
    ("temperature", [21] * 10 + [21], ("FlatLine", 0.5)),
    ("temperature", [21] * 10 + [22], ("FlatLine", 0.5)),
    ("temperature", [21] * 9 + [21], None),
    ("temperature", [20, 21, NAN], None),
    ("temperature", [20, NAN, 21], None),
    ("vibration", [1, 1, INF], ("OutOfRange", 1.0)),
    ("temperature", [20, 20, INF], ("OutOfRange", 1.0)),
    ("temperature", [20, 20, -INF], ("OutOfRange", 1.0)),
    ("vibration", [1, INF, 1], None),
    ("Temperature", [20, 20, 90], ("OutOfRange", 0.04)),
    ("room_temperature", [20, 20, 90], ("SuddenSpike", 1.0)),
]


@pytest.mark.parametrize("hot_rows", [2_000_000, 1], ids=["whole", "split"])
def test_last_value(spark, hot_rows):
    rows = None
    for i, (kind, values, _) in enumerate(CASES):
        part = series(spark, kind, values, f"case{i}").withColumn("last", F.lit(len(values) - 1))
        part = part.filter(F.col("value").isNotNull())
        rows = part if rows is None else rows.unionByName(part)
    found = rolling_anomalies(rows.drop("last"), hot_rows=hot_rows).collect()
    for i, (_, values, expected) in enumerate(CASES):
        last = [r for r in found if r.device_id == f"case{i}" and r.reading_id == f"r{len(values) - 1:05d}"]
        if expected is None:
            assert last == [], CASES[i]
        else:
            assert [r.type for r in last] == [expected[0]], CASES[i]
            assert last[0].severity == pytest.approx(expected[1]), CASES[i]
            assert last[0].is_anomaly and last[0].description


def test_at_most_one_finding_and_severity_in_range(spark, sf_dir):
    from sensorflow.plans.fixtures import readings as fixture

    found = rolling_anomalies(fixture(spark, sf_dir))
    assert found.groupBy("reading_id").count().filter("count > 1").isEmpty()
    assert found.filter("severity < 0 OR severity > 1 OR isnan(severity)").isEmpty()


def test_short_history_never_flat(spark):
    rows = series(spark, "temperature", [21] * 15)
    assert rolling_anomalies(rows, history_size=9).isEmpty()
    assert rolling_anomalies(rows, history_size=10).count() == 5


def test_own_limits(spark):
    rows = series(spark, "co2", [400, 400, 5000])
    found = rolling_anomalies(rows, limits={"co2": RollingLimit(350.0, 4500.0, 2000.0, 0.0)}).collect()
    assert [(r.type, r.severity) for r in found] == [("OutOfRange", pytest.approx(500 / 4150))]


def test_rows_without_value_are_skipped(spark):
    rows = readings(spark, [{"value": 20.0}, {"value": None}, {"value": 20.0}, {"value": 90.0}])
    assert rolling_scores(rows).count() == 3
    assert [r.type for r in rolling_anomalies(rows).collect()] == ["OutOfRange"]
