"""Profile detectors: hand-made cases and checks against plain loops."""

import math
import random
from datetime import datetime, timedelta

import pytest
from rows import readings, series

from pyspark.sql import functions as F
from sensorflow.functions.limits import Bounds
from sensorflow.operators import anomalies, detectors, quartiles, trend

AS_OF = datetime(2024, 1, 1, 2)


def one(frame):
    rows = frame.collect()
    return [(r.type, round(r.severity, 6)) for r in rows]


def value_of(spark, sensor_type, value):
    return readings(spark, [{"sensor_type": sensor_type, "value": float(value)}])


@pytest.mark.parametrize(
    "kind,value,expected",
    [
        ("temperature", -50, [("SuddenDrop", 0.25)]),
        ("temperature", 100, [("SuddenSpike", 0.25)]),
        ("Temperature", 100, [("SuddenSpike", 0.25)]),
        ("humidity", -5, [("SuddenDrop", 1.0)]),
        ("humidity", 110, [("SuddenSpike", 0.1)]),
        ("pressure", 700, [("SuddenDrop", 0.125)]),
        ("pressure", 1300, [("SuddenSpike", 0.083333)]),
        ("co2", 300, [("SuddenDrop", 0.142857)]),
        ("ph", 15, [("SuddenSpike", 0.071429)]),
        ("temperature", 20, []),
        ("temperature", math.nan, []),
        ("room_temperature", 500, []),
    ],
)
def test_fixed_bounds(spark, kind, value, expected):
    rows = value_of(spark, kind, value)
    assert one(detectors.bounds_detector().detect(rows, rows, AS_OF)) == expected


def test_unknown_type_goes_to_quartiles(spark):
    history = series(spark, "room_temperature", range(1, 11))
    found = detectors.threshold_detector().detect(value_of(spark, "room_temperature", 500), history, AS_OF).collect()
    assert [(r.type, r.severity, r.method) for r in found] == [("SuddenSpike", 0.8, "ThresholdAnomalyDetection_Dynamic")]


def test_own_bounds(spark):
    own = detectors.bounds_detector({"flow": Bounds(0.0, 2.0)})
    rows = value_of(spark, "flow", 3)
    assert one(own.detect(rows, rows, AS_OF)) == [("SuddenSpike", 0.5)]


@pytest.mark.parametrize(
    "history,value,expected",
    [
        (range(1, 11), 13, [("SuddenSpike", 1.0)]),
        (range(1, 11), 12, []),
        (range(1, 11), -2, [("SuddenDrop", 1.0)]),
        (range(1, 11), math.nan, []),
        (range(1, 10), 13, [("NetworkTimeout", 0.0)]),
        ([5] * 10, 50, [("FlatLine", 0.0)]),
        ([*range(1, 11), math.nan], 13, [("SuddenSpike", 1.0)]),
    ],
)
def test_zscore(spark, history, value, expected):
    found = detectors.zscore_detector().detect(value_of(spark, "x", value), series(spark, "x", history), AS_OF)
    assert one(found) == expected


def test_zscore_numbers_and_sensitivity(spark):
    history, row = series(spark, "x", range(1, 11)), value_of(spark, "x", 12)
    assert one(detectors.zscore_detector(2.0).detect(row, history, AS_OF)) == [("SuddenSpike", 1.0)]
    r = detectors.zscore_detector().detect(value_of(spark, "x", 13), history, AS_OF).first()
    assert (round(r.z_score, 6), r.mean, round(r.std_dev, 6), r.history_count) == (2.611165, 5.5, 2.872281, 10)


@pytest.mark.parametrize(
    "n,value,expected",
    [
        (10, 16, [("SuddenSpike", 0.8)]),
        (10, -5, [("SuddenDrop", 0.8)]),
        (10, 15.5, [("OutOfRange", 0.0)]),
        (10, math.nan, [("OutOfRange", 0.0)]),
        (9, 16, [("NetworkTimeout", 0.0)]),
    ],
)
def test_quartile_bounds(spark, n, value, expected):
    history = series(spark, "x", range(1, n + 1))
    found = detectors.iqr_detector().detect(value_of(spark, "x", value), history, AS_OF)
    assert one(found) == expected
    r = found.first()
    assert r.is_anomaly == (r.severity > 0)
    if n == 10:
        assert (r.q1, r.q3, r.iqr, r.lower, r.upper) == (3.0, 8.0, 5.0, -4.5, 15.5)


@pytest.mark.parametrize(
    "history,value,expected",
    [
        ([10, 10, 10, 10, 20], 20, [("SuddenSpike", 1.0)]),
        ([10, 10, 10, 10, 20], 18, []),
        ([10, 10, 10, 10, 20], 10, [("SuddenDrop", 1.0)]),
        ([10, 10, 10, 20], 20, [("NetworkTimeout", 0.0)]),
        ([10, 10, 10, 10, 20], math.nan, []),
    ],
)
def test_trend(spark, history, value, expected):
    found = detectors.trend_detector().detect(value_of(spark, "x", value), series(spark, "x", history), AS_OF)
    assert one(found) == expected


def test_trend_numbers(spark):
    r = detectors.trend_detector().detect(
        value_of(spark, "x", 20), series(spark, "x", [10, 10, 10, 10, 20]), AS_OF
    ).first()
    assert (round(r.ema, 9), round(r.trend, 9), round(r.expected, 9)) == (13.0, 2.0, 15.0)
    assert round(r.deviation, 6) == 0.333333


def test_average_equals_the_fold(spark):
    rng = random.Random(7)
    values = [rng.uniform(-50, 50) for _ in range(700)]
    rows = readings(spark, [{"value": v} for v in values], step=timedelta(seconds=7))
    fold = values[0]
    for v in values[1:]:
        fold = 0.3 * v + 0.7 * fold
    got = trend.moving_average(rows, "sensor_type", AS_OF, timedelta(hours=24)).first()
    assert got.history_count == 700
    assert got.ema == pytest.approx(fold, rel=1e-12)


def test_quantiles_by_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    groups = {
        "wide": [rng.uniform(-1e6, 1e6) for _ in range(3000)],
        "few": [float(rng.randint(0, 3)) for _ in range(3000)],
        "tail": [10 ** rng.uniform(-9, 9) for _ in range(2500)],
        "one": [4.0],
        "two": [4.0, 2.0],
    }
    items = [{"sensor_type": k, "value": v} for k, vs in groups.items() for v in vs]
    rng.shuffle(items)
    rows = readings(spark, items)
    wanted = {"q1": 0.25, "mid": 0.5, "q3": 0.75}
    # A coarse sketch and a thin margin make brackets wrong; the answer must not change.
    for size, margin in ((2048, 0.006), (8, 0.0)):
        monkeypatch.setattr(quartiles, "SKETCH_SIZE", size)
        monkeypatch.setattr(quartiles, "MARGIN", margin)
        got = quartiles.index_quantiles(rows, "sensor_type", "value", wanted).collect()
        assert len(got) == len(groups)
        for r in got:
            ordered = sorted(groups[r.sensor_type])
            assert r.n == len(ordered)
            for name, f in wanted.items():
                assert r[name] == ordered[int(f * len(ordered))], (r.sensor_type, name, size)


def test_missed_brackets_are_searched_again(spark, monkeypatch):
    rows = readings(spark, [{"sensor_type": "x", "value": float(v)} for v in range(100)])
    wrong = F.array(*[F.lit(90.0)] * 4).alias("_edges")
    monkeypatch.setattr(quartiles, "brackets", lambda clean, key, _: clean.select(key, wrong).distinct())
    got = quartiles.index_quantiles(rows, "sensor_type", "value", {"q1": 0.25, "q3": 0.75}).first()
    assert (got.n, got.q1, got.q3) == (100, 25.0, 75.0)


def test_routes_and_names(spark):
    kinds = ["room_Temperature", "door", "motion", "light_switch", "flow", "switch_pressure"]
    rows = readings(spark, [{"sensor_type": k} for k in kinds])
    got = {r[0]: r[1] for r in rows.select("sensor_type", detectors.route(F.col("sensor_type"))).collect()}
    assert got == {
        "room_Temperature": "timeseries",
        "door": "threshold",
        "motion": "threshold",
        "light_switch": "threshold",
        "flow": "statistical",
        "switch_pressure": "timeseries",
    }
    assert detectors.detector("TimeSeries").name == "timeseries"
    assert detectors.detector("nothing").name == "statistical"


def test_routed_uses_each_detector(spark):
    history = readings(
        spark,
        [{"sensor_type": k, "value": float(v)} for k in ("temperature", "door", "flow") for v in range(1, 11)],
    )
    rows = readings(spark, [{"sensor_type": k, "value": 100.0} for k in ("temperature", "door", "flow", "new")])
    found = {r.sensor_type: (r.detector, r.type) for r in detectors.routed_anomalies(rows, history, AS_OF).collect()}
    assert found == {
        "temperature": ("timeseries", "SuddenSpike"),
        "door": ("threshold", "SuddenSpike"),
        "flow": ("statistical", "SuddenSpike"),
        "new": ("statistical", "NetworkTimeout"),
    }


def test_grades(spark):
    severities = [1.0, 0.8, 0.79, 0.6, 0.4, 0.2, 0.19]
    rows = spark.createDataFrame([(s,) for s in severities], "severity double")
    got = [r.level for r in anomalies.triage(rows).collect()]
    assert got == ["critical", "critical", "high", "high", "medium", "low", "none"]
