"""Streams against batch: same findings, restarts, repeats and late rows."""

import itertools
from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F
from sensorflow.operators import messages as parsing
from sensorflow.operators import rolling
from sensorflow.plans import fixtures
from sensorflow.schemas import MESSAGES
from sensorflow.sources import readers, store
from sensorflow.sources.writers import TIMES
from sensorflow.streaming import continuous, rates
from sensorflow.streaming.ingest import good_rows, ingest_stream, once
from sensorflow.streaming.progress import ProgressMetrics, metric_rows
from sensorflow.streaming.rolling import changed_reports, judge_batch, rolling_query, tails_after

KEPT = ["reading_id", "type", "severity", "prev_value", "pct_change", "variance10"]


@pytest.fixture(scope="module")
def sent(spark, sf_dir):
    """The fixture messages in time order, as rows on the driver (a thousand)."""
    return fixtures.messages(spark, sf_dir).select(*MESSAGES.fieldNames()).orderBy("received_at").collect()


def deliver(spark, rows, folder, name):
    spark.createDataFrame(rows, MESSAGES).coalesce(1).write.options(**TIMES).json(f"{folder}/{name}")


def batch_findings(spark, rows):
    checked = ingest_stream(spark.createDataFrame(rows, MESSAGES))
    return rolling.rolling_anomalies(good_rows(checked))


def as_set(frame):
    return {tuple(r) for r in frame.select("reading_id", "type", F.round("severity", 9)).collect()}


@pytest.mark.parametrize("hot_rows", [2_000_000, 1], ids=["whole", "split"])
def test_batches_with_tails_equal_one_batch(spark, sf_dir, tmp_path, hot_rows):
    rows = fixtures.readings(spark, sf_dir)
    cuts = [datetime(2024, 1, 1), datetime(2024, 1, 8), datetime(2024, 1, 9), datetime(2024, 1, 25), datetime(2024, 3, 1)]
    tails, found = None, None
    for i, (low, high) in enumerate(itertools.pairwise(cuts)):
        part = rows.filter((F.col("ts") >= F.lit(low)) & (F.col("ts") < F.lit(high)))
        judged = judge_batch(part, tails, hot_rows)
        some, after = changed_reports(judged), tails_after(judged)
        found = some if found is None else found.unionByName(some)
        after.write.parquet(f"{tmp_path}/tails{i}")
        tails = spark.read.parquet(f"{tmp_path}/tails{i}")
    want = rolling.rolling_anomalies(rows).select(*KEPT)
    got = found.select(*KEPT)
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty()


def test_service_equals_batch_and_survives_restart(spark, sent, tmp_path):
    inbox, root, checkpoints = f"{tmp_path}/in", f"{tmp_path}/root", f"{tmp_path}/check"
    third = len(sent) // 3
    parts = [sent[:third], sent[third : 2 * third], sent[2 * third :]]
    for i, part in enumerate(parts):
        deliver(spark, part, inbox, f"part{i}")
        # Each round starts both queries anew from their checkpoints.
        stream = readers.message_stream(spark, f"{inbox}/*")
        running = [
            continuous.store_query(stream, root, checkpoints),
            continuous.detect_query(readers.message_stream(spark, f"{inbox}/*"), root, checkpoints),
        ]
        for query in running:
            query.awaitTermination()

    everything = spark.createDataFrame(sent, MESSAGES)
    checked = ingest_stream(everything)
    stored = store.open_readings(spark, f"{root}/readings")
    assert stored.count() == good_rows(checked).count()
    dead = spark.read.parquet(f"{root}/dead_letters")
    assert dead.count() == checked.filter(F.size("errors") > 0).count() > 0
    assert stored.count() + dead.count() == parsing.subscribed(everything).count()
    assert spark.read.parquet(f"{root}/routes").count() == 3 * stored.count()
    assert spark.read.parquet(f"{root}/envelopes").count() == stored.count()

    want = as_set(batch_findings(spark, sent))
    found = spark.read.parquet(f"{root}/anomalies")
    assert as_set(found) == want and len(want) > 100
    assert spark.read.parquet(f"{root}/anomaly_routes").count() == 3 * len(want)
    assert spark.read.parquet(f"{root}/anomaly_envelopes").filter("topic LIKE 'alerts/%/anomaly'").count() == len(want)


def test_repeats_and_late_rows_are_not_scored(spark, tmp_path):
    start = datetime(2024, 1, 1, 12)

    def message(minute, value):
        return ("sensors/d1/data", f"temperature:{value}", start + timedelta(minutes=minute))

    inbox, checkpoints = f"{tmp_path}/in", f"{tmp_path}/check"
    found = []

    def run(name, rows):
        deliver(spark, rows, inbox, name)
        readings = once(good_rows(ingest_stream(readers.message_stream(spark, f"{inbox}/*"))))
        rolling_query(
            readings, checkpoints, lambda some, n: found.extend((r.ts, r.type) for r in some.collect())
        ).awaitTermination()

    run("a", [message(0, 20), message(1, 20), message(40, 20)])
    run("b", [message(40, 20), message(2, 500), message(41, 20)])
    assert found == []
    run("c", [message(42, 90)])
    assert found == [(start + timedelta(minutes=42), "OutOfRange")]


def numbered(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("part-*.parquet")}


def test_a_bucket_of_tails_is_one_file_whatever_the_partitions(spark, sf_dir, tmp_path):
    rows = fixtures.readings(spark, sf_dir)
    rows.write.parquet(f"{tmp_path}/in")
    readings = once(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"))
    rolling_query(readings, f"{tmp_path}/check", lambda some, n: some.collect(), buckets=4).awaitTermination()
    files = numbered(tmp_path / "check/tails/rows")
    assert len(files) == len({path.rsplit("/", 1)[0] for path in files}) == 4


def test_late_row_is_scored_and_corrects_the_rows_behind_it(spark, tmp_path):
    """A late 95 degrees is found; the row after it becomes a drop, and a spike after a late equal value goes."""
    start = datetime(2024, 1, 1, 12)

    def message(device, second, value):
        return (f"sensors/{device}/data", f"temperature:{value}", start + timedelta(seconds=second))

    inbox, root, checkpoints = f"{tmp_path}/in", f"{tmp_path}/root", f"{tmp_path}/check"
    parts = [
        [message("d1", 10 * i, 20) for i in range(9)]
        + [message("d2", 10 * i, 10 if i < 5 else 40) for i in range(8)]
        + [message("d3", 10 * i, 20) for i in range(4)],
        [message("d1", 45, 95), message("d2", 45, 40)],
    ]
    before = None
    for i, part in enumerate(parts):
        deliver(spark, part, inbox, f"p{i}")
        continuous.detect_query(readers.message_stream(spark, f"{inbox}/*"), root, checkpoints).awaitTermination()
        if before is None:
            before = numbered(tmp_path / "check/detect/tails/rows")
    after = numbered(tmp_path / "check/detect/tails/rows")
    assert len(before) == 3 and before.items() <= after.items() and len(after) == 5

    want = as_set(batch_findings(spark, [row for part in parts for row in part]))
    held = continuous.open_anomalies(spark, root)
    assert as_set(held) == want
    assert {r.type for r in held.filter("device_id = 'd1'").collect()} >= {"OutOfRange", "SuddenDrop"}
    assert not spark.read.parquet(f"{root}/withdrawn").isEmpty()


def test_one_wrong_clock_does_not_silence_the_others(spark, tmp_path):
    start = datetime(2024, 1, 1, 12)
    inbox, root, checkpoints = f"{tmp_path}/in", f"{tmp_path}/root", f"{tmp_path}/check"
    body = '{"DeviceId":"d9","SensorType":"ph","Timestamp":"2030-01-01T00:00:00Z","Value":{"Value":7,"Unit":"pH"}}'
    rows = [("sensors/d1/data", f"temperature:{v}", start + timedelta(minutes=i)) for i, v in enumerate([50, 50, 50, 10])]
    for i, row in enumerate(rows):
        more = [("sensors/d9/data", body, start)] if i == 1 else []
        deliver(spark, [row, *more], inbox, f"p{i}")
        stream = readers.message_stream(spark, f"{inbox}/*")
        continuous.store_query(stream, root, checkpoints).awaitTermination()
        continuous.detect_query(stream, root, checkpoints).awaitTermination()
    assert [r.type for r in continuous.open_anomalies(spark, root).collect()] == ["SuddenDrop"]
    dead = spark.read.parquet(f"{root}/dead_letters").collect()
    assert [r.errors for r in dead] == [["ts must not be ahead of its arrival"]]


def test_copies_of_an_id_are_stored_once(spark, tmp_path):
    at = datetime(2024, 1, 1)
    body = '{"Id":"same","DeviceId":"d1","SensorType":"ph","Value":{"Value":%d,"Unit":"pH"}}'
    rows = [("sensors/d1/data", body % i, at + timedelta(seconds=i)) for i in range(50)]
    rows += [("sensors/d1/data", "{broken", at)] * 3
    checked = ingest_stream(spark.createDataFrame(rows, MESSAGES))
    continuous.store_batch(checked, 0, str(tmp_path))
    assert [r.value for r in spark.read.parquet(f"{tmp_path}/readings").collect()] == [49.0]
    assert spark.read.parquet(f"{tmp_path}/dead_letters").count() == 3


def test_rate_of_closed_windows_equals_batch(spark, sf_dir, tmp_path):
    from sensorflow.operators.rates import sliding_rate

    arriving = fixtures.as_readings(spark.readStream.schema(fixtures.EVENTS).parquet(f"{sf_dir}/events*.parquet"))
    query = (
        rates.reading_rate_stream(arriving)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{tmp_path}/check")
        .trigger(availableNow=True)
        .start(f"{tmp_path}/out")
    )
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    want = sliding_rate(fixtures.readings(spark, sf_dir)).select(*got.columns)
    assert got.count() > 0.95 * want.count()
    assert got.exceptAll(want).isEmpty()


def test_source_limits(spark, tmp_path):
    for i in range(3):
        deliver(spark, [("sensors/d/data", f"t:{i}", datetime(2024, 1, 1))], f"{tmp_path}/in", f"p{i}")
    sizes = []
    query = (
        readers.message_stream(spark, f"{tmp_path}/in/*", max_files=1)
        .writeStream.option("checkpointLocation", f"{tmp_path}/c")
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, n: sizes.append(batch.count()))
        .start()
    )
    query.awaitTermination()
    assert sizes == [1, 1, 1]


def test_progress_rows(spark, tmp_path):
    assert metric_rows("t", "q", {"a": 1, "b": None, "c": float("nan")}) == [("t", "q", "a", 1.0)]
    deliver(spark, [("sensors/d/data", "t:1", datetime(2024, 1, 1))], f"{tmp_path}/in", "p")
    seen = []
    listener = ProgressMetrics(seen.extend)
    spark.streams.addListener(listener)
    try:
        query = (
            readers.message_stream(spark, f"{tmp_path}/in/*")
            .writeStream.queryName("watched")
            .option("checkpointLocation", f"{tmp_path}/c")
            .trigger(availableNow=True)
            .format("noop")
            .start()
        )
        query.awaitTermination()
        for _ in range(50):
            if seen:
                break
            spark.sparkContext._jvm.java.lang.Thread.sleep(100)
    finally:
        spark.streams.removeListener(listener)
    assert ("watched", "InputRows", 1.0) in [row[1:] for row in seen]
