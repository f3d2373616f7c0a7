"""Files there and back, URIs, Kafka options, the store."""

from datetime import datetime, timedelta

import pytest
from rows import START, readings

from pyspark.sql import functions as F
from sensorflow import session
from sensorflow.schemas import READINGS
from sensorflow.sources import readers, store, uris, writers


def sample(spark):
    return readings(
        spark,
        [
            {"location": (1.5, 2.5, None), "metadata": {"a": "1", "b": "x,y"}, "unit": '"quoted", text'},
            {"value": None, "ts": datetime(2024, 3, 4, 5, 6, 7, 890123)},
            {"value": 0.1 + 0.2},
        ],
    )


@pytest.mark.parametrize("extension", ["json", "csv"])
def test_round_trip(spark, tmp_path, extension):
    path = f"{tmp_path}/out.{extension}"
    rows = sample(spark)
    writers.open_sink(rows, path)
    writers.open_sink(rows, path)
    back = readers.open_source(spark, path)
    assert back.schema.simpleString() == READINGS.simpleString()
    want = [r.asDict(True) | {"metadata": r.metadata} for r in rows.orderBy("reading_id").collect()]
    assert [r.asDict(True) for r in back.orderBy("reading_id").collect()] == want


def test_text_round_trip(spark, tmp_path):
    path = f"{tmp_path}/out.log"
    rows = sample(spark)
    writers.open_sink(rows, path)
    lines = readers.open_source(spark, path)
    assert lines.columns == ["value"]
    back = lines.select(F.from_json("value", READINGS).alias("r")).select("r.*")
    columns = ["reading_id", "value", "ts", "location"]
    assert back.select(columns).orderBy("reading_id").collect() == rows.select(columns).orderBy("reading_id").collect()


def test_generic_formats(spark, tmp_path):
    rows = sample(spark)
    rows.write.format("parquet").mode("overwrite").save(f"{tmp_path}/p")
    assert spark.read.load(f"{tmp_path}/p").count() == 3
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        rows.write.save(f"{tmp_path}/p")


def test_empty_file_source(spark, tmp_path):
    writers.open_sink(readings(spark, []), f"{tmp_path}/none.json")
    back = readers.open_source(spark, f"{tmp_path}/none.json")
    assert back.columns == READINGS.fieldNames() and back.isEmpty()


def test_uris():
    assert uris.parse_uri("kafka://h1:9092/readings") == uris.KafkaTopic("h1:9092", "readings")
    assert uris.parse_uri("file:///a/b.JSON") == uris.FilePath("file:///a/b.JSON", "json")
    assert uris.parse_uri("/a/b.csv").fmt == "csv"
    assert uris.parse_uri("/a/b.parquet").fmt == "text"
    for bad in ("kafka://h1:9092", "readings", "kafka:///t"):
        with pytest.raises(ValueError):
            uris.parse_uri(bad)


def test_kafka_columns(spark):
    assert readers.kafka_options(uris.KafkaTopic("h:1,h:2", "t")) == {
        "kafka.bootstrap.servers": "h:1,h:2",
        "subscribe": "t",
    }
    out = writers.as_kafka(sample(spark))
    assert out.dtypes == [("key", "string"), ("value", "string")]
    raw = out.select(
        F.lit("sensors/d1/data").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("t").alias("topic"),
        F.current_timestamp().alias("timestamp"),
    )
    got = readers.from_kafka(raw)
    assert got.columns == ["topic", "payload", "received_at"]
    assert got.filter("topic = 'sensors/d1/data'").count() == 3


def test_store_batches_replace_themselves(spark, tmp_path):
    path = f"{tmp_path}/store"
    rows = readings(spark, [{} for _ in range(6)], step=timedelta(hours=9))
    store.store_readings(rows, path, 0)
    store.store_readings(rows.limit(2), path, 1)
    store.store_readings(rows, path, 0)
    stored = store.open_readings(spark, path)
    assert stored.count() == 8
    assert stored.filter("batch_id = 0").select(*READINGS.fieldNames()).count() == 6
    assert stored.filter("is_deleted OR created_at IS NULL OR processed_at IS NULL").isEmpty()


def test_store_prunes_days(spark, tmp_path):
    path = f"{tmp_path}/store"
    store.store_readings(readings(spark, [{} for _ in range(6)], step=timedelta(hours=9)), path)
    stored = store.open_readings(spark, path)
    day = stored.filter(F.col("event_date") == START.date())
    assert day.count() == 3
    files = day.select(F.input_file_name().alias("f")).distinct()
    assert all("event_date=2024-01-01" in r.f for r in files.collect())
    assert stored.select("event_date").distinct().count() == 2


def test_compaction_drops_deleted_rows(spark, tmp_path):
    rows = readings(spark, [{} for _ in range(6)], step=timedelta(hours=9))
    store.store_readings(rows, f"{tmp_path}/a", 0)
    gone = spark.createDataFrame([("r00000",), ("r00005",)], "reading_id string")
    store.compact(spark, f"{tmp_path}/a", gone, f"{tmp_path}/b")
    left = store.open_readings(spark, f"{tmp_path}/b")
    assert sorted(r.reading_id for r in left.collect()) == ["r00001", "r00002", "r00003", "r00004"]


def test_shared_folder_is_the_sessions_own(spark):
    folder = session.fresh_folder(spark, "x")
    assert folder != session.fresh_folder(spark, "x")
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert folder.startswith(named)


def test_lines_that_do_not_fit_are_dead_letters(spark, tmp_path):
    good = '{"reading_id":"a","value":1.5,"location":{"latitude":1.0}}'
    bad = ['{"reading_id":"b","value":', '{"reading_id":"c","value":"x"}', "plain", '{"reading_id":"d","location":7}']
    (tmp_path / "x.json").write_text("\n".join([good, *bad, "", good]))
    checked = readers.checked_file(spark, f"{tmp_path}/x.json")
    rows = readers.fitting_rows(checked)
    assert rows.schema.simpleString() == READINGS.simpleString()
    assert [(r.reading_id, r.value, r.location.latitude) for r in rows.collect()] == [("a", 1.5, 1.0)] * 2
    assert sorted(r.line for r in readers.file_dead_letters(checked).collect()) == sorted(bad)
    # what a query reads doesn't change what fits
    assert rows.select("reading_id").count() == 2

    header = ",".join(READINGS.fieldNames())
    fits = ['a,d,t,1.5,u,2024-01-01T00:00:00.000Z,,,Good,Active', 'b,"d,e",t,,u,,"{\\"latitude\\":2}","{\\"k\\":\\"v\\"}",Good,Active']
    bad = ["c,d,t,x,u,,,,Good,Active", "d,d,t,1,u,not a time,,,Good,Active", "e,d,t,1,u,,{oops,,Good,Active", "f,d,t,1,u,,,[1],Good,Active"]
    (tmp_path / "x.csv").write_text("\n".join([header, *fits, *bad]) + "\n")
    checked = readers.checked_file(spark, f"{tmp_path}/x.csv")
    got = {r.reading_id: r for r in readers.fitting_rows(checked).collect()}
    assert set(got) == {"a", "b"} and got["b"].device_id == "d,e" and got["b"].location.latitude == 2.0
    assert got["b"].metadata == {"k": "v"} and got["a"].ts == datetime(2024, 1, 1) and got["a"].metadata is None
    assert sorted(r.line for r in readers.file_dead_letters(checked).collect()) == sorted(bad)
    rows = sample(spark)
    writers.open_sink(rows, f"{tmp_path}/own.csv")
    assert readers.fitting_rows(readers.checked_file(spark, f"{tmp_path}/own.csv")).count() == 3
    with pytest.raises(ValueError):
        readers.checked_file(spark, f"{tmp_path}/own.log")
