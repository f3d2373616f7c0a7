"""The store over several batches: ids once, whole batches only, updates, deletes, compaction."""

from datetime import date, datetime, timedelta

import pytest
from rows import START, readings

from pyspark.sql import functions as F
from sensorflow.operators import lookups
from sensorflow.schemas import MESSAGES
from sensorflow.sources import commits, idindex, versions
from sensorflow.streaming import continuous
from sensorflow.streaming.ingest import ingest_stream

AT = datetime(2024, 6, 1)
BODY = '{"Id":"%s","DeviceId":"d%d","SensorType":"ph","Timestamp":"%s","Value":{"Value":%d,"Unit":"pH"}}'


def message(n, value=7, day=1, received=None):
    ts = datetime(2024, 1, day, 12) + timedelta(seconds=n)
    return ("sensors/d1/data", BODY % (f"m{n}", n % 3, ts.isoformat() + "Z", value), received or ts)


def checked(spark, rows):
    return ingest_stream(spark.createDataFrame(rows, MESSAGES), ahead="1000 days")


def stored(spark, root):
    return {r.reading_id: r.value for r in continuous.open_stored(spark, root, "readings").collect()}


def test_ids_are_stored_once_over_batches(spark, tmp_path):
    root = str(tmp_path)
    continuous.store_batch(checked(spark, [message(n) for n in range(20)]), 0, root)
    second = [message(n, 8, received=datetime(2024, 1, 3)) for n in range(10, 30)]
    continuous.store_batch(checked(spark, second), 1, root)
    want = {f"m{n}": 7.0 if n < 20 else 8.0 for n in range(30)}
    assert stored(spark, root) == want
    # a batch that runs again, as after a lost checkpoint, writes the same once more
    continuous.store_batch(checked(spark, second), 1, root)
    assert stored(spark, root) == want
    assert continuous.open_stored(spark, root, "routes").count() == 90
    # another day: within a day's distance found, beyond it only if every day is asked
    continuous.store_batch(checked(spark, [message(3, 9, day=2)]), 2, root)
    assert stored(spark, root) == want
    continuous.store_batch(checked(spark, [message(4, 9, day=9)]), 3, root, spare_days=None)
    assert stored(spark, root) == want


def test_only_asked_buckets_and_days_are_read(spark, tmp_path):
    """All other days are spoilt, so reading one of them would fail; buckets reach the scan."""
    root = str(tmp_path)
    for batch, day in enumerate((1, 2, 8)):
        rows = [message(1000 * day + n, day=day) for n in range(200)]
        continuous.store_batch(checked(spark, rows), batch, root)
    one = spark.createDataFrame([("m1005",)], "reading_id string")
    (own,) = one.select(idindex.bucket()).first()
    files = list((tmp_path / "ids").rglob("*.parquet"))
    assert len(files) == 3
    for file in files:
        if "event_date=2024-01-01" not in str(file):
            file.write_bytes(b"spoilt")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    asked = idindex.asked(idindex.known_ids(spark, root), one, (date(2023, 12, 31), date(2024, 1, 1)))
    assert [(r.reading_id, r.event_date) for r in asked.collect()] == [("m1005", date(2024, 1, 1))]
    text = asked._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(id_bucket,{own})" in text and "EqualTo(reading_id,m1005)" in text
    continuous.store_batch(checked(spark, [message(5000, day=12)]), 3, root)  # asks neither day
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        idindex.known_ids(spark, root).collect()


def test_many_ids_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(idindex, "LISTED", 2)
    root = str(tmp_path)
    continuous.store_batch(checked(spark, [message(n) for n in range(20)]), 0, root)
    ids = spark.createDataFrame([(f"m{n}",) for n in range(15, 40)] + [(None,)], "reading_id string")
    assert idindex.asked(idindex.known_ids(spark, root), ids).count() == 5


def test_half_a_batch_is_not_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    continuous.store_batch(checked(spark, [message(n) for n in range(5)]), 0, root)
    write = continuous.store_rows

    def failing(rows, path, *more, **named):
        if path.endswith("/envelopes"):
            raise OSError("disk is gone")
        write(rows, path, *more, **named)

    second = [message(n) for n in range(3, 9)] + [("sensors/d1/data", "{broken", START)]
    monkeypatch.setattr(continuous, "store_rows", failing)
    with pytest.raises(OSError):
        continuous.store_batch(checked(spark, second), 1, root)
    assert spark.read.parquet(f"{root}/dead_letters").count() == 1  # written, but not recorded
    for table, many in (("readings", 5), ("dead_letters", 0), ("envelopes", 5), ("routes", 15)):
        assert continuous.open_stored(spark, root, table).count() == many
    monkeypatch.setattr(continuous, "store_rows", write)
    continuous.store_batch(checked(spark, second), 1, root)
    for table, many in (("readings", 9), ("dead_letters", 1), ("envelopes", 9), ("routes", 27)):
        assert continuous.open_stored(spark, root, table).count() == many


def test_updates_and_deletes(spark, tmp_path):
    root, folded = f"{tmp_path}/a", f"{tmp_path}/b"
    rows = readings(spark, [{} for _ in range(8)], step=timedelta(hours=9))
    versions.store_new(rows, root, 0)
    commits.commit(spark, root, versions.ROWS, 0)

    def change(where, **columns):
        return rows.filter(where).withColumns({k: F.lit(v) for k, v in columns.items()})

    first = versions.update(change("reading_id IN ('r00001', 'r00002')", value=5.0), root, AT)
    assert {tuple(r) for r in first.collect()} == {("r00001", True), ("r00002", True)}
    unknown = change("reading_id = 'r00003'", reading_id="nobody")
    assert versions.update(unknown, root, AT).collect()[0].updated is False
    gone = versions.delete(spark.createDataFrame([("r00002",), ("r00004",), ("nobody",), (None,)], "reading_id string"), root, AT)
    assert {tuple(r) for r in gone.collect()} == {("r00002", True), ("r00004", True), ("nobody", False), (None, False)}
    assert [r.deleted for r in versions.delete(spark.createDataFrame([("r00004",)], "reading_id string"), root, AT).collect()] == [False]
    assert [r.updated for r in versions.update(change("reading_id = 'r00004'", value=1.0), root, AT).collect()] == [False]
    # to another day and back, then changed twice in one call: the newest row counts
    far = datetime(2024, 2, 9, 1)
    versions.update(change("reading_id = 'r00005'", ts=far, value=6.0), root, AT)
    assert lookups.by_device(versions.current_rows(spark, root), "d1", far, far).count() == 1
    versions.update(change("reading_id = 'r00005'", value=7.0), root, AT + timedelta(days=1))
    versions.update(change("reading_id = 'r00006'", value=1.0).union(change("reading_id = 'r00006'", value=2.0, ts=START + timedelta(hours=55))), root, AT)

    want = {"r00000": 0.0, "r00001": 5.0, "r00003": 0.0, "r00005": 7.0, "r00006": 2.0, "r00007": 0.0}
    now = versions.current_rows(spark, root)
    assert {r.reading_id: r.value for r in now.collect()} == want
    changed = {r.reading_id: r.updated_at for r in now.filter("updated_at IS NOT NULL").collect()}
    assert changed == {"r00001": AT, "r00005": AT + timedelta(days=1), "r00006": AT}
    assert now.filter("created_at IS NULL OR is_deleted OR event_date <> to_date(ts)").isEmpty()
    same_created = now.join(spark.read.parquet(f"{root}/readings").select("reading_id", F.col("created_at").alias("c")), "reading_id")
    assert same_created.filter("created_at <> c").isEmpty()

    versions.compact_store(spark, root, folded)
    assert {r.reading_id: r.value for r in versions.current_rows(spark, folded).collect()} == want
    assert spark.read.parquet(f"{folded}/readings").count() == len(want)
    assert idindex.known_ids(spark, folded).count() == len(want)
    # the new folder goes on as a store
    assert versions.update(change("reading_id = 'r00007'", value=9.0), folded, AT).collect()[0].updated is True
    assert {r.reading_id: r.value for r in versions.current_rows(spark, folded).collect()} == want | {"r00007": 9.0}


def test_readings_without_a_time(spark, tmp_path):
    root = str(tmp_path)
    rows = readings(spark, [{"ts": None}, {"ts": None}, {}])
    versions.store_new(rows, root, 0)
    commits.commit(spark, root, versions.ROWS, 0)
    versions.update(rows.filter("reading_id = 'r00000'").withColumn("value", F.lit(3.0)), root, AT)
    versions.delete(spark.createDataFrame([("r00001",)], "reading_id string"), root, AT)
    assert {r.reading_id: r.value for r in versions.current_rows(spark, root).collect()} == {"r00000": 3.0, "r00002": 0.0}


def test_a_store_without_batches_is_empty(spark, tmp_path):
    assert versions.current_rows(spark, f"{tmp_path}/none").isEmpty()
    assert versions.delete(spark.createDataFrame([("x",)], "reading_id string"), f"{tmp_path}/none", AT).collect()[0].deleted is False
