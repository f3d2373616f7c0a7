"""The outbox against publishers that refuse, fail and forget."""

import json
import os
from collections import Counter

import pytest

from pyspark.sql import functions as F
from sensorflow.operators import routing
from sensorflow.plans import fixtures
from sensorflow.streaming import outbox


def sink(folder, every=0, fault="raise"):
    """Each call is a file; every n-th call of a process fails after it wrote, as if only its answer was lost."""
    state = {"calls": 0}

    def publish(batch):
        state["calls"] += 1
        import uuid

        with open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}.json", "w") as out:
            json.dump(batch, out)
        if every and state["calls"] % every == 0:
            if fault == "raise":
                raise OSError("no answer")
            return False
        return True

    return publish


def received(folder):
    return [json.load(open(f"{folder}/{name}")) for name in sorted(os.listdir(folder))]


def envelopes(spark, sf_dir):
    rows = routing.to_envelopes(fixtures.readings(spark, sf_dir))
    return rows.withColumn("envelope_id", outbox.envelope_id("topic", "payload")).select("envelope_id", "topic", "payload")


@pytest.mark.parametrize("fault", ["raise", "refuse"])
def test_a_failing_sink_loses_and_repeats_nothing(spark, sf_dir, tmp_path, fault):
    rows = envelopes(spark, sf_dir).repartition(6).persist()
    (tmp_path / "sent").mkdir()
    left = outbox.publish_all(rows, sink(f"{tmp_path}/sent", 3, fault), f"{tmp_path}/acks", max_batch_size=20, turns=20)
    assert left.isEmpty()
    got = received(f"{tmp_path}/sent")
    assert max(map(len, got)) == 20
    kept = {row[0]: tuple(row) for batch in got for row in batch}  # the sink keeps one row per id
    assert sorted(kept.values()) == sorted(tuple(r) for r in rows.collect())
    acks = spark.read.parquet(f"{tmp_path}/acks")
    assert acks.count() == acks.select("envelope_id").distinct().count() == rows.count()
    assert acks.select("turn").distinct().count() > 1
    rows.unpersist()


def test_what_was_acknowledged_is_not_sent_again(spark, sf_dir, tmp_path):
    rows = envelopes(spark, sf_dir)
    half = rows.filter(F.col("topic") < "sensors/dev_5")
    (tmp_path / "sent").mkdir()
    assert outbox.publish_all(half, sink(f"{tmp_path}/sent"), f"{tmp_path}/acks", 7).isEmpty()
    assert outbox.publish_all(rows.union(rows), sink(f"{tmp_path}/sent"), f"{tmp_path}/acks", 50).isEmpty()
    times = Counter(row[0] for batch in received(f"{tmp_path}/sent") for row in batch)
    assert set(times.values()) == {1} and len(times) == rows.count()


def test_a_dead_sink_leaves_all(spark, sf_dir, tmp_path):
    rows = envelopes(spark, sf_dir)
    left = outbox.publish_all(rows, lambda batch: False, f"{tmp_path}/acks", turns=2)
    assert left.count() == rows.count()
    with pytest.raises(ValueError):
        outbox.publish_all(rows, lambda batch: True, f"{tmp_path}/acks", max_batch_size=0)
    assert outbox.publish_all(rows.limit(0), lambda batch: True, f"{tmp_path}/none").isEmpty()
