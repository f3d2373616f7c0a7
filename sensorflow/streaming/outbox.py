"""Publishing stored envelopes in batches of bounded size.

The outbox is the envelopes without an acknowledgement. Each task cuts its share into batches of at most ``max_batch_size`` of one
topic group and hands them to the publisher; ids of batches that it took are written as acknowledgements, in a folder per turn.
What it refused, or what was on its way when a task was lost, is sent again in the next turn: every envelope is sent at least
once, and one that was acknowledged never again. A sink that keeps one row per id thus holds each envelope exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import batched

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.sources.commits import open_folder

#: (id, topic, payload) of one batch -> taken or not; an exception counts as not.
Publish = Callable[[list[tuple[str, str, str]]], bool]
ACKS = "envelope_id string, turn bigint"


def envelope_id(*columns: str):
    """Same id for the same envelope on every run."""
    return F.sha2(F.concat_ws("|", *columns), 256)


def waiting(envelopes: DataFrame, acks: str) -> DataFrame:
    """Envelopes (envelope_id, topic, payload) that no turn got acknowledged."""
    taken = open_folder(envelopes.sparkSession, acks, ACKS)
    return envelopes.join(taken, "envelope_id", "left_anti")


def _sender(publish: Publish, max_batch_size: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for frame in frames for row in frame.itertuples(index=False, name=None))
        for batch in batched(rows, max_batch_size):
            try:
                taken = publish(list(batch))
            except Exception:  # noqa: BLE001  whatever a publisher raises, its batch is sent again
                taken = False
            if taken:
                yield pd.DataFrame({"envelope_id": [row[0] for row in batch]})

    return send


def publish_all(envelopes: DataFrame, publish: Publish, acks: str, max_batch_size: int = 100, turns: int = 5) -> DataFrame:
    """Sends what waits, up to ``turns`` times; returns the envelopes that still wait.

    ``envelopes`` needs ``topic`` and ``payload`` and an ``envelope_id``; of equal ids one is sent. Turns after a restart go on
    from the acknowledgements that are there.
    """
    if max_batch_size < 1:
        raise ValueError("a batch holds one envelope at least")
    spark = envelopes.sparkSession
    envelopes = envelopes.select("envelope_id", "topic", "payload").dropDuplicates(["envelope_id"])
    last = open_folder(spark, acks, ACKS).agg(F.max("turn")).first()[0]
    first = 0 if last is None else last + 1
    for turn in range(first, first + turns):
        left = waiting(envelopes, acks)
        if left.isEmpty():
            break
        sent = left.mapInPandas(_sender(publish, max_batch_size), "envelope_id string")
        sent.write.mode("overwrite").parquet(f"{acks}/turn={turn}")
    return waiting(envelopes, acks)
