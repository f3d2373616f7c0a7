"""The running service: store every message, and detect on the side.

Two queries read the same messages. ``store_query`` keeps all readings, late ones too, and the dead
letters, routes and outbound envelopes. ``detect_query`` drops repeats and late rows, scores and stores
the anomalies; what a late row changes is stored as a newer report. Each micro-batch writes its own batch
folders, so a repeated batch replaces its first try, and a commit record last: readers see whole batches only.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorflow.operators import anomalies, routing
from sensorflow.sources import versions
from sensorflow.sources.commits import commit, visible
from sensorflow.sources.idindex import not_stored
from sensorflow.sources.store import store_rows
from sensorflow.streaming.ingest import AHEAD, DELAY, dead_letters, good_rows, ingest_stream, newest_copies, once
from sensorflow.streaming.rolling import last_reports, rolling_query

ANOMALIES = "anomalies"
BATCH_TABLES = ("dead_letters", "envelopes", "routes")


def store_batch(checked: DataFrame, batch_id: int, root: str, spare_days: int | None = 1) -> None:
    """Readings whose id isn't stored yet, their routes and envelopes, and the dead letters; all visible at once.

    The first batch that brings an id holds; ``spare_days`` as in ``idindex.not_stored``.
    """
    checked = checked.persist(StorageLevel.MEMORY_AND_DISK)
    good = good_rows(newest_copies(checked)).persist(StorageLevel.MEMORY_AND_DISK)
    readings = not_stored(good, root, versions.ROWS, batch_id, spare_days).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        versions.store_new(readings, root, batch_id)
        store_rows(dead_letters(checked), f"{root}/dead_letters", batch_id, "received_at", "topic")
        store_rows(routing.to_envelopes(readings), f"{root}/envelopes", batch_id)
        routes = routing.route_readings(readings.select("reading_id", "device_id", "sensor_type", "ts"))
        store_rows(routes, f"{root}/routes", batch_id)
        commit(checked.sparkSession, root, versions.ROWS, batch_id)
    finally:
        readings.unpersist()
        good.unpersist()
        checked.unpersist()


def open_stored(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table that ``store_batch`` or ``store_anomalies`` writes, rows of whole batches only; readings as they are now."""
    if table == "readings":
        return versions.current_rows(spark, root)
    kind = versions.ROWS if table in BATCH_TABLES else ANOMALIES
    return visible(spark.read.parquet(f"{root}/{table}"), root, kind)


def store_anomalies(reported: DataFrame, batch_id: int, root: str) -> None:
    reported = reported.persist(StorageLevel.MEMORY_AND_DISK)
    withdrawn = reported.filter(~F.col("is_anomaly")).select("reading_id", "device_id", F.col("ts").alias("detected_at"))
    found = anomalies.triage(anomalies.as_anomalies(reported)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        store_rows(found, f"{root}/anomalies", batch_id, "detected_at")
        store_rows(withdrawn, f"{root}/withdrawn", batch_id, "detected_at")
        store_rows(routing.anomaly_envelopes(found), f"{root}/anomaly_envelopes", batch_id, "detected_at")
        store_rows(
            routing.route_anomalies(found.select("anomaly_id", "reading_id", "device_id", "sensor_type", "detected_at")),
            f"{root}/anomaly_routes",
            batch_id,
            "detected_at",
        )
        commit(reported.sparkSession, root, ANOMALIES, batch_id)
    finally:
        found.unpersist()
        reported.unpersist()


def open_anomalies(spark: SparkSession, root: str) -> DataFrame:
    """The stored anomalies that hold: of each reading the last report, unless it was withdrawn."""
    found = spark.read.parquet(f"{root}/anomalies").withColumn("is_anomaly", F.lit(True))
    schema = found.select("reading_id", "device_id", "detected_at", "event_date", "batch_id").schema
    withdrawn = spark.read.schema(schema).parquet(f"{root}/withdrawn").withColumn("is_anomaly", F.lit(False))
    found, withdrawn = visible(found, root, ANOMALIES), visible(withdrawn, root, ANOMALIES)
    return last_reports(found.unionByName(withdrawn, allowMissingColumns=True)).drop("is_anomaly")


def store_query(
    received: DataFrame, root: str, checkpoints: str, id_column: str | None = None, ahead: str = AHEAD, **trigger
) -> StreamingQuery:
    return (
        ingest_stream(received, id_column, ahead)
        .writeStream.queryName("store")
        .option("checkpointLocation", f"{checkpoints}/store")
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(lambda batch, batch_id: store_batch(batch, batch_id, root))
        .start()
    )


def detect_query(
    received: DataFrame,
    root: str,
    checkpoints: str,
    id_column: str | None = None,
    delay: str = DELAY,
    ahead: str = AHEAD,
    silent: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Rows later than ``delay`` and rows with a clock further than ``ahead`` are only in what ``store_query`` writes."""
    return rolling_query(
        once(good_rows(ingest_stream(received, id_column, ahead)), delay),
        f"{checkpoints}/detect",
        lambda reported, batch_id: store_anomalies(reported, batch_id, root),
        delay=delay,
        silent=silent,
        **trigger,
    )
