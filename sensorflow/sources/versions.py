"""Updates and deletes of stored readings: written beside the rows, merged when read, folded in by ``compact_store``.

A change is a whole row in the folder of the reading's day and of the change's batch: a newer version, or a tombstone with
``is_deleted``. Only days that have changes are merged - an anti-join of their rows with the changed ids, and the changes that
live - all other days are plain scans. Of several changes of a reading the one of the later batch holds. A reading whose new time
falls on another day leaves a tombstone in the old day's folder, so that time ranges still prune by day.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorflow.operators.lookups import newest
from sensorflow.schemas import AUDIT, READINGS
from sensorflow.session import fresh_folder
from sensorflow.sources import idindex
from sensorflow.sources.commits import commit, next_batch, open_folder, visible
from sensorflow.sources.store import store_rows, stored_schema, with_audit

ROWS, CHANGES = "readings", "changes"
#: Compacted rows; streams count their batches from 0.
COMPACTED = -1


def store_new(rows: DataFrame, root: str, batch_id: int, kind: str = ROWS) -> None:
    """Add a batch of readings and their ids; the caller commits."""
    audited = with_audit(rows)
    store_rows(audited, f"{root}/readings", batch_id)
    idindex.add_ids(audited.select("reading_id", F.to_date("ts").alias("event_date")), root, kind, batch_id)


def _on_days(days: list) -> Column:
    """Readings without a time have a folder of their own."""
    known = [d for d in days if d is not None]
    found = F.coalesce(F.col("event_date").isin(known), F.lit(False))
    return found | F.col("event_date").isNull() if None in days else found


def current_rows(spark: SparkSession, root: str, days: list | None = None) -> DataFrame:
    """The stored readings as they are now: newest versions, no deleted ones. ``days`` limits both scans."""
    rows = visible(open_folder(spark, f"{root}/readings", stored_schema()), root, ROWS)
    changes = visible(open_folder(spark, f"{root}/changes", stored_schema()), root, CHANGES)
    if days is not None:
        rows, changes = (frame.filter(_on_days(days)) for frame in (rows, changes))
    changed_days = [r["event_date"] for r in changes.select("event_date").distinct().collect()]
    if not changed_days:
        return rows.drop("batch_id")
    touched = _on_days(changed_days)
    changed = changes.select(F.col("event_date").alias("day"), F.col("reading_id").alias("id")).distinct()
    same = F.col("event_date").eqNullSafe(F.col("day")) & (F.col("reading_id") == F.col("id"))
    kept = rows.filter(touched).join(changed, same, "left_anti")
    last = Window.partitionBy("event_date", "reading_id").orderBy(F.desc("batch_id"))
    live = changes.withColumn("_turn", F.row_number().over(last)).filter("_turn = 1 AND NOT is_deleted").drop("_turn")
    quiet = rows.filter(~touched)
    return quiet.unionByName(kept).unionByName(live).drop("batch_id")


def _stored(ids: DataFrame, root: str) -> DataFrame:
    """The current rows of ``ids``; only days that hold one of them are read."""
    spark = ids.sparkSession
    found = idindex.asked(idindex.known_ids(spark, root), ids)
    days = [r["event_date"] for r in found.select("event_date").distinct().collect()]
    rows = current_rows(spark, root, days)
    return rows.join(ids.select("reading_id").distinct(), "reading_id", "left_semi")


def _write_changes(changes: DataFrame, root: str, batch_id: int) -> DataFrame:
    """Changes with their ``event_date``; returns them as written, so that nothing is computed a second time."""
    spark = changes.sparkSession
    path = fresh_folder(spark, "changes")
    changes.write.parquet(path)
    settled = spark.read.schema(changes.schema).parquet(path)
    store_rows(settled, f"{root}/changes", batch_id, day="event_date")
    idindex.add_ids(settled.select("reading_id", "event_date"), root, CHANGES, batch_id)
    commit(spark, root, CHANGES, batch_id)
    return settled


def update(rows: DataFrame, root: str, at: datetime) -> DataFrame:
    """New versions of stored readings. Returns (reading_id, updated), false where no live reading has that id.

    Of several rows with one id the newest by (ts, all other columns) counts. ``created_at`` stays, ``updated_at`` is ``at``.
    """
    spark = rows.sparkSession
    batch_id = next_batch(spark, root, CHANGES)
    one_each = newest(rows.select(*READINGS.fieldNames()), "reading_id", "ts")
    old = _stored(one_each, root).select(
        "reading_id", F.col("event_date").alias("old_date"), F.col("processed_at").alias("was_processed"), F.col("created_at").alias("was_created"), F.col("device_id").alias("old_device")
    )
    joined = one_each.join(old, "reading_id").withColumns(
        {
            "processed_at": F.col("was_processed"),
            "created_at": F.col("was_created"),
            "updated_at": F.lit(at).cast("timestamp"),
            "deleted_at": F.lit(None).cast("timestamp"),
        }
    )
    day = F.to_date("ts")
    here = F.struct(F.coalesce(day, F.col("old_date")).alias("event_date"), F.lit(False).alias("is_deleted"))
    left = F.struct(F.col("old_date").alias("event_date"), F.lit(True).alias("is_deleted"))
    both = F.when(day.isNotNull() & (day != F.col("old_date")), F.array(here, left)).otherwise(F.array(here))
    columns = [*READINGS.fieldNames(), *[n for n in AUDIT.fieldNames() if n != "is_deleted"]]
    changes = joined.withColumn("_at", F.explode(both)).select(*columns, "_at.is_deleted", "_at.event_date")
    done = _write_changes(changes, root, batch_id).filter("NOT is_deleted").select("reading_id", F.lit(True).alias("updated"))
    return one_each.select("reading_id").join(done, "reading_id", "left").select("reading_id", F.coalesce("updated", F.lit(False)).alias("updated"))


def delete(ids: DataFrame, root: str, at: datetime) -> DataFrame:
    """Tombstones for stored readings. Returns (reading_id, deleted), false where no live reading has that id."""
    spark = ids.sparkSession
    batch_id = next_batch(spark, root, CHANGES)
    ids = ids.select(F.col("reading_id").cast("string").alias("reading_id")).distinct()
    gone = _stored(ids, root).withColumns({"is_deleted": F.lit(True), "deleted_at": F.lit(at).cast("timestamp")})
    columns = [*READINGS.fieldNames(), *AUDIT.fieldNames(), "event_date"]
    done = _write_changes(gone.select(*columns), root, batch_id).select("reading_id", F.lit(True).alias("deleted"))
    return ids.join(done, "reading_id", "left").select("reading_id", F.coalesce("deleted", F.lit(False)).alias("deleted"))


def compact_store(spark: SparkSession, root: str, target: str) -> None:
    """The store as it is now in a new folder: changes folded in, all batches of a day in one, ids anew."""
    rows = current_rows(spark, root).select(*READINGS.fieldNames(), *AUDIT.fieldNames(), "event_date")
    store_rows(rows, f"{target}/readings", COMPACTED, day="event_date")
    stored = open_folder(spark, f"{target}/readings", stored_schema())
    idindex.add_ids(stored.select("reading_id", "event_date"), target, ROWS, COMPACTED)
    commit(spark, target, ROWS, COMPACTED)

