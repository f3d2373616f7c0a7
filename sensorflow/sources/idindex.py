"""Which reading ids are stored, and in which day's folder.

One narrow row per stored id, in folders by day and batch; inside a file rows are sorted by a hash bucket of the id and the id.
Asking for ids opens the days in question alone, and of these files the row groups and pages whose buckets the ids fall into. The
files carry Parquet's Bloom filters over the id, which a short list of ids uses to skip more.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.sources.commits import commits, open_folder

#: Must stay the same for a store.
BUCKETS = 256
#: Ids up to which they travel to the scan as a list.
LISTED = 1000
IDS = "reading_id string, id_bucket bigint, event_date date, kind string, batch_id bigint"


def bucket(reading_id: Column | str = "reading_id") -> Column:
    return F.pmod(F.xxhash64(F.col(reading_id) if isinstance(reading_id, str) else reading_id), F.lit(BUCKETS))


def add_ids(rows: DataFrame, root: str, kind: str, batch_id: int) -> None:
    """``rows`` (reading_id, event_date) are stored by this batch; its next try replaces them."""
    found = rows.select("reading_id", "event_date", bucket().alias("id_bucket"), F.lit(kind).alias("kind"), F.lit(batch_id).cast("bigint").alias("batch_id"))
    (
        found.hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", "id_bucket", "reading_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.bloom.filter.enabled#reading_id", "true")
        .partitionBy("event_date", "kind", "batch_id")
        .parquet(f"{root}/ids")
    )


def known_ids(spark: SparkSession, root: str) -> DataFrame:
    """All index rows of committed batches."""
    rows = open_folder(spark, f"{root}/ids", IDS)
    return rows.join(commits(spark, root), ["kind", "batch_id"], "left_semi")


def asked(known: DataFrame, ids: DataFrame, days: tuple[date, date] | None = None) -> DataFrame:
    """The index rows of ``ids``, from the buckets of these ids alone and, if given, from the first to the last of ``days``."""
    ids = ids.select("reading_id").filter(F.col("reading_id").isNotNull()).distinct()
    touched = sorted(r["b"] for r in ids.select(bucket().alias("b")).distinct().collect())  # at most BUCKETS
    known = known.filter(F.col("id_bucket").isin(touched))
    if days is not None:
        known = known.filter(F.col("event_date").between(*days))
    few = [r["reading_id"] for r in ids.limit(LISTED + 1).collect()]
    if len(few) <= LISTED:
        return known.filter(F.col("reading_id").isin(few))
    return known.join(ids, "reading_id", "left_semi")


def not_stored(rows: DataFrame, root: str, kind: str, batch_id: int, spare_days: int | None = 1) -> DataFrame:
    """Rows whose id no other committed batch holds.

    A message that comes again carries the time of its first delivery, or its arrival if it has none; so the days of the rows are
    asked with ``spare_days`` on either side. None asks every day.
    """
    spark = rows.sparkSession
    if commits(spark, root).isEmpty():
        return rows
    days = None
    if spare_days is not None:
        first, last = rows.agg(F.date_sub(F.min("ts"), spare_days), F.date_add(F.max("ts"), spare_days)).first()
        if first is None:
            return rows
        days = (first, last)
    # a batch that runs again must not take its own first try for an earlier one
    others = known_ids(spark, root).filter((F.col("kind") != kind) | (F.col("batch_id") != batch_id))
    return rows.join(asked(others, rows, days).select("reading_id"), "reading_id", "left_anti").select(*rows.columns)
