"""The rolling detector on a stream.

What a series needs from earlier micro-batches is its tail: all rows that a late row may still get in front
of, and the ten rows before those. Each micro-batch is scored together with the tails by the batch detector,
so a series that fills a third of a micro-batch is cut into chunks like any other, and no Python runs per row
or per key. A late row is scored against the rows before its own time; a row behind it whose finding changes
is reported again, and one that has none any more is reported with ``is_anomaly`` false. Taking the last
report of each reading gives what the batch detector finds in the same rows.

Tails are kept in hash buckets of the series, each in one of two folders by turns. A micro-batch reads the
buckets that it touches and writes them to their other folders; all other files stay as they are. A small
table, itself in one of two folders by turns, says where each bucket is, so a repeated micro-batch starts
from the same tails and replaces its own first try.

A micro-batch is first written to files and scored in the caller's session: the stream's own session plans without
adaptive execution, where a hint to rebalance is dropped and every partition would write into every bucket.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sensorflow.operators.rolling import (
    FLAT_ROWS,
    NOTHING,
    ORDER,
    SERIES,
    history_columns,
    reports,
    scorable,
    with_verdict,
)
from sensorflow.operators.series import HOT_ROWS, over_series
from sensorflow.operators.views import newest_per
from sensorflow.streaming.ingest import DELAY

#: Buckets of the tails, an argument; must stay the same as long as a checkpoint is used. A micro-batch opens and writes
#: the buckets it touches, so they should hold some tens of MB each: ten rows a series and those within the delay.
TAIL_BUCKETS = 32
TAIL = ("reading_id", "device_id", "sensor_type", "ts", "value")
_PLACES = "bucket bigint, slot bigint"


def judge_batch(batch: DataFrame, tails: DataFrame | None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of a micro-batch and of the tails with their verdicts.

    ``_moved`` marks new rows and rows behind one; ``reported`` is what was reported of a row before, ``_report``
    what holds now, both as hashes.
    """
    rows = scorable(batch).withColumns({"_new": F.lit(True), "reported": F.lit(None).cast("bigint")})
    if tails is not None:
        rows = rows.unionByName(tails.withColumn("_new", F.lit(False)))

    def columns(window):
        before = F.max("_new").over(window.rowsBetween(-FLAT_ROWS, -1))
        return history_columns(window) | {"_moved": F.col("_new") | F.coalesce(before, F.lit(False))}

    judged = with_verdict(over_series(rows, SERIES, ORDER, FLAT_ROWS, columns, hot_rows))
    report = F.when(F.col("rule") != NOTHING, F.xxhash64("type", "severity", "prev_value", "pct_change"))
    return judged.withColumn("_report", F.when(F.col("_moved"), report).otherwise(F.col("reported")))


def changed_reports(judged: DataFrame) -> DataFrame:
    """New findings, changed ones, and with ``is_anomaly`` false the rows that have none any more."""
    return reports(judged.filter(F.col("_moved") & ~F.col("_report").eqNullSafe(F.col("reported"))))


def tails_after(
    judged: DataFrame, newest: datetime | None = None, delay: str | None = None, silent: str | None = None
) -> DataFrame:
    """Per series the rows within ``delay`` of ``newest``, the time of the last row, and the ten rows before them.

    Without ``delay`` no row may be late and ten rows are enough. Series without a row for ``silent`` are
    forgotten; by default none is. Rows without a time count as old ones.
    """
    known = judged.select(*TAIL, F.col("_report").alias("reported"))
    if silent is not None:
        # a partial maximum per task, so that no task sees all rows of a hot series
        gone = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {silent}")
        lasting = known.groupBy(*SERIES).agg(F.max("ts").alias("_last")).filter(F.col("_last") >= gone)
        heard = lasting.select(*[F.col(c).alias(f"_{c}") for c in SERIES])
        known = known.join(heard, [known[c].eqNullSafe(heard[f"_{c}"]) for c in SERIES], "left_semi")
    if delay is None:
        return newest_per(known, list(SERIES), FLAT_ROWS)
    # The watermark is cut to milliseconds.
    open_from = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}") - F.expr("INTERVAL 1 millisecond")
    settled = F.coalesce(F.col("ts") < open_from, F.lit(True))
    return known.filter(~settled).unionByName(newest_per(known.filter(settled), list(SERIES), FLAT_ROWS))


def last_reports(reported: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Of all reports of each reading the one that holds, and only if it is a finding."""
    last = Window.partitionBy("reading_id").orderBy(F.desc(batch))
    return reported.withColumn("_turn", F.row_number().over(last)).filter("_turn = 1 AND is_anomaly").drop("_turn")


def rolling_query(
    readings: DataFrame,
    checkpoints: str,
    sink: Callable[[DataFrame, int], None],
    hot_rows: int = HOT_ROWS,
    delay: str = DELAY,
    silent: str | None = None,
    buckets: int = TAIL_BUCKETS,
    **trigger,
) -> StreamingQuery:
    """Score a stream of readings; ``sink`` gets the reports of each micro-batch.

    Rows must come from ``ingest.once`` with the same ``delay``: it drops repeats and rows behind the
    watermark, so neither reaches the rules or the tails.
    """
    spark = readings.sparkSession
    folder = f"{checkpoints}/tails"
    bucket = F.pmod(F.xxhash64(*SERIES), F.lit(buckets)).alias("bucket")

    def step(batch: DataFrame, batch_id: int) -> None:
        scorable(batch).write.mode("overwrite").parquet(f"{folder}/arrived")
        rows = spark.read.schema(scorable(batch).schema).parquet(f"{folder}/arrived")
        judged = None
        try:
            places: dict[int, int] = {}
            if batch_id > 0:
                before = spark.read.schema(_PLACES).parquet(f"{folder}/places/{(batch_id - 1) % 2}")
                places = {r.bucket: r.slot for r in before.collect()}
            touched = rows.groupBy(bucket).agg(F.max("ts").alias("newest")).collect()
            if touched:
                held = [f"{folder}/rows/slot={places[r.bucket]}/bucket={r.bucket}" for r in touched if r.bucket in places]
                tails = None
                if held:
                    schema = T.StructType([*rows.select(*TAIL).schema.fields, T.StructField("reported", T.LongType())])
                    tails = spark.read.schema(schema).parquet(*held)
                judged = judge_batch(rows, tails, hot_rows).persist(StorageLevel.MEMORY_AND_DISK)
                sink(changed_reports(judged), batch_id)
                after = tails_after(judged, max((r.newest for r in touched if r.newest), default=None), delay, silent)
                places |= {r.bucket: 1 - places.get(r.bucket, 1) for r in touched}
                _write_tails(after.withColumn("bucket", bucket), places, f"{folder}/rows")
            spark.createDataFrame(list(places.items()), _PLACES).coalesce(1).write.mode("overwrite").parquet(
                f"{folder}/places/{batch_id % 2}"
            )
        finally:
            if judged is not None:
                judged.unpersist()

    return (
        readings.select(*TAIL)
        .writeStream.option("checkpointLocation", f"{checkpoints}/query")
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(step)
        .start()
    )


def _write_tails(tails: DataFrame, places: dict[int, int], folder: str) -> None:
    """Only the folders of buckets that have rows here are replaced."""
    slots = F.broadcast(tails.sparkSession.createDataFrame(list(places.items()), _PLACES))
    (
        tails.join(slots, "bucket")
        .hint("rebalance", "bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("slot", "bucket")
        .parquet(folder)
    )
