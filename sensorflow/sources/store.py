"""The readings store: parquet by day and batch, sorted by device inside each file.

Day folders prune time ranges, the sort lets row-group statistics skip devices. The batch folder makes a
repeated streaming batch overwrite what its first try wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.operators.lookups import live
from sensorflow.schemas import AUDIT, READINGS

PARTITIONS = ("event_date", "batch_id")
ROWS_PER_FILE = 5_000_000


def stored_schema() -> T.StructType:
    folders = [T.StructField("event_date", T.DateType()), T.StructField("batch_id", T.LongType())]
    return T.StructType(READINGS.fields + AUDIT.fields + folders)


def with_audit(rows: DataFrame) -> DataFrame:
    """Reading columns and audit columns; a row that has none yet counts as created when it was processed."""
    defaults = {
        "processed_at": F.current_timestamp(),
        "created_at": F.col("processed_at"),
        "updated_at": F.lit(None),
        "deleted_at": F.lit(None),
        "is_deleted": F.lit(False),
    }
    for field in AUDIT.fields:
        if field.name not in rows.columns:
            rows = rows.withColumn(field.name, defaults[field.name].cast(field.dataType))
    return rows.select(*READINGS.fieldNames(), *AUDIT.fieldNames())


def store_rows(
    rows: DataFrame, path: str, batch_id: int = 0, ts: str = "ts", sort: str = "device_id", day: str | None = None
) -> None:
    """Add one batch, in the folders of ``ts``'s days or of those in column ``day``.

    Rebalancing splits a busy day over as many tasks as its size asks for.
    """
    event_date = F.to_date(ts) if day is None else F.col(day)
    dated = rows.withColumns({"event_date": event_date, "batch_id": F.lit(batch_id).cast("bigint")})
    (
        dated.hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", sort, ts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def store_readings(rows: DataFrame, path: str, batch_id: int = 0) -> None:
    store_rows(with_audit(rows), path, batch_id)


def open_readings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(stored_schema()).parquet(path)


def compact(spark: SparkSession, source: str, tombstones: DataFrame, target: str) -> None:
    """Write the store without deleted readings, all batches of a day merged, to a new folder."""
    store_rows(live(open_readings(spark, source), tombstones).drop(*PARTITIONS), target)
