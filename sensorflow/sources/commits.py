"""Batches that become visible as a whole.

A batch writes several tables, one after the other, each into folders of its own number. Its commit record is written last;
readers take the folders of recorded batches only, so a batch that stopped half-way shows nowhere, and its next try replaces what
it left. The record's number is a folder of the tables, so a join with the records prunes the others.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS = "committed_at timestamp, kind string, batch_id bigint"


def open_folder(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table of the store; empty as long as nothing was written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def commit(spark: SparkSession, root: str, kind: str, batch_id: int) -> None:
    row = spark.range(1, numPartitions=1).select(
        F.current_timestamp().alias("committed_at"), F.lit(kind).alias("kind"), F.lit(batch_id).cast("bigint").alias("batch_id")
    )
    writer = row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("kind", "batch_id").parquet(f"{root}/commits")


def commits(spark: SparkSession, root: str) -> DataFrame:
    return open_folder(spark, f"{root}/commits", COMMITS).select("kind", "batch_id")


def visible(rows: DataFrame, root: str, kind: str) -> DataFrame:
    """Rows of committed batches; their size decides how Spark joins, one row per batch."""
    done = commits(rows.sparkSession, root).filter(F.col("kind") == kind).select("batch_id")
    return rows.join(done, "batch_id", "left_semi")


def next_batch(spark: SparkSession, root: str, kind: str) -> int:
    """Number for a batch that no stream counts; only one writer at a time may take it."""
    last = commits(spark, root).filter(F.col("kind") == kind).agg(F.max("batch_id")).first()[0]
    return 0 if last is None else last + 1
