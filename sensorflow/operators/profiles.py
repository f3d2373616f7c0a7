"""Profiles kept up to date: one mergeable state per day and sensor type instead of a scan of all history.

A state holds count, mean, summed squares of deviations, least and greatest value. States of two parts of the rows give that of
both, so a profile over any span of days reads their states alone, and a new or corrected day is the only one that is scanned.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.numeric import is_number
from sensorflow.sources.commits import open_folder

STATES = "sensor_type string, n bigint, mean double, squares double, lowest double, highest double, event_date date"


def day_states(stored: DataFrame) -> DataFrame:
    """One row per ``event_date`` and sensor type; NaN and missing values have no part in them."""
    return (
        stored.filter(is_number(F.col("value")))
        .groupBy("event_date", "sensor_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("value").alias("mean"),
            (F.var_pop("value") * F.count(F.lit(1))).alias("squares"),
            F.min("value").alias("lowest"),
            F.max("value").alias("highest"),
        )
    )


def refresh(stored: DataFrame, path: str, days: list[date]) -> None:
    """Make the states of ``days`` anew; days without rows any more lose theirs."""
    spark = stored.sparkSession
    states = day_states(stored.filter(F.col("event_date").isin(days)))
    # a day that is empty now is overwritten as well, by a row that counts nothing
    none = spark.createDataFrame([(d,) for d in days], "event_date date").join(states.select("event_date").distinct(), "event_date", "left_anti")
    empty = none.select(F.lit(0).cast("bigint").alias("n"), "event_date")
    (
        states.unionByName(empty, allowMissingColumns=True)
        .repartition("event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path)
    )


def _both(one: Column, two: Column) -> Column:
    """The state of the rows of two states."""
    n = one["n"] + two["n"]
    delta = two["mean"] - one["mean"]
    share = two["n"].cast("double") / n
    merged = F.struct(
        n.alias("n"),
        (one["mean"] + delta * share).alias("mean"),
        (one["squares"] + two["squares"] + delta * delta * one["n"] * share).alias("squares"),
    )
    return F.when(one["n"] == 0, two).otherwise(merged)


def profile(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Count, mean, population variance and deviation per type, over the days from ``first`` to ``last``."""
    states = open_folder(spark, path, STATES).filter("n > 0")
    if first is not None:
        states = states.filter(F.col("event_date") >= F.lit(first))
    if last is not None:
        states = states.filter(F.col("event_date") <= F.lit(last))
    state = F.struct("event_date", "n", "mean", "squares")
    by_type = states.groupBy("sensor_type").agg(
        F.sort_array(F.collect_list(state)).alias("days"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest")
    )
    none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))
    plain = F.transform("days", lambda d: F.struct(d["n"].alias("n"), d["mean"].alias("mean"), d["squares"].alias("squares")))
    merged = by_type.withColumn("_all", F.aggregate(plain, none, _both))
    # equal values have no deviation, whatever rounding says of their means
    variance = F.when(F.col("lowest") == F.col("highest"), 0.0).otherwise(F.col("_all.squares") / F.col("_all.n"))
    return merged.select(
        "sensor_type", "_all.n", "_all.mean", variance.alias("variance"), F.sqrt(variance).alias("std_dev"), "lowest", "highest"
    )


def as_zscore(profiles: DataFrame) -> DataFrame:
    """The columns that the z-score detector reads, ready to be attached to a batch or a stream."""
    return profiles.select("sensor_type", F.col("n").alias("z_count"), F.col("mean").alias("z_mean"), F.col("std_dev").alias("z_std"))
