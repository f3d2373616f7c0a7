"""Exact order statistics per group, without sorting a whole group in one task.

Values at the zero-based positions floor(f * n) of the sorted group, no interpolation. A mergeable sketch
first gives a narrow bracket of values around each position; sketches are merged in two levels, so that a
hot group's sketches do not all meet in one task first. One more pass then counts rows per group and value,
with all values outside the brackets folded into a few ranges. A running count over the bins of a bracket
finds the bin of a position, another over the values of that bin the value itself. A position outside its
bracket is searched again between the smallest and the largest value, so the answer does not depend on the
sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.functions.numeric import is_number
from sensorflow.operators.joins import attach, settle

SKETCH_SIZE = 2048
MARGIN = 0.006
PARTS = 256
BINS = 1024


def index_quantiles(rows: DataFrame, key: str, value: str, fractions: dict[str, float]) -> DataFrame:
    """One settled row per key: ``n`` and one column per named fraction (ascending fractions)."""
    clean = rows.select(F.col(key), F.col(value).alias("_v")).filter(is_number(F.col("_v")))
    bounds = settle(brackets(clean, key, fractions))
    picked = settle(_pick(attach(clean, bounds, key, "inner"), key, fractions))

    missed = picked.filter(_any_null(fractions))
    if missed.isEmpty():
        return picked
    everything = F.array(*[F.min("_v"), F.max("_v")] * len(fractions)).alias("_edges")
    extremes = attach(clean, settle(missed.select(key)), key, "inner").groupBy(key).agg(everything)
    again = _pick(attach(clean, settle(extremes), key, "inner"), key, fractions)
    return settle(picked.filter(~_any_null(fractions)).unionByName(again))


def brackets(clean: DataFrame, key: str, fractions: dict[str, float]) -> DataFrame:
    """``_edges`` per key: a value below and a value above each position, most likely."""
    sketches = (
        clean.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
        .groupBy(key, "_part")
        .agg(F.kll_sketch_agg_double("_v", F.lit(SKETCH_SIZE)).alias("_sketch"))
        .groupBy(key)
        .agg(F.kll_merge_agg_double("_sketch", F.lit(SKETCH_SIZE)).alias("_sketch"))
    )
    edges = [e for f in fractions.values() for e in (max(f - MARGIN, 0.0), min(f + MARGIN, 1.0))]
    quantiles = [F.kll_sketch_get_quantile_double("_sketch", F.lit(e)) for e in edges]
    return sketches.select(key, F.array(*quantiles).alias("_edges"))


def _pick(rows: DataFrame, key: str, fractions: dict[str, float]) -> DataFrame:
    """The value at each position, null where the position lies outside its bracket."""
    counted = settle(
        rows.withColumn("_region", _region(len(fractions)))
        .withColumns({"_bin": _bin(len(fractions)), "_v": F.when(F.col("_region") % 2 == 1, F.col("_v"))})
        .groupBy(key, "_region", "_bin", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # Which bin holds each position: a running count over the bins of a key, a fixed number.
    upto = Window.partitionBy(key).orderBy("_region", "_bin")
    places = [
        F.struct(F.lit(name).alias("name"), F.floor(F.col("n") * F.lit(f)).alias("position"))
        for name, f in fractions.items()
    ]
    targets = settle(
        counted.groupBy(key, "_region", "_bin")
        .agg(F.sum("_n").alias("_in_bin"))
        .withColumns({"_upto": F.sum("_in_bin").over(upto), "n": F.sum("_in_bin").over(Window.partitionBy(key))})
        .withColumn("_place", F.explode(F.array(*places)))
        .withColumn("_before", F.col("_upto") - F.col("_in_bin"))
        .filter((F.col("_upto") > F.col("_place.position")) & (F.col("_before") <= F.col("_place.position")))
        .select(key, "_region", "_bin", "_before", "n", "_place.name", "_place.position")
    )
    # Which value inside the bin: a running count over the values of that bin alone.
    inside = Window.partitionBy(key, "name").orderBy("_v")
    end = F.col("_before") + F.sum("_n").over(inside)
    hit = (F.col("_end") > F.col("position")) & (F.col("_end") - F.col("_n") <= F.col("position"))
    found = attach(counted, targets, [key, "_region", "_bin"], "inner").withColumn("_end", end)
    return found.groupBy(key).agg(
        F.max("n").alias("n"),
        *[F.max(F.when(hit & (F.col("name") == name), F.col("_v"))).alias(name) for name in fractions],
    )


def _region(brackets: int) -> Column:
    """Ranges in value order: before the 1st bracket, inside it, between 1st and 2nd, inside the 2nd, ..."""
    v, edges = F.col("_v"), F.col("_edges")
    region = F
    for i in range(brackets):
        region = region.when(v < edges[2 * i], F.lit(2 * i)).when(v <= edges[2 * i + 1], F.lit(2 * i + 1))
    return region.otherwise(F.lit(2 * brackets))


def _bin(brackets: int) -> Column:
    """Equal slices of a bracket, in value order."""
    v, edges = F.col("_v"), F.col("_edges")
    result = F
    for i in range(brackets):
        low, high = edges[2 * i], edges[2 * i + 1]
        share = F.when(high > low, (v - low) / (high - low)).otherwise(0.0)
        slice_ = F.least(F.floor(share * BINS), F.lit(BINS - 1))
        result = result.when(F.col("_region") == 2 * i + 1, slice_)
    return result.otherwise(F.lit(0).cast("bigint"))


def _any_null(fractions: dict[str, float]) -> Column:
    condition = F.lit(False)
    for name in fractions:
        condition = condition | F.col(name).isNull()
    return condition
