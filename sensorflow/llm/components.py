"""Connected components of a graph of links, by alternating star operations on tables in the shared folder.

Each step hangs neighbours below the least node they know. Steps are joins and grouped minima whose counts shrink before the
shuffle; links to a hub are split by adaptive execution. The result is found when a step changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.frames import stored


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(_least(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    moved = down.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, label: the least node that can be reached. ``links`` has a and b; nodes without a link do not appear."""
    links = stored(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = _fingerprint(links)
    while True:
        links = stored(_small_star(_large_star(links)), "links")
        found = _fingerprint(links)
        if found == seen:
            break
        seen = found
    below = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return below.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
