"""Columns that look a few rows back in a time series, without one task per hot series.

A window over (device, sensor type) sorts each series in one task. That is right for many small series
and wrong for one that holds a large part of all rows. ``over_series`` first counts rows per hash bucket
of the series key (at most ``BUCKETS`` small groups, combined map-side). Only series in buckets above the
row limit are cut into chunks, at times taken from quantile sketches, so uneven times and stray clocks do
not matter: a chunk above the limit is cut again. One that holds a single time is cut at values of the
second order column, taken from a small sample by hash; only rows equal in both stay together. Inside a chunk
the window is exact except for the first ``halo`` rows; those are recomputed from the first and last ``halo``
rows of all chunks of the series, which are few. ``numbered`` counts along a series the same way: within
chunks, plus the rows of the chunks before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BUCKETS = 1 << 16
HOT_ROWS = 2_000_000
#: Parts that a chunk is cut into at once; each cut may add one more for a time that many rows share.
PARTS = 32

#: Rows that are looked at to cut a chunk of one single time.
SAMPLE = 8 * PARTS


class Level(NamedTuple):
    """One cut of all chunks above the limit: (bucket, chunk, time in microseconds, where it is cut before).

    ``by_time`` cuts are times in microseconds; the others are values of the second order column, for the rows of ``time``.
    """

    by_time: bool
    cuts: list[tuple[int, int, int | None, list]]


def over_series(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    halo: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``columns(window)`` to every row.

    ``order[0]`` is a timestamp column. The expressions may reach at most ``halo`` rows back and none
    forward.
    """
    levels = hot_cuts(rows, keys, order, hot_rows)
    if not levels:
        return rows.withColumns(columns(Window.partitionBy(*keys).orderBy(*order)))

    bucketed = rows.withColumn("_bucket", _bucket(keys))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(*order)
    late_head = F.lag(F.lit(1), halo).over(inside).isNull() & (F.col("_chunk") > 0)

    every = chunked(bucketed, levels, order)
    done = every.withColumns(columns(inside) | {"_late_head": late_head}).filter(~F.col("_late_head"))

    # Only rows of hot buckets move a second time, and only the ends of their chunks reach the last window.
    tail = F.lead(F.lit(1), halo).over(inside).isNull()
    head = F.lag(F.lit(1), halo).over(inside).isNull()
    edges = (
        chunked(_of_hot(bucketed, levels), levels, order)
        .withColumns({"_late_head": late_head, "_edge": head | tail})
        .filter("_edge")
    )
    fixed = edges.withColumns(columns(across)).filter("_late_head")
    own = ("_bucket", "_chunk", "_late_head", "_edge")
    return done.drop(*own).unionByName(fixed.drop(*own))


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add each row's number in its series, from 1. ``order[0]`` is a timestamp column."""
    levels = hot_cuts(rows, keys, order, hot_rows)
    if not levels:
        return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))
    parts = [*keys, "_chunk"]
    every = chunked(rows.withColumn("_bucket", _bucket(keys)), levels, order)
    inside = F.row_number().over(Window.partitionBy(*parts).orderBy(*order))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = every.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.sum("_n").over(before))
    # null-safe, as a series may have null keys; only chunks behind another have anything to add
    later = counts.filter("_before IS NOT NULL").select(*[F.col(c).alias(f"_of_{c}") for c in parts], "_before")
    same = [every[c].eqNullSafe(later[f"_of_{c}"]) for c in parts]
    found = every.withColumn("_inside", inside).join(later, same, "left")
    number = F.col("_inside") + F.coalesce("_before", F.lit(0))
    return found.withColumn(name, number.cast("bigint")).select(*rows.columns, name)


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))


def hot_cuts(rows: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int) -> list[Level]:
    """The cuts of the buckets above the limit, then of their chunks above the limit, and so on.

    At most BUCKETS counts come back. The limit is at least four times the mean of those, so at most a
    quarter of BUCKETS buckets or chunks are above it, and every level stays as small.
    """
    ts = order[0]
    bucketed = rows.select(_bucket(keys).alias("_bucket"), *order[:2])
    counted = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max(hot_rows, 1)).collect()
    limit = max(hot_rows, 1, 4 * sum(r.n for r in counted) // BUCKETS)
    hot = [(r["_bucket"], 0, None, []) for r in counted if r.n > limit]
    if not hot:
        return []

    at = F.unix_micros(ts)
    inner = [i / PARTS for i in range(1, PARTS)]
    hot_rows_of = _of_hot(bucketed, [Level(True, hot)])
    levels: list[Level] = []
    done: set[tuple[int, int]] = set()
    while True:
        large = (
            chunked(hot_rows_of, levels, order)
            .groupBy("_bucket", "_chunk")
            .agg(
                F.count(at).alias("n"),
                F.min(at).alias("first"),
                F.max(at).alias("last"),
                F.percentile_approx(at, inner, 32 * PARTS).alias("times"),
            )
            .filter(F.col("n") > limit)
            .collect()
        )
        large = [r for r in large if (r["_bucket"], r["_chunk"]) not in done]
        wide = [r for r in large if r["first"] < r["last"]]
        if wide:
            levels.append(Level(True, [(r["_bucket"], r["_chunk"], None, _between(r["times"], r["first"], r["last"])) for r in wide]))
            done = {(bucket, chunk * 2 * PARTS) for bucket, chunk in done}  # a level renumbers the chunks it doesn't cut
            continue
        if not large or len(order) < 2:
            return levels
        level = Level(False, _ties(chunked(hot_rows_of, levels, order), large, order))
        if not level.cuts:
            return levels
        levels.append(level)
        # each is cut by values once: what is left of it in one chunk is equal in both columns, or nearly so
        done = {(bucket, chunk * 2 * PARTS) for bucket, chunk in done | {(r["_bucket"], r["_chunk"]) for r in large}}
        done |= {(bucket, chunk * 2 * PARTS + i) for bucket, chunk, _, cuts in level.cuts for i in range(len(cuts) + 1)}


def _ties(chunks: DataFrame, large: list, order: Sequence[str]) -> list[tuple[int, int, int, list]]:
    """Values of the second order column that cut chunks of one single time evenly, from about SAMPLE rows of each by hash."""
    range_ = 1 << 30
    spark = chunks.sparkSession
    share = [(r["_bucket"], r["_chunk"], r["first"], -(-range_ * SAMPLE // r["n"])) for r in large]
    wanted = F.broadcast(spark.createDataFrame(share, "_bucket bigint, _chunk bigint, _time bigint, _share bigint"))
    taken = chunks.join(wanted, ["_bucket", "_chunk"]).filter(
        (F.pmod(F.xxhash64(order[1]), F.lit(range_)) < F.col("_share")) & (F.unix_micros(order[0]) == F.col("_time"))
    )
    out = []
    for r in taken.groupBy("_bucket", "_chunk", "_time").agg(F.sort_array(F.collect_list(order[1])).alias("values")).collect():
        values = r["values"]
        # every value of a chunk may be the least one, which cuts nothing off; the set is ordered as Spark orders
        picks = [values[len(values) * i // PARTS] for i in range(1, PARTS)] if values else []
        cuts = [v for i, v in enumerate(picks) if i == 0 or v != picks[i - 1]]
        if cuts:
            out.append((r["_bucket"], r["_chunk"], r["_time"], cuts))
    return out


def _between(times: list[int], first: int, last: int) -> list[int]:
    """Cuts before and after each time; never none, as ``first`` is less than ``last``."""
    return sorted({cut for t in times for cut in (t, t + 1) if first < cut <= last})


def _of_hot(bucketed: DataFrame, levels: list[Level]) -> DataFrame:
    hot = bucketed.sparkSession.createDataFrame([(bucket,) for bucket, *_ in levels[0].cuts], "_bucket bigint")
    return bucketed.join(F.broadcast(hot), "_bucket", "left_semi")


def _not_above(value: Column) -> Callable[[Column], Column]:
    return lambda cut: cut <= value


def chunked(bucketed: DataFrame, levels: list[Level], order: Sequence[str]) -> DataFrame:
    """Add ``_chunk``, which rises along the order within a bucket; rows without a time are in chunk 0."""
    bucketed = bucketed.withColumn("_chunk", F.lit(0).cast("bigint"))
    at = F.unix_micros(order[0])
    for level in levels:
        kind = "bigint" if level.by_time else bucketed.schema[order[1]].dataType.simpleString()
        cuts = F.broadcast(
            bucketed.sparkSession.createDataFrame(level.cuts, f"_bucket bigint, _chunk bigint, _time bigint, _cuts array<{kind}>")
        )
        passed = F.size(F.filter("_cuts", _not_above(at if level.by_time else F.col(order[1]))))
        here = F.col("_cuts").isNotNull() if level.by_time else F.col("_time") == at
        bucketed = (
            bucketed.join(cuts, ["_bucket", "_chunk"], "left")
            .withColumn("_chunk", F.col("_chunk") * (2 * PARTS) + F.when(here, passed).otherwise(0))
            .drop("_cuts", "_time")
        )
    return bucketed
