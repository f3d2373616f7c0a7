"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a shuffled order, repeated at most ``REPEATS`` times. The virtual finish time of a
copy is the number of its source's words up to and with it, divided by the source's target; all copies are sorted by it and
taken until the budget is spent. Running sums come in two levels (sums per slice of the shuffled order, then inside a slice), so
a source with a third of all rows is many small groups; the place where the budget ends is found from a histogram of finish
times and one bucket of it.

Documents without a source form one source of their own, the last. Null and empty texts have size 0: they are taken with the
word that follows them. Rows equal in id, source and text are one entry of their common size and get equal results. The shuffle
is an md5 of the row, so reruns agree. An empty table gives an empty mix; extra columns pass through ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.llm.frames import packed, read, stored
from sensorflow.llm.rules import n_words

WEIGHTS = (1, 2, 3)
REPEATS = 3
#: Slices hold about this many rows while there are fewer than MOST_SLICES of them.
SLICE_ROWS = 256
MOST_SLICES = 1 << 20


def entry_key(salt: str = "") -> Column:
    """32 hex digits of id, source and text: names the entry, and is its place in the shuffled order."""

    def shown(c: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))

    return F.md5(F.concat_ws("/", F.lit(salt), shown("doc_id"), shown("source"), F.md5(F.coalesce("text", F.lit("")))))


def place(key: Column, slices: int) -> Column:
    """Slice of the shuffled order, increasing with the key."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") * F.lit(slices) / F.lit(float(1 << 32)))


def targets(sizes: DataFrame, weights: tuple[float, ...], repeats: int) -> DataFrame:
    """One row per source: its size and target. Targets are weight times one level, cut at ``repeats`` times the size.

    The level is the first one, by rising ratio of cut to weight, that its own source does not exceed.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1, F.lit(len(weights)))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), turn)
    ranked = sources.select("*", weight.alias("weight"), (F.lit(repeats) * F.col("source_size")).alias("cut"))
    rising = Window.orderBy(F.col("cut") / F.col("weight"), F.asc_nulls_last("source"))
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("cut").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - before) / rest
    fits = ranked.withColumn("level", level).withColumn("level", F.when(F.col("level") * F.col("weight") <= F.col("cut"), F.col("level")))
    found = F.first("level", ignorenulls=True).over(rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return fits.select(
        "source",
        "source_size",
        F.least(F.col("cut").cast("double"), found * F.col("weight")).alias("target"),
    )


def entries(sizes: DataFrame) -> DataFrame:
    """Equal rows as one entry. ``sizes`` has key, source and size per row."""
    return sizes.groupBy("key", "source").agg(F.sum("size").alias("size"))


def finish_times(queue: DataFrame, goal: DataFrame, slices: int, repeats: int) -> DataFrame:
    """key, size, copy, finish for each copy of each entry."""
    queue = queue.withColumn("slice", place(F.col("key"), slices))
    sums = queue.groupBy("source", "slice").agg(F.sum("size").alias("held"))
    rising = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "slice", F.coalesce(F.sum("held").over(rising), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "slice").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    placed = queue.withColumn("inside", F.sum("size").over(inside))
    start = sums.join(goal, sums["source"].eqNullSafe(goal["source"])).select(
        sums["source"].alias("of"), F.col("slice").alias("at"), "before", "source_size", "target"
    )
    rows = placed.join(start, placed["source"].eqNullSafe(start["of"]) & (placed["slice"] == start["at"]))
    rows = rows.where("target > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    words = F.col("copy") * F.col("source_size") + F.col("before") + F.col("inside")
    return rows.select("key", "size", "copy", (words / F.col("target")).alias("finish"))


def within_budget(copies: DataFrame, budget: DataFrame, buckets: int) -> DataFrame:
    """The copies, by finish time, whose sizes add up to the budget at most. ``budget`` is one row."""
    copies = copies.withColumn("bucket", F.least(F.floor(F.col("finish") * buckets), F.lit(2 * buckets)))
    counts = copies.groupBy("bucket").agg(F.sum("size").alias("held"))
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("through", F.sum("held").over(running)).join(F.broadcast(budget))
    last = counts.where(F.col("through") > F.col("budget")).agg(
        F.min("bucket").alias("last"), F.min_by(F.col("through") - F.col("held"), "bucket").alias("before"), F.max("budget").alias("budget")
    )
    marked = copies.join(F.broadcast(last))
    whole = marked.where(F.col("last").isNull() | (F.col("bucket") < F.col("last")))
    order = Window.orderBy("finish", "key", "copy").rowsBetween(Window.unboundedPreceding, 0)
    split = marked.where(F.col("bucket") == F.col("last")).withColumn("through", F.col("before") + F.sum("size").over(order))
    columns = ["key", "size", "copy", "finish"]
    return whole.select(*columns).unionByName(split.where(F.col("through") <= F.col("budget")).select(*columns))


def schedule(sizes: DataFrame, weights=WEIGHTS, repeats: int = REPEATS, share: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """The copies that the mix takes (key, size, copy, finish) and the targets. ``sizes``: a stored table of key, source, size."""
    slices = min(MOST_SLICES, max(64, sizes.count() // SLICE_ROWS))
    goal = targets(sizes, weights, repeats)
    budget = sizes.agg(F.floor(F.coalesce(F.sum("size"), F.lit(0)) * F.lit(share)).alias("budget"))
    return within_budget(finish_times(entries(sizes), goal, slices, repeats), budget, slices), goal


def sized(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), entry_key().alias("key"))
    return stored(rows, "mixing-sizes")


def mix(docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """The documents of the mix in the order of their finish times; a document taken twice is there twice."""
    taken, _ = schedule(sized(docs).select("key", "source", "size"), weights, repeats)
    rows = packed(docs, "doc_id", "source", "text").select("whole", entry_key().alias("key"))
    return rows.join(taken, "key").orderBy("finish", "key", "copy").select("whole.*")


def op3_source_mixing(spark, sf_dir: str) -> DataFrame:
    docs = sized(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    taken, goal = schedule(docs.select("key", "source", "size"))
    copies = taken.groupBy("key").agg(F.count("*").alias("copies"))
    goal = goal.withColumnRenamed("source", "of")
    rows = docs.join(copies, "key", "left").join(goal, F.col("source").eqNullSafe(F.col("of")))
    return rows.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.coalesce("copies", F.lit(0))).alias("taken"),
        "source",
        F.coalesce("copies", F.lit(0)).alias("copies"),
    )
