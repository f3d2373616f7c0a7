"""Vectors as short codes: per part of the vector the number of its codebook's nearest entry, codebooks found by Lloyd's rounds.

Components become integers, so that every sum and distance is exact and no order of rows matters. The parts are written once in
blocks, each in the order of its tree. A round is one job over the blocks: every task walks its trees and that of the entries
together (``dualtree``) and returns one sum for each component of each entry; the codebooks, some thousand numbers whatever the
table's size, come to the driver. The last step codes the rows themselves, a tree for each batch of rows.

Vectors that are null or hold null, NaN or infinite components are dropped, and so are those whose length isn't the table's most
common one among the multiples of ``parts`` (of equally common ones the largest). Components beyond 2**27 count as that. Rows
without an id are coded, but start no codebook while there are rows with one; among equal ids the lesser vector starts it first.
Fewer rows than entries give smaller codebooks, an empty table no rows. Extra columns pass through; ``code`` and ``error`` of the
input are replaced. Equal rows get equal codes, rows without a label share one label.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.llm import dualtree
from sensorflow.llm.frames import in_arrow, read, stored

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LIMIT = 1 << 27
BLOCK = 4096
#: Labels up to which their sums are broadcast; beyond, rows are salted and the sums copied to each salt.
LABELS = 100_000
SALTS = 16


@dataclass
class Codebooks:
    """``entries[part, entry]`` is one entry; all components are integers, ``scale`` times the vectors'."""

    entries: np.ndarray
    scale: int = SCALE

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def vectors(self, codes: list[str]) -> np.ndarray:
        """What the codes stand for, in the vectors' own scale."""
        numbers = np.array([list(bytes.fromhex(c)) for c in codes], np.int64).reshape(len(codes), len(self.entries))
        return np.concatenate([book[numbers[:, p]] for p, book in enumerate(self.entries)], axis=1) / self.scale


def _finite(vector: Column) -> Column:
    def odd(x: Column) -> Column:
        wide = x.cast("double")
        return x.isNull() | F.isnan(wide) | (F.abs(wide) == float("inf"))

    return vector.isNotNull() & ~F.exists(vector, odd)


def usable(rows: DataFrame, vector: str, parts: int) -> tuple[DataFrame, int]:
    """The rows with whole vectors of the table's length as (whole, vector), ``whole`` without the vector; and that length."""
    others = F.struct(*[rows[f"`{c}`"] for c in rows.columns if c != vector])
    good = rows.select(others.alias("whole"), rows[f"`{vector}`"].alias("vector")).where(_finite(F.col("vector")))
    sizes = good.select(F.size("vector").alias("size")).where((F.col("size") > 0) & (F.col("size") % parts == 0))
    first = sizes.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    width = first[0]["size"] if first else 0
    return good.where(F.size("vector") == width), width


def _integers(vectors: pa.Array, width: int, scale: int) -> np.ndarray:
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    return np.clip(np.floor(values * scale), -LIMIT, LIMIT).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], width: int, parts: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Up to BLOCK vectors as one row: for each part all points in the order of their tree, and the tree's bounds."""
    held, size = [], 0
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK):
            some = _integers(batch.column(0).slice(begin, BLOCK), width, scale)
            held.append(some)
            size += len(some)
            if size >= BLOCK:
                yield _block(np.concatenate(held), parts)
                held, size = [], 0
    if held:
        yield _block(np.concatenate(held), parts)


def _block(vectors: np.ndarray, parts: int) -> pa.RecordBatch:
    points, levels = [], []
    for part in np.split(vectors, parts, axis=1):
        order, bounds, children = dualtree.split(part, dualtree.LEAF)
        points.append(part[order].astype("<i4").tobytes())
        levels.append([x.tolist() for pair in zip(bounds, [*children, np.zeros(0, np.int64)], strict=True) for x in pair])
    return pa.RecordBatch.from_pydict({"points": [points], "levels": pa.array([levels], pa.list_(pa.list_(pa.list_(pa.int64()))))})


BLOCKS = "points array<binary>, levels array<array<array<bigint>>>"


def _gathered(batches: Iterator[pa.RecordBatch], entries: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of the points that each entry is nearest to, over all blocks of a task: (slot, sum), the last component a count."""
    parts, many, wide = entries.shape
    total = np.zeros((parts, many, wide + 1), np.int64)
    for batch in batches:
        for points, levels in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for part in range(parts):
                inside = np.frombuffer(points[part], "<i4").astype(np.int64).reshape(-1, wide)
                bounds = [np.array(x, np.int64) for x in levels[part][::2]]
                children = [np.array(x, np.int64) for x in levels[part][1:-1:2]]
                tree = dualtree.planted(inside, np.arange(len(inside)), bounds, children)
                _, sums, counts, _ = dualtree.nearest(tree, entries[part])
                total[part, :, :-1] += sums
                total[part, :, -1] += counts
    flat = total.ravel()
    slots = np.flatnonzero(flat)
    yield pa.RecordBatch.from_pydict({"slot": slots, "value": flat[slots]})


def _coded(batches: Iterator[pa.RecordBatch], entries: np.ndarray, scale: int) -> Iterator[pa.RecordBatch]:
    parts, _, wide = entries.shape
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK):
            some = batch.slice(begin, BLOCK)
            vectors = _integers(some.column(1), parts * wide, scale)
            codes, errors = np.empty((len(vectors), parts), np.uint8), np.zeros(len(vectors), np.int64)
            for part, points in enumerate(np.split(vectors, parts, axis=1)):
                chosen, *_ = dualtree.nearest(dualtree.grow(points), entries[part])
                codes[:, part] = chosen
                errors += ((points - entries[part][chosen]) ** 2).sum(axis=1)
            texts = [row.tobytes().hex() for row in codes]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(texts), pa.array(errors)], ["whole", "code", "error"])


def fit(rows: DataFrame, width: int, order: list[Column], parts: int, entries: int, rounds: int, scale: int) -> Codebooks:
    """Codebooks of the vectors in ``rows`` (whole, vector); the first ones are the rows that come first in ``order``."""
    seeds = rows.orderBy(*order).limit(entries).select("vector").toArrow().column(0).combine_chunks()
    first = _integers(seeds, width, scale)
    books = np.stack(np.split(first, parts, axis=1))
    blocks = stored(in_arrow(rows.select("vector"), partial(_blocks, width=width, parts=parts, scale=scale), BLOCKS), "vector-blocks")
    for _ in range(rounds):
        sums = in_arrow(blocks, partial(_gathered, entries=books), "slot bigint, value bigint")
        total = np.zeros((parts, len(first), width // parts + 1), np.int64)
        for slot, value in sums.groupBy("slot").agg(F.sum("value").alias("value")).collect():
            total.flat[slot] = value
        counts = total[:, :, -1:]
        before, books = books, np.where(counts > 0, total[:, :, :-1] // np.maximum(counts, 1), books)
        if (before == books).all():  # all later rounds would give the same
            break
    return Codebooks(books, scale)


def compress(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks | None]:
    """The rows with ``code`` and ``error`` instead of their vector, and the codebooks (none without a usable vector).

    At most 256 entries, since a part's code is one byte.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte for a part: 1 to 256 entries")
    good, width = usable(rows, vector, parts)
    others = [f for f in rows.schema.fields if f.name not in (vector, "code", "error")]
    passed = [F.col("whole")[f.name].alias(f.name) for f in others]
    if not width:
        return good.select(*passed, F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")), None
    books = fit(good, width, [F.asc_nulls_last(F.col("whole")[key]), F.asc("vector")], parts, entries, rounds, scale)
    schema = T.StructType([good.schema["whole"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    coded = in_arrow(good, partial(_coded, entries=books.entries, scale=scale), schema)
    return coded.select(*passed, "code", "error"), books


def with_group_sum(rows: DataFrame, group: str, value: str, name: str, labels: int = LABELS) -> DataFrame:
    """Adds the sum of ``value`` over all rows of the same group. Rows move only if there are very many groups, and salted then."""
    total = stored(rows.groupBy(F.col(group).alias("_group")).agg(F.sum(value).alias(name)), "group-sums")
    if total.limit(labels + 1).count() <= labels:
        return rows.join(F.broadcast(total), F.col(group).eqNullSafe(F.col("_group")), "left").drop("_group")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*[c for c, t in rows.dtypes if not t.startswith("map")]), F.lit(SALTS)))
    copies = total.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_salt") == F.col("_copy"))
    return salted.join(copies, same, "left").drop("_group", "_salt", "_copy")


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    coded, books = compress(read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    rows = with_group_sum(stored(coded, "vector-codes"), "label", "error", "label_error")
    digest = F.lit(books.digest() if books else None).cast("string")
    return rows.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))
