"""Joins whose broadcast side is counted first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.session import ensure_checkpoint_dir

# Rows and characters (as JSON) up to which a written, counted side is broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 100_000_000


def settle(frame: DataFrame) -> DataFrame:
    """Write an aggregate that several later steps read, so that it is computed once."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def attach(rows: DataFrame, settled: DataFrame, key: str | list[str], how: str = "left") -> DataFrame:
    """Join ``rows`` with a settled table of one row per key.

    Broadcast when the measured size allows it; otherwise a plain equi-join, where adaptive execution
    splits the partitions of hot keys (the settled side has one row per key to copy).
    """
    size = F.sum(F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in settled.columns]))))
    many, chars = settled.limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)), size).first()
    if many <= BROADCAST_ROWS and (chars or 0) <= BROADCAST_CHARS:
        settled = F.broadcast(settled)
    return rows.join(settled, key, how)
