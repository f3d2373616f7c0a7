"""A corpus from raw documents to token files: five stages, each one of the operators of ``sensorflow.llm``.

Every stage reads what the one before it kept, written as Parquet; the last returns a digest of each document in the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorflow.llm import contamination, mixing, near, rules, tokens
from sensorflow.llm.frames import read, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return rules.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the least id."""
    return near.one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark go."""
    return contamination.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, up to three times each document, a row for each time."""
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bit-packed token files, and for each document in them its place and a checksum of its ids."""
    return tokens.tokens_written(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mix),
    ("token_output", token_output),
]

#: Near-duplicates and token ids cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
