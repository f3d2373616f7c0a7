"""Line dedup: lines found in many documents are dropped everywhere.

Lines are normalised, hashed and exploded; documents are counted per hash with a partial count before the shuffle, so a line
that a third of all documents hold is one row per task there. Only (row key, position) of the lines to drop travels back to the
documents, where the kept lines are put together by position. DataFrame functions only.

Null and empty texts are one empty line. Equal rows are separate documents in the counts and get equal results. A key shorter
than ``min_chars`` is never dropped. Extra columns pass through ``dedup_lines`` unchanged; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.frames import BLANKS, LOWER, UPPER, let, packed, read, row_key

MIN_DOCUMENTS = 10


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(text: Column, min_chars: int) -> Column:
    """128 bits in hex per line, null where the key is too short."""

    def hashed(line: Column) -> Column:
        key = line_key(line)
        return F.when(F.length(key) >= min_chars, F.md5(key))

    return F.transform(lines_of(text), hashed)


def common_hashes(texts: DataFrame, min_documents: int, min_chars: int) -> DataFrame:
    """Hashes found in at least ``min_documents`` rows."""
    once = texts.select(F.explode(F.array_distinct(line_hashes(F.col("text"), min_chars))).alias("hash"))
    counted = once.where("hash is not null").groupBy(F.unhex("hash").alias("hash")).agg(F.count("*").alias("documents"))
    return counted.where(F.col("documents") >= min_documents).select("hash")


def dropped_lines(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = 1
) -> DataFrame:
    """Each row as ``whole``, with its lines' count and the positions of the lines to drop (null if there are none)."""
    one, two = row_key("key_1", "key_2", "doc_id", "text")
    rows = packed(docs, "doc_id", "text")
    at = F.posexplode(line_hashes(F.col("text"), min_chars)).alias("position", "hash")
    found = rows.select(one, two, at).where("hash is not null").withColumn("hash", F.unhex("hash"))
    common = common_hashes(rows.select("text"), min_documents, min_chars)
    gone = found.join(common, "hash", "left_semi").groupBy("key_1", "key_2").agg(F.collect_set("position").alias("gone"))
    return rows.select("whole", "text", one, two).join(gone, ["key_1", "key_2"], "left").select("whole", "text", "gone")


def kept_text(text: Column, gone: Column) -> Column:
    """The lines whose positions are not in ``gone``, joined by a line feed."""

    def joined(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")


    return F.when(gone.isNull(), F.coalesce(text, F.lit(""))).otherwise(let(lines_of(text), joined))


def dedup_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_chars: int = 1) -> DataFrame:
    """The documents with their common lines dropped; all columns stay, a null text without dropped lines stays null."""
    rows = dropped_lines(docs, min_documents, min_chars)
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept_text(F.col("text"), F.col("gone")))
    return rows.select(F.col("whole").withField("text", text).alias("whole")).select("whole.*")


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:

    rows = dropped_lines(read(spark, sf_dir, "documents"), MIN_DOCUMENTS, 1)
    return rows.select(
        F.col("whole.doc_id").alias("doc_id"),
        F.size(lines_of(F.col("text"))).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.sha2(kept_text(F.col("text"), F.col("gone")), 256).alias("kept_sha256"),
    )
