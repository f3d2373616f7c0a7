"""Small helpers that the operators share: reading tables, keys of rows, tables in the shared folder."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import sensorflow
from sensorflow.session import fresh_folder

#: The white space of the contracts, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\f\r"
WORD_BREAK = "[ \\t-\\r]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def row_key(first: str, second: str, *values: Column | str) -> tuple[Column, Column]:
    """128 bits that stand for a row's id and text; equal rows share them, and every operator treats equal rows alike."""
    return F.xxhash64(*values).alias(first), F.xxhash64(F.lit(7919), *values).alias(second)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, and only if the result is needed."""
    return F.transform(F.array(value), body)[0]


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder; a plain path is a local one."""
    return pyarrow.fs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else f"file://{uri}")


def ship(spark: SparkSession) -> None:
    """Gives this package to the executors' Python, once per context, as a zip file in the shared folder."""
    context = spark.sparkContext
    if getattr(context, "_sensorflow_shipped", False):
        return
    home = Path(sensorflow.__file__).parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as bundle:
        for path in sorted(home.rglob("*.py")):
            bundle.write(path, path.relative_to(home.parent))
    folder = fresh_folder(spark, "package")
    files, path = filesystem(folder)
    files.create_dir(path, recursive=True)
    with files.open_output_stream(f"{path}/sensorflow_package.zip") as out:
        out.write(data.getvalue())
    context.addPyFile(f"{folder}/sensorflow_package.zip")
    context._sensorflow_shipped = True


def in_arrow(rows: DataFrame, function: Callable, schema: str | T.StructType) -> DataFrame:
    """mapInArrow with this package at hand on the executors."""
    ship(rows.sparkSession)
    return rows.mapInArrow(function, schema)


def packed(docs: DataFrame, *wanted: str) -> DataFrame:
    """The wanted columns beside the whole row as one struct, so that no extra column can clash with ours."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("whole"), *[F.col(c) for c in wanted])


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("whole.*")


def stored(rows: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes rows to a new table in the shared folder and reads it again: cuts the lineage and survives lost executors."""
    spark = rows.sparkSession
    path = fresh_folder(spark, name)
    rows.write.options(**options).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 1 << 22, *more: str) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``limit`` bytes of text (of all columns named together), one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = sum(pa.compute.fill_null(pa.compute.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype("int64") for c in (text, *more))
        begin = held = 0
        for row, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += int(size) + 64
        yield batch.slice(begin)
