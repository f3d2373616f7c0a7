"""Run a query in Spark and its twin in DuckDB and compare the rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            frame[name] = column.astype("datetime64[us]").astype(str)
        elif pd.api.types.is_float_dtype(column) or pd.api.types.is_integer_dtype(column):
            frame[name] = column.astype("float64").map(repr)
        else:
            frame[name] = column.map(lambda x: "<null>" if x is None or x is pd.NaT or x != x else str(x))
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str:
    """Empty when both hold the same rows."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    a, b = normal(ours), normal(theirs)
    for name in a.columns:
        unequal = a[name] != b[name]
        if unequal.any():
            at = unequal.idxmax()
            return f"{name}: {int(unequal.sum())} differ, first {a.loc[at].to_dict()} != {b.loc[at].to_dict()}"
    return ""
