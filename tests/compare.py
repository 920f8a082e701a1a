"""Run a named query and its SQL side by side and compare the rows."""

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = []
    for values in frame[columns].itertuples(index=False):
        rows.append(tuple(None if pd.isna(v) else str(v)[:10] if hasattr(v, "year") else v for v in values))
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(spark_frame, sql: str, con) -> list[str]:
    """What differs between the two results; empty when they agree."""
    ours = spark_frame.toPandas()
    theirs = con.sql(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return [f"columns {sorted(ours.columns)} against {sorted(theirs.columns)}"]
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} against {len(theirs)}"]
    left, right = _plain(ours), _plain(theirs)
    return [f"{a} against {b}" for a, b in zip(left, right) if a != b]
