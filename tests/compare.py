"""Comparing a Spark result with the same query in DuckDB, whatever the row order."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def canonical(value):
    if value is None or value is pd.NA or value is pd.NaT:
        return None
    if isinstance(value, float) and value != value:
        return None
    if hasattr(value, "item"):
        value = value.item()
    return value


def rows(frame: pd.DataFrame) -> Counter:
    columns = sorted(frame.columns)
    ordered = frame[columns].astype(object)
    return Counter(tuple(map(canonical, row)) for row in ordered.itertuples(index=False, name=None))


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None when both hold the same rows, otherwise a short description."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    ours, theirs = rows(spark_frame), rows(sql_frame)
    if ours == theirs:
        return None
    return (
        f"{len(spark_frame)} rows != {len(sql_frame)} rows, e.g. "
        f"{list((ours - theirs).items())[:2]} != {list((theirs - ours).items())[:2]}"
    )
