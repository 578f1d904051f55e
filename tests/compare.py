"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = []
    for row in frame[columns].itertuples(index=False):
        rows.append(tuple(_plain(x) for x in row))
    return sorted(rows, key=repr)


def _plain(x):
    if x is None or x is pd.NA or (isinstance(x, float) and x != x):
        return None
    if hasattr(x, "item"):
        x = x.item()
    if isinstance(x, bool):
        return x
    if isinstance(x, (int, float)):
        return float(x) + 0.0
    return x


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} != {len(sql_frame)}"
    left, right = canonical(spark_frame), canonical(sql_frame)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
