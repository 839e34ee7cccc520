"""Order-insensitive comparison of a Spark result with DuckDB's result of the oracle SQL."""

from __future__ import annotations

import hashlib
import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v.is_integer() and abs(v) < 2**53:
            return str(int(v))
        return repr(float(v))
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(canon(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return canon(v.tolist())
    return str(v)


def digest(df: pd.DataFrame):
    """(row count, sorted column names, hash of the sorted canonical rows, rows)."""
    cols = sorted(df.columns)
    frame = df[cols].astype(object).where(df[cols].notna(), None)
    rows = sorted("|".join(canon(r[c]) for c in cols) for r in frame.to_dict("records"))
    return len(rows), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()[:16], rows
