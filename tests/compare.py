"""Equality of a Spark result and a DuckDB result, whatever the order of rows and columns."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        path += "/*.parquet" if os.path.isdir(path) else ""
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    def plain(x):
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
            return None
        return str(float(x)) if not isinstance(x, (str, bytes, bool)) and hasattr(x, "__float__") else str(x)

    df = df[sorted(df.columns)]
    df = pd.DataFrame({c: [plain(x) for x in df[c].astype(object)] for c in df.columns})
    return df.sort_values(list(df.columns), key=lambda s: s.astype(str)).reset_index(drop=True)
