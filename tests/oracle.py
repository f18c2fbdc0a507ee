"""Compares a query with its SQL in DuckDB, as sorted rows with sorted columns."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df: pd.DataFrame) -> list:
    def plain(x):
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and np.isnan(x)):
            return None
        if isinstance(x, (bool, np.bool_)):
            return bool(x)
        if isinstance(x, (int, float, np.integer, np.floating)):
            return round(float(x), 6) + 0.0
        return str(x)

    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


def answer(sql: str, sf: str = SF) -> pd.DataFrame:
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con.execute(sql).df()


def assert_same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows(got), rows(want)
    assert len(a) == len(b)
    assert a == b, next((x, y) for x, y in zip(a, b, strict=True) if x != y)
