"""Compares a query with its SQL on DuckDB: columns by name, rows as a multiset."""

import os
from collections import Counter

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(d):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{d}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and pd.isna(v)) or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return bool(v)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (int, float)):
        return float(v)
    return str(v)


def rows(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(_cell(v) for v in r) for r in df[cols].itertuples(index=False, name=None))


def same(spark_df, con, sql):
    ca, a = rows(spark_df.toPandas())
    cb, b = rows(con.execute(sql).df())
    assert ca == cb
    assert a == b, (list((a - b).items())[:3], list((b - a).items())[:3])
