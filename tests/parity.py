"""Spark's rows against DuckDB's."""

import os

import duckdb
import pandas as pd


def connect(d):
    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for t in os.listdir(d):
        c.sql(f"create view {t[:-8]} as select * from '{d}/{t}'")
    return c


def rows(df):
    df = df[sorted(df.columns)]

    def value(x):
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
            return None
        if isinstance(x, (int, float)) and not isinstance(x, bool):
            return round(float(x), 6)
        return str(x)

    return sorted((tuple(value(x.item() if hasattr(x, "item") else x) for x in r) for r in df.itertuples(index=False)), key=repr)
