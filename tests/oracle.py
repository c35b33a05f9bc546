"""Registered queries against their SQL in DuckDB."""

import os

import duckdb
import pandas as pd

SF_DIR = "/root/testdata/sf0.001"


def connect():
    con = duckdb.connect()
    for f in os.listdir(SF_DIR):
        if f.endswith(".parquet"):
            con.execute(f"create view {f[:-8]} as select * from read_parquet('{SF_DIR}/{f}')")
    return con


def plain(value):
    if value is None or value is pd.NA or value != value:
        return "null"
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return str(value)


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(plain, r)) for r in frame.astype(object).itertuples(index=False))


def compare(spark, query, sql):
    got, want = query(spark, SF_DIR).toPandas(), connect().sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows_of(got), rows_of(want)
    number = lambda rows: [tuple(x[:-2] if x.endswith(".0") else x for x in r) for r in rows]
    assert sorted(number(a)) == sorted(number(b))
