"""Comparison of a query with its reference SQL."""

import os
from collections import Counter

import duckdb


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(folder):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{name}'")
    return con


def norm(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(map(norm, value))
    return value


def compare(df, con, sql):
    columns = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in columns) for r in df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = Counter(tuple(norm(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert got == want
