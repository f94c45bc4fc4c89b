"""Runs a query and its SQL and compares rows as multisets of strings."""

import os
from collections import Counter

import duckdb


def rendered(value):
    if value is None or value != value:
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value:.6f}"
    if hasattr(value, "as_tuple"):
        return f"{float(value):.6f}" if value % 1 else str(int(value))
    return str(value)


def differences(df, sql, sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{sf_dir}/{f}')")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns), (sorted(names), sorted(df.columns))
    order = sorted(names)
    want = Counter(tuple(rendered(r[names.index(c)]) for c in order) for r in cursor.fetchall())
    got = Counter(tuple(rendered(r[c]) for c in order) for r in df.collect())
    return got, want
