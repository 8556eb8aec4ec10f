"""Compares queries with their SQL in DuckDB."""

import math
import os

import duckdb


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def connected(sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def same(con, df, sql):
    columns = sorted(df.columns)
    found = con.sql(sql)
    assert sorted(found.columns) == columns
    at = [found.columns.index(c) for c in columns]
    ours = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=repr)
    theirs = sorted((tuple(norm(r[i]) for i in at) for r in found.fetchall()), key=repr)
    assert ours == theirs
