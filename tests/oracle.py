"""A query beside its DuckDB SQL over the same tables."""

from __future__ import annotations

import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in os.listdir(folder):
        path = f"{folder}/{f}" + ("/*.parquet" if os.path.isdir(f"{folder}/{f}") else "")
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def same(df, con, sql: str) -> None:
    found = con.sql(sql)
    assert sorted(df.columns) == sorted(found.columns)
    names = sorted(df.columns)
    ours = sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=repr)
    at = [found.columns.index(n) for n in names]
    theirs = sorted((tuple(_plain(r[k]) for k in at) for r in found.fetchall()), key=repr)
    assert ours == theirs
