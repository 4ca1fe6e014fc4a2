"""Compare a Spark result with its DuckDB statement on the same files (tests and local checks)."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else float(repr(v)) + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """``None`` when names, types of values and rows agree exactly, else a short description."""
    sc, sr = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    dc, dr = _rows([d[0] for d in res.description], res.fetchall())
    if sc != dc:
        return f"columns differ: {sc} / {dc}"
    if len(sr) != len(dr):
        return f"row counts differ: {len(sr)} / {len(dr)}"
    for a, b in zip(sr, dr):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            bad = [(c, x, y) for c, x, y in zip(sc, a, b) if x != y or type(x) is not type(y)]
            return f"first difference: {bad}"
    return None
