"""Compare registered Spark queries with their DuckDB oracle (order-insensitive)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from sluice.sources.tables import TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def normalise(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return names, out


def compare(spark, con, name, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    s_cols, s_rows = normalise(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    d_cols, d_rows = normalise([d[0] for d in res.description], res.fetchall())
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:2]
        problems.append(f"values differ, e.g. {diff}")
    return len(s_rows), problems
