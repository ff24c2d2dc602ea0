"""Order-insensitive comparison of a Spark DataFrame with a DuckDB oracle query."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), [cols[i] for i in order]


def compare(df, sql: str, con) -> tuple[bool, str]:
    s_rows, s_cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    d_cols_raw = [c[0] for c in res.description]
    d_rows, d_cols = rows_of(d_cols_raw, res.fetchall())
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} duck={len(d_rows)}"
    if s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        return False, f"values differ ({len(s_rows)} rows), first: {diff}"
    return True, f"{len(s_rows)} rows equal"
