"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

from tessera.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def same(df, con, sql) -> tuple[bool, str]:
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    if sorted(cols) != sorted(ocols):
        return False, f"columns {cols} vs {ocols}"
    a, b = canonical(cols, srows), canonical(ocols, orows)
    if a != b:
        return False, f"rows {len(a)} vs {len(b)}; spark-only {sorted(set(a) - set(b), key=str)[:3]}; " \
                      f"oracle-only {sorted(set(b) - set(a), key=str)[:3]}"
    return True, f"{len(a)} rows"


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])
