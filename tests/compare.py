"""Run registered queries and their SQL side by side."""

from __future__ import annotations

import datetime as dt
import time
from decimal import Decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{directory}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, con, directory, query, text) -> tuple[str | None, int, float]:
    """An explanation of the first mismatch (or None), the row count, and Spark's seconds."""
    start = time.time()
    df = query(spark, directory)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if text is None:
        return None, len(got), took
    res = con.execute(text)
    names = [d[0] for d in res.description]
    want = res.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}", len(got), took
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return f"{len(a)} rows, expected {len(b)}", len(got), took
    for x, y in zip(a, b):
        if x != y:
            cols = sorted(names)
            bad = [(c, p, q) for c, p, q in zip(cols, x, y) if p != q]
            return f"{bad[:4]}", len(got), took
    return None, len(got), took
