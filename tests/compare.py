"""Run a query and its SQL side by side and compare rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, con, name, fn, sql, folder):
    """Empty when both give the same columns and rows, else a short description."""
    frame = fn(spark, folder)
    got_columns, got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    found = con.execute(sql)
    want_columns, want = _rows([d[0] for d in found.description], found.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    missing, extra = want - got, got - want
    if missing or extra:
        return (f"{sum(got.values())} rows, {sum(want.values())} expected; "
                f"missing {list(missing.items())[:2]}; extra {list(extra.items())[:2]}")[:1500]
    return "" if got else "no rows"
