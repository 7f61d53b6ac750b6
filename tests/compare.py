"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf, f"{name}.parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _value(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)):
        v = float(v)
        return (1, "nan") if math.isnan(v) else (1, repr(round(v, 7) + 0.0))
    return (2, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_value(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short text."""
    got_columns, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want_columns, want = rows_of(names, cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; e.g. only here {list(set(got) - set(want))[:2]}, only there {list(set(want) - set(got))[:2]}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, e.g. {wrong[0]}" if wrong else None
