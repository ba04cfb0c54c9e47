"""Strict comparison of a Spark result with its oracle."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    return v


def rows_by_name(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(value(r[i])).__name__, value(r[i])) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None if both results hold the same rows of the same types."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns: only oracle {set(names) - set(df.columns)}, only Spark {set(df.columns) - set(names)}"
    expected, got = rows_by_name(names, cursor.fetchall()), rows_by_name(df.columns, df.collect())
    if expected != got:
        return (f"{sum(got.values())} rows, expected {sum(expected.values())}\n sorted names {sorted(names)}\n"
                f" only oracle {list((expected - got).items())[:2]}\n only Spark {list((got - expected).items())[:2]}")
    return None
