"""Comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 6)
    return value


def bag(names: list[str], rows) -> Counter:
    """Rows as a multiset, columns ordered by name."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def spark_bag(df) -> Counter:
    return bag(df.columns, df.collect())


def duck_bag(con: duckdb.DuckDBPyConnection, sql: str) -> Counter:
    result = con.execute(sql)
    return bag([c[0] for c in result.description], result.fetchall())
