"""Row-by-row comparison of a Spark result with DuckDB, whatever the row order."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in RAW:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{Path(folder) / name}.parquet')")
    return con


def _key(value):
    """Nulls first, numbers by value rounded enough to sort both sides alike."""
    if value is None:
        return (0, "")
    if isinstance(value, float | Decimal):
        return (1, f"{float(value):.4f}")
    return (1, str(value))


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    fixed = [tuple(row[i] for i in order) for row in rows]
    return sorted(fixed, key=lambda row: (
        [_key(v) for v in row if not isinstance(v, float | Decimal)], [_key(v) for v in row]))


def _same(a, b) -> bool:
    if a is None or b is None:
        return a is b
    if isinstance(a, float | Decimal) or isinstance(b, float | Decimal):
        return math.isclose(float(a), float(b), rel_tol=1e-12, abs_tol=1e-12)
    return type(a) is type(b) and a == b


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same columns and rows, else a description of the first difference."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    expected = _sorted(cursor.fetchall(), names)
    actual = _sorted([tuple(r) for r in spark_df.collect()], spark_df.columns)
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    for mine, theirs in zip(actual, expected, strict=True):
        if not all(_same(a, b) for a, b in zip(mine, theirs, strict=True)):
            return f"{sorted(names)}: {mine} != {theirs}"
    return None
