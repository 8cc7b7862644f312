"""Order-insensitive comparison of a Spark result with a SQL result."""

from __future__ import annotations

import datetime
import math
import os
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(shaped, key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return canonical(names, result.fetchall())


def kinds(rows: list[tuple], width: int) -> list[str | None]:
    """Python type of each column's first non-null value."""
    return [next((type(r[i]).__name__ for r in rows if r[i] is not None), None) for i in range(width)]


def difference(got, want) -> str | None:
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])} rows"
    if kinds(got[1], len(got[0])) != kinds(want[1], len(got[0])):
        return f"types {kinds(got[1], len(got[0]))} != {kinds(want[1], len(got[0]))}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"{str(a)[:400]} != {str(b)[:400]}"
    return None
