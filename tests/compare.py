"""Run a registered query beside its SQL and compare the rows as a multiset."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

VIEWS = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for view in VIEWS:
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{folder}/{view}.parquet'")
    return con


def plain(value):
    """Equal values of both engines as one form."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, (int, float)):
        value = float(value)
        return "nan" if math.isnan(value) else float(f"{value:.9g}") + 0.0
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def row_set(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same rows; else a short account."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns: spark {sorted(df.columns)} sql {sorted(names)}"
    expected = row_set(names, result.fetchall())
    found = row_set(df.columns, df.collect())
    if expected == found:
        return None
    return (
        f"{sum(found.values())} rows, sql {sum(expected.values())}; columns {sorted(names)}; "
        f"only spark {list((found - expected).items())[:4]}; only sql {list((expected - found).items())[:4]}"
    )
