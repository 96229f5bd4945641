"""Comparing a Spark result with what DuckDB returns for the same tables."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(result, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns and rows agree, else what does not."""
    rows = [tuple(r) for r in result.collect()]
    answer = con.execute(sql)
    columns = [d[0] for d in answer.description]
    expected = answer.fetchall()
    if sorted(result.columns) != sorted(columns):
        return f"columns {sorted(result.columns)} expected {sorted(columns)}"
    got, want = bag(result.columns, rows), bag(columns, expected)
    if got == want:
        return None
    return (
        f"{len(rows)} rows, expected {len(expected)};"
        f" surplus {list((got - want).items())[:3]}; absent {list((want - got).items())[:3]}"
    )
