"""Compare registered queries with their SQL on the same tables, row by row, order aside."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return value.normalize() + 0
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, query, sql: str, folder: str) -> tuple[int, str]:
    """(number of rows, '') when equal, else what differs."""
    result = query(spark, folder)
    found = rows_of(result.columns, [tuple(r) for r in result.collect()])
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    expected = rows_of(names, answer.fetchall())
    if sorted(names) != sorted(result.columns):
        return sum(found.values()), f"columns {sorted(result.columns)} against {sorted(names)}"
    if found != expected:
        missing, extra = expected - found, found - expected
        return sum(found.values()), (f"{sum(missing.values())} rows missing, {sum(extra.values())} extra; "
                                     f"{str(list(missing)[:1])[:600]} against {str(list(extra)[:1])[:600]}")
    return sum(found.values()), ""
