"""Comparison of a query with its SQL: same columns, same rows."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(path: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}/{table}.parquet')"
        )
    return connection


def _comparable(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (date, datetime)):
        return str(value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = tuple(columns[i] for i in order)
    values = [tuple(_comparable(row[i]) for i in order) for row in rows]
    return names, sorted(values, key=repr)


def spark_rows(df):
    return _rows(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    return _rows([column[0] for column in cursor.description], cursor.fetchall())
