"""Row-for-row comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    return value


def _sortable(row):
    return tuple((v is not None, str(v)) for v in row)


def spark_rows(df):
    columns = sorted(df.columns)
    kinds = dict(df.dtypes)
    rows = [tuple(_cell(row[c]) for c in columns) for row in df.collect()]
    return columns, [KINDS.get(kinds[c], kinds[c]) for c in columns], sorted(rows, key=_sortable)


def duck_rows(connection, sql: str):
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    columns = sorted(names)
    at = [names.index(c) for c in columns]
    rows = [tuple(_cell(row[i]) for i in at) for row in result.fetchall()]
    return columns, [kinds[c] for c in columns], sorted(rows, key=_sortable)


def difference(df, connection, sql: str) -> str | None:
    """None when equal, else what differs first."""
    columns, kinds, rows = spark_rows(df)
    expected_columns, expected_kinds, expected = duck_rows(connection, sql)
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    odd = [x for x in zip(columns, kinds, expected_kinds) if x[1] != x[2]]
    if odd:
        return f"types {odd}"
    if len(rows) != len(expected):
        return f"rows {len(rows)} != {len(expected)}"
    for got, want in zip(rows, expected):
        if got != want:
            return f"{dict(zip(columns, got))} != {dict(zip(columns, want))}"
    return None
