"""Side-by-side run of registered queries and their SQL twins."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def open_duckdb(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    """A value that compares equal across the engines when it is the same."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal | float | int):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    cells = [tuple(plain(row[i]) for i in order) for row in rows]
    return names, sorted(cells, key=repr)


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def duckdb_rows(con, sql):
    result = con.execute(sql)
    return rows_of([c[0] for c in result.description], result.fetchall())
