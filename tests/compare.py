"""Compare a Spark query with its SQL in DuckDB, row for row."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([_cell(row[i]) for i in order]) for row in rows)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, df.collect())


def duck_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted(names), _rows(names, cursor.fetchall())
