"""Run the registered queries and their SQL over the same tables."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
from collections import Counter

import duckdb

DATA = os.environ.get("TEST_DATA", "/root/testdata")


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def row_counts(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(result) -> tuple[list[str], Counter]:
    return sorted(result.columns), row_counts(result.columns, result.collect())


def sql_rows(db, sql: str) -> tuple[list[str], Counter]:
    cursor = db.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), row_counts(columns, cursor.fetchall())
