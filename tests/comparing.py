"""Compare a Spark result with a DuckDB result, whatever the order of rows and columns."""

import math
from datetime import date, datetime
from pathlib import Path

import duckdb

SAMPLE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in SAMPLE_TABLES:
        path = Path(folder) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return round(value, 5) + 0.0
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(normal(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def duckdb_rows(connection, sql):
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    return sorted(names), rows_of(names, cursor.fetchall())
