"""Compare a Spark result with the same query in DuckDB, column by column and row by row."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, (bytearray, memoryview)):
        return bytes(value)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def spark_rows(frame):
    return sorted(frame.columns), _sorted_rows(frame.columns, frame.collect())


def duck_rows(connection, sql):
    found = connection.execute(sql)
    columns = [d[0] for d in found.description]
    return sorted(columns), _sorted_rows(columns, found.fetchall())
