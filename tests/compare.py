"""Side-by-side comparison of a registered query with its SQL in DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def sql_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal_rows(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def spark_rows(frame) -> tuple[list[str], list[str]]:
    return sorted(frame.columns), normal_rows(frame.columns, [tuple(r) for r in frame.collect()])


def sql_rows(connection, sql: str) -> tuple[list[str], list[str]]:
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), normal_rows(columns, result.fetchall())
