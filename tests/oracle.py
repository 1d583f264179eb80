"""Comparison of a Spark result with the DuckDB result of its oracle SQL."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both sides hold the same rows, otherwise what differs."""
    spark_names, spark_rows = rows_of(df.columns, df.collect())
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    duck_names, duck_rows = rows_of(names, result.fetchall())
    if spark_names != duck_names:
        return f"columns {spark_names} against {duck_names}"
    if spark_rows != duck_rows:
        only_spark = list((spark_rows - duck_rows).items())[:3]
        only_duck = list((duck_rows - spark_rows).items())[:3]
        return (
            f"{spark_rows.total()} against {duck_rows.total()} rows;"
            f" only Spark {only_spark}; only DuckDB {only_duck}"
        )
    return None
