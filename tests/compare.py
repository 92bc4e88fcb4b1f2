"""Run a query in Spark and its SQL in DuckDB and compare all rows exactly."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    """One form for the values of both engines: no -0.0, no NaN, no decimals."""
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def sorted_rows(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(values, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark_df, connection, sql: str) -> str:
    """An empty text when both results are equal."""
    columns, got = sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.toLocalIterator()])
    cursor = connection.execute(sql)
    names, want = sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    if columns != names:
        return f"columns {columns} vs {names}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    kinds = [(type(a), type(b)) for a, b in zip(got[0], want[0]) if type(a) is not type(b)] if got else []
    if kinds and not wrong:
        return f"types {kinds} in {columns}"
    return f"{len(wrong)} of {len(got)} rows differ, e.g. {wrong[:2]}" if wrong else ""
