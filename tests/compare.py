"""Order-insensitive comparison of a Spark answer with a DuckDB answer."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def rows_of(names: list[str], rows: list[tuple]) -> tuple[list[str], Counter]:
    """Column names in order, and each row's values in that order with its multiplicity."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def assert_same(answer: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> int:
    names, found = rows_of(answer.columns, [tuple(row) for row in answer.collect()])
    result = connection.execute(sql)
    expected_names = [column[0] for column in result.description]
    expected_names, expected = rows_of(expected_names, result.fetchall())
    assert names == expected_names
    extra = list((found - expected).items())[:3]
    missing = list((expected - found).items())[:3]
    assert not extra and not missing, f"unexpected {extra}, missing {missing}"
    return sum(found.values())
