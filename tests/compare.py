"""Row-for-row comparison of a Spark result with the DuckDB result of its SQL counterpart."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    return value


def normal_form(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    normal = [tuple(cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(normal, key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return normal_form(df.columns, df.collect())


def duckdb_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    return normal_form([c[0] for c in result.description], result.fetchall())


TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def spark_types(df) -> dict[str, str]:
    return {name: TYPES[kind] for name, kind in df.dtypes}


def duckdb_types(connection, sql: str) -> dict[str, str]:
    return {row[0]: row[1] for row in connection.execute(f"describe {sql}").fetchall()}
