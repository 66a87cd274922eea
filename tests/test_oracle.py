"""Every registered query against its SQL counterpart, rows and types."""

import __spark_entry__ as entry
import pytest
from compare import connect, duckdb_rows, duckdb_types, spark_rows, spark_types

SF_DIR = "/root/testdata/sf0.01"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_sql(spark, connection, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert spark_types(df) == duckdb_types(connection, ORACLE[name])
    columns, rows = spark_rows(df)
    expected_columns, expected = duckdb_rows(connection, ORACLE[name])
    assert columns == expected_columns
    assert len(rows) == len(expected) > 0
    assert rows == expected


def test_queries_without_sql_return_rows(spark):
    for name in set(entry.queries()) - set(ORACLE):
        assert entry.queries()[name](spark, SF_DIR).count() > 0, name


def test_entry(spark):
    assert entry.entry(spark).count() > 0
