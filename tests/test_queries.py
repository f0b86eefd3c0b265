"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from compare import connect, duckdb_rows, duckdb_types, spark_rows, spark_types

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


#: The operators for training text are tested beside them.
OWN = [name for name in entry.queries() if name != "pipeline" and not (entry.llm and name in entry.llm.queries())]


def test_every_query_has_sql():
    assert set(OWN) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, con, name):
    df, sql = entry.queries()[name](spark, SF_DIR), entry.oracle_sql()[name]
    assert spark_types(df) == duckdb_types(con, sql)
    columns, rows = spark_rows(df)
    expected_columns, expected = duckdb_rows(con, sql)
    assert columns == expected_columns
    assert rows == expected


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0
