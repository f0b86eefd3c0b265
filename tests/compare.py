"""Run every registered query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def normalized(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=lambda row: tuple((v is not None, str(v)) for v in row))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return normalized(df.columns, [tuple(row) for row in df.collect()])


TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def spark_types(df) -> dict[str, str]:
    return {name: TYPES.get(kind, kind) for name, kind in df.dtypes}


def duckdb_types(con, sql: str) -> dict[str, str]:
    return {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}


def duckdb_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    return normalized([d[0] for d in result.description], result.fetchall())


def main(sf_dir: str, only: list[str]) -> int:
    from conftest import make_session

    import __spark_entry__ as entry

    spark, con = make_session(), connect(sf_dir)
    failed = 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        df, sql = query(spark, sf_dir), entry.oracle_sql()[name]
        columns, rows = spark_rows(df)
        took = time.time() - start
        expected_columns, expected = duckdb_rows(con, sql)
        types, expected_types = spark_types(df), duckdb_types(con, sql)
        same = columns == expected_columns and rows == expected and types == expected_types
        failed += not same
        print(f"{'ok ' if same else 'BAD'} {name:36} {len(rows):8} rows {took:6.2f}s", flush=True)
        if not same:
            print("   types", set(types.items()) ^ set(expected_types.items()), len(rows), len(expected))
            different = [(a, b) for a, b in zip(rows, expected) if a != b][:2]
            for a, b in different:
                print("   spark ", [(c, x) for c, x, y in zip(columns, a, b) if x != y])
                print("   duckdb", [(c, y) for c, x, y in zip(columns, a, b) if x != y])
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.path.insert(0, ".")
    sys.exit(main(sys.argv[1], sys.argv[2:]))
