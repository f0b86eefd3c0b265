"""Tests on built tables: not-null columns, accepted values, and a row-count gate.

They run as scans of their own (``run_table_tests``), or are counted while other work reads the
tables (``watched``, then ``observed_tests``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

VERDICTS = "table_name STRING, test STRING, column_name STRING, failures BIGINT, should_warn BOOLEAN, should_error BOOLEAN"


class EmptyTables(Exception):
    """Tables that must have rows have none."""


def _verdict(table: str, test: str, column: str, failures: Column) -> Column:
    """AG10: one result row; any failure warns and errs."""
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(test).alias("test"),
        F.lit(column).alias("column_name"),
        failures.alias("failures"),
        (failures != 0).alias("should_warn"),
        (failures != 0).alias("should_error"),
    )


def not_null_tests(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """DQ18, FI7: NULL rows per column, all columns of a table in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[_verdict(table, "not_null", c, F.col(c)) for c in columns])))


def value_histogram(df: DataFrame, column: str) -> DataFrame:
    """AG6: rows per value."""
    return df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


def accepted_values_test(df: DataFrame, table: str, column: str, accepted: list) -> DataFrame:
    """DQ19, FI8: distinct values outside the list. NULL is never outside."""
    outside = value_histogram(df, column).filter(~F.col("value_field").isin(accepted))
    failures = outside.agg(F.count(F.lit(1)).alias("failures"))
    return failures.select(F.inline(F.array(_verdict(table, "accepted_values", column, F.col("failures")))))


def run_table_tests(tables: dict[str, DataFrame], not_null: dict[str, list[str]], accepted: dict) -> DataFrame:
    """All declared tests of the given tables; ``accepted`` maps (table, column) to values."""
    results = [not_null_tests(tables[t], t, columns) for t, columns in not_null.items() if t in tables]
    results += [
        accepted_values_test(tables[t], t, column, values)
        for (t, column), values in accepted.items()
        if t in tables
    ]
    return reduce(DataFrame.unionByName, results)


@dataclass(frozen=True)
class Watched:
    """The tests of one table, and what has been seen of its rows."""

    table: str
    not_null: list[str]
    accepted: dict[str, list]
    seen: Observation


def watched(df: DataFrame, table: str, not_null: dict[str, list[str]], accepted: dict) -> tuple[DataFrame, Watched]:
    """``df`` whose tests are counted by the first action that reads it, and what then holds the counts.

    That action must need all rows, as writing or aggregating does. The counts are a number for each
    test. No filter passes below them, as they are of all rows; columns are still pruned.
    """
    values = {column: allowed for (name, column), allowed in accepted.items() if name == table}
    own = Watched(table, not_null.get(table, []), values, Observation())
    metrics = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in own.not_null]
    metrics += [F.count_if(~F.col(c).isin(allowed)).alias(f"outside_{c}") for c, allowed in values.items()]
    return (df.observe(own.seen, *metrics) if metrics else df), own


def _counts(watch: Watched) -> dict[str, int] | None:
    """What was seen; None where adaptive execution found the result to be empty and dropped the plan, its counts with it."""
    try:
        return watch.seen.get
    except Py4JJavaError:  # a row without fields
        return None


def observed_tests(spark: SparkSession, watches: list[Watched], tables: dict[str, DataFrame]) -> DataFrame:
    """DQ18, DQ19: the verdicts of :func:`run_table_tests`, from what was seen.

    Nothing is read for a test without failures. A task that is repeated may count its rows again, and
    values outside a list are told apart only by grouping; so each failed test, and only those, is
    counted anew from ``tables``, as are all tests of a table that no counts are left of. To be called
    after the actions that read the watched frames.
    """
    passed, again_null, again_accepted = [], {}, {}
    for watch in watches:
        if not watch.not_null and not watch.accepted:
            continue
        seen = _counts(watch)
        failed = [c for c in watch.not_null if seen is None or seen[f"null_{c}"]]
        if failed:
            again_null[watch.table] = failed
        passed += [(watch.table, "not_null", c, 0, False, False) for c in watch.not_null if c not in failed]
        for column, allowed in watch.accepted.items():
            if seen is None or seen[f"outside_{column}"]:
                again_accepted[watch.table, column] = allowed
            else:
                passed.append((watch.table, "accepted_values", column, 0, False, False))
    verdicts = spark.createDataFrame(passed, VERDICTS)
    if again_null or again_accepted:
        verdicts = verdicts.unionByName(run_table_tests(tables, again_null, again_accepted))
    return verdicts


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """AG7: rows per table."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def require_rows(tables: dict[str, DataFrame]) -> None:
    """DQ20: raise one error that names every empty table. Stops reading at the first row."""
    empty = [name for name, df in tables.items() if df.isEmpty()]
    if empty:
        raise EmptyTables(f"{len(empty)} table(s) without rows: {', '.join(empty)}")


def require_counts(counts: dict[str, int]) -> None:
    """DQ20 by the rows that the writers have counted, without reading."""
    empty = [name for name, rows in counts.items() if not rows]
    if empty:
        raise EmptyTables(f"{len(empty)} table(s) without rows: {', '.join(empty)}")
