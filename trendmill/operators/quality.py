"""Expectations on raw records: declared checks, one pass, a report and a gate.

NULLs never violate a value check and are left out of its denominator; an empty denominator passes.
All rows that share a duplicated key violate uniqueness.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_NULL, VALUES, UNIQUE, ROW_COUNT = "not_null", "values", "unique", "row_count"


@dataclass(frozen=True)
class Expectation:
    """A named check. ``bad`` is true for a violating value; ``mostly`` is the share that must pass."""

    name: str
    kind: str
    value: Column | None = None
    bad: Column | None = None
    mostly: float = 1.0
    critical: bool = True
    at_least: int = 0


def expect_not_null(name: str, column: str) -> Expectation:
    """DQ1-5."""
    return Expectation(name, NOT_NULL, F.col(column), F.col(column).isNull())


def expect_in_set(name: str, column: str, allowed: list[str]) -> Expectation:
    """DQ6, DQ10, FI9."""
    return Expectation(name, VALUES, F.col(column), ~F.col(column).isin(allowed))


def expect_at_least(name: str, column: str, bound: int) -> Expectation:
    """DQ7-9, FI10."""
    return Expectation(name, VALUES, F.col(column), F.col(column) < bound)


def expect_match(name: str, column: str, pattern: str, mostly: float = 1.0) -> Expectation:
    """DQ11-13, FI11, FN20: the pattern is searched, so it carries its own anchors."""
    return Expectation(name, VALUES, F.col(column), ~F.col(column).rlike(pattern), mostly)


def expect_unique(name: str, key: Column, mostly: float = 1.0, critical: bool = True) -> Expectation:
    """DQ14, WN7."""
    return Expectation(name, UNIQUE, key, None, mostly, critical)


def expect_rows(name: str, at_least: int) -> Expectation:
    """DQ15."""
    return Expectation(name, ROW_COUNT, at_least=at_least)


MAX_BITS = 62


def _conditions(expectations: list[Expectation]) -> dict[tuple[str, str], Column]:
    """What each bit of a mask stands for, in order."""
    bits: dict[tuple[str, str], Column] = {}
    for e in expectations:
        if e.kind in (NOT_NULL, VALUES):
            bits[e.name, "bad"] = e.bad
        if e.kind == VALUES:
            bits[e.name, "null"] = e.value.isNull()
    if len(bits) > MAX_BITS:
        raise ValueError(f"at most {MAX_BITS} conditions per run")
    return bits


def mask_counts(df: DataFrame, expectations: list[Expectation], *by: Column) -> DataFrame:
    """Rows (n) per uniqueness check, its key, and mask of what is wrong, and per ``by``: all that verdicts need.

    The counts of several sets of rows can be added up (:func:`added`), so those of earlier rows may be stored.
    """
    uniques = [e for e in expectations if e.kind == UNIQUE]
    mask = F.lit(0).cast("bigint")
    for i, condition in enumerate(_conditions(expectations).values()):
        mask = mask + F.when(condition, F.lit(1 << i)).otherwise(F.lit(0))

    keys = [e.value for e in uniques] or [F.lit("")]
    masked = [mask, *[F.lit(0).cast("bigint")] * (len(keys) - 1)]  # a row's mask goes with its first key
    if len(keys) == 1:
        keyed = df.select(*by, F.lit(0).alias("check"), keys[0].cast("string").alias("key"), mask.alias("mask"))
    else:
        entries = [
            F.struct(F.lit(i).alias("check"), key.cast("string").alias("key"), m.alias("mask"))
            for i, (key, m) in enumerate(zip(keys, masked, strict=True))
        ]
        keyed = df.select(*by, F.inline(F.array(*entries)))
    return keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("n"))


def added(counts: DataFrame) -> DataFrame:
    """The counts of all sets of rows together."""
    return counts.groupBy("check", "key", "mask").agg(F.sum("n").alias("n"))


def results_of(counted: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """One row per expectation, from counts that have each check, key and mask once."""
    uniques = [e for e in expectations if e.kind == UNIQUE]
    # A key has few masks, so its counts meet in a short list, without a second read of the input.
    per_key = counted.groupBy("check", "key").agg(F.sum("n").alias("rows"), F.collect_list(F.struct("mask", "n")).alias("parts"))
    parts = per_key.select("check", "rows", F.posexplode("parts").alias("at", "part")).select("check", "rows", "at", "part.*")

    def total(condition: Column, of: str, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(of))), F.lit(0)).alias(name)

    first = F.col("check") == 0
    totals = parts.agg(
        total(first, "n", "rows"),
        *[
            total(first & (F.getbit("mask", F.lit(i)) == 1), "n", f"{part}_{name}")
            for i, (name, part) in enumerate(_conditions(expectations))
        ],
        *[
            total((F.col("check") == i) & (F.col("at") == 0) & (F.col("rows") > 1), "rows", f"bad_{e.name}")
            for i, e in enumerate(uniques)
        ],
    )
    return totals.select(F.inline(F.array(*map(_result, expectations))))


def validate(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """DQ16: one row per expectation with its counts and verdict.

    The input is read once. What is wrong with a row becomes a bit mask, and rows are counted by
    uniqueness key and mask before the shuffle, so that key, mask and count are all that is sent; a
    hot key costs one row per task and mask. The counts of the value checks are sums over masks,
    those of uniqueness sums over keys. Of several uniqueness checks each has keys of its own.
    """
    return results_of(mask_counts(df, expectations), expectations)


def _result(e: Expectation) -> Column:
    rows, none = F.col("rows"), F.lit(0).cast("bigint")
    missing = F.col(f"`null_{e.name}`") if e.kind == VALUES else none
    if e.kind == ROW_COUNT:
        unexpected, success = none, rows >= e.at_least
    else:
        unexpected = F.col(f"`bad_{e.name}`")
        checked = rows - missing
        success = (checked == 0) | ((checked - unexpected) / F.nullif(checked, none) >= e.mostly)
    return F.struct(
        F.lit(e.name).alias("expectation"),
        F.lit(e.critical).alias("critical"),
        F.coalesce(success, F.lit(True)).alias("success"),
        rows.alias("element_count"),
        missing.alias("missing_count"),
        unexpected.alias("unexpected_count"),
    )


def violations(df: DataFrame, expectation: Expectation) -> DataFrame:
    """FI7, FI8: the rows that violate a not-null or value check. Not for row counts or keys."""
    if expectation.bad is None:
        raise ValueError(f"{expectation.name} has no violating rows of its own")
    return df.filter(expectation.bad)


def all_violations(df: DataFrame, expectations: list[Expectation], name: str = "expectation") -> DataFrame:
    """The violating rows of all not-null and value checks, once for each check, with its name; one read of ``df``."""
    declared = [e for e in expectations if e.bad is not None]
    failed = F.array_compact(F.array(*[F.when(e.bad, F.lit(e.name)) for e in declared]))
    return df.withColumn(name, F.explode(failed))


def duplicate_keys(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """WN7: keys that occur more than once, with their row counts."""
    counts = df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("rows"))
    return counts.filter(F.col("rows") > 1)


SUMMARY = ["total_expectations", "passed", "critical_failures", "warning_failures", "overall_success"]


def summarize(results: DataFrame, *more: Column) -> DataFrame:
    """AG12: one row of report totals, with ``more`` aggregates beside them."""
    failed = ~F.col("success")
    return results.agg(
        F.count(F.lit(1)).alias("total_expectations"),
        F.count_if("success").alias("passed"),
        F.count_if(failed & F.col("critical")).alias("critical_failures"),
        F.count_if(failed & ~F.col("critical")).alias("warning_failures"),
        *more,
    ).withColumn("overall_success", F.col("critical_failures") == 0)


class ExpectationsFailed(Exception):
    """A critical expectation was not met."""
