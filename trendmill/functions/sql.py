"""The functions of the layers under their names in SQL, for queries that are text alone.

They are SQL functions: their bodies are expressions that Spark puts in place of the call, so a query with
them is planned like one without. Each gives what the column function of the same name gives.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from trendmill.functions.parsing import DURATION, DURATION_START, SECONDS_PER_UNIT
from trendmill.schemas import MOMENTUM_LABELS
from trendmill.sources.catalog import full_name, quoted, text


def _part(group: int, unit: int) -> str:
    digits = f"regexp_extract(duration, {text(DURATION)}, {group})"
    return f"CASE WHEN {digits} = '' THEN 0 ELSE CAST(try_cast({digits} AS INT) AS BIGINT) * {unit} END"


_SECONDS = " + ".join(_part(group, unit) for group, unit in enumerate(SECONDS_PER_UNIT, start=1))
_FAST, _GROWING, _FLAT, _FALLING = (text(label) for label in MOMENTUM_LABELS)

#: name: (parameters, type, body)
FUNCTIONS = {
    "duration_seconds": ("duration STRING", "INT", f"CASE WHEN duration RLIKE {text(DURATION_START)} THEN try_cast({_SECONDS} AS INT) END"),
    "text_to_timestamp": ("value STRING", "TIMESTAMP", "try_to_timestamp(value)"),
    "text_to_int": ("value STRING", "INT", r"try_cast(regexp_replace(value, '\\.\\d*\\s*$', '') AS INT)"),
    "count_text_to_long": ("value STRING", "BIGINT", "coalesce(try_cast(value AS BIGINT), 0)"),
    "array_size_or_zero": ("value ARRAY<STRING>", "INT", "CASE WHEN value IS NULL THEN 0 ELSE size(value) END"),
    "safe_ratio": (
        "numerator DOUBLE, denominator DOUBLE", "DOUBLE", "CASE WHEN denominator > 0 THEN numerator / denominator ELSE 0.0D END",
    ),
    "percent_change": (
        "value BIGINT, previous BIGINT", "DOUBLE",
        "CASE WHEN previous > 0 THEN CAST(try_subtract(value, previous) AS DOUBLE) / CAST(previous AS DOUBLE) * 100 END",
    ),
    "share_of": ("part DOUBLE, whole DOUBLE", "DOUBLE", "part / nullif(whole, 0D)"),
    "momentum_label": (
        "velocity DOUBLE", "STRING",
        f"CASE WHEN velocity IS NULL THEN NULL WHEN velocity > 20 THEN {_FAST} WHEN velocity > 0 THEN {_GROWING} "
        f"WHEN velocity = 0 THEN {_FLAT} ELSE {_FALLING} END",
    ),
}


def register_functions(spark: SparkSession, database: str | None = None) -> list[str]:
    """UD1, FN8-11, FN19: make all of ``FUNCTIONS`` known; the names to call them by.

    With a database they are the catalog's and outlive the session; without one they are the session's.
    """
    names = []
    if database is not None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {full_name(database)}")
    for function, (parameters, kind, body) in FUNCTIONS.items():
        name = quoted(function) if database is None else f"{full_name(database)}.{quoted(function)}"
        temporary = "TEMPORARY " if database is None else ""
        spark.sql(f"CREATE OR REPLACE {temporary}FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
        names.append(function if database is None else f"{database}.{function}")
    return names
