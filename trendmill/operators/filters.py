"""Row filters."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """FI1: drop rows where any key column is NULL."""
    return df.dropna(how="any", subset=keys)


def partition_safe(df: DataFrame, columns: list[str]) -> DataFrame:
    """FI2, FI3: keep rows whose partition values are neither NULL nor the empty string."""
    types = dict(df.dtypes)

    def safe(name: str) -> Column:
        kept = F.col(name).isNotNull()
        return kept & (F.col(name) != "") if types[name] == "string" else kept

    return df.filter(reduce(and_, map(safe, columns)))


def on_date(df: DataFrame, column: str, day: str | None) -> DataFrame:
    """D14: keep one snapshot date; ``None`` keeps all. Prunes partitions where the column is one."""
    return df if day is None else df.filter(F.col(column) == F.lit(day).cast("date"))
