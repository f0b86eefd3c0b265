"""Comparison of each row with the one before it in its series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(df: DataFrame, keys: list[str], order: list[Column], columns: dict[str, str]) -> DataFrame:
    """WN3: add the previous row's values; ``columns`` maps a column to the name of its lag.

    All lags share one window, hence one shuffle and one sort. A series must be short enough for
    one task, which holds for a history with one row per key and day.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({name: F.lag(column).over(window) for column, name in columns.items()})


def with_last_before(
    current: DataFrame, earlier: DataFrame, keys: list[str], order: Column, columns: dict[str, str]
) -> DataFrame:
    """WN3 when only the newest rows are wanted: each key's last row of ``earlier`` beside them.

    Earlier rows of other keys drop out by a semi-join, and the last row is found by hash
    aggregation, so no series is sorted. All three steps share one partitioning by key. ``order``
    must not be NULL; keys must be unique in ``current`` and not NULL.
    """
    last = (
        earlier.join(current.select(*keys), keys, "left_semi")
        .groupBy(*keys)
        .agg(*[F.max_by(column, order).alias(name) for column, name in columns.items()])
    )
    return current.join(last, keys, "left").select(*current.columns, *columns.values())
