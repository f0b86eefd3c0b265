"""Exact work on groups too large for one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendmill.session import stage

# A group up to this size is sorted by one task (with spill); a larger one is split into cells.
MAX_GROUP_ROWS = 4_000_000

_CELL = "_cell"
_GROUP = "_group"


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Rows in the largest group. Reads the key columns only and aggregates before the shuffle."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counts.agg(F.max("rows")).first()[0] or 0


def group_bound(df: DataFrame, keys: list[str], known: int | None, limit: int) -> int:
    """An upper bound for the group size: the known one if it is within the limit, else measured."""
    if known is not None and known <= limit:
        return known
    return largest_group(df, keys)


def group_key(columns: list[str]) -> Column:
    """Columns as one struct. It is never NULL, and NULL fields compare equal."""
    return F.struct(*columns)


def join_on_group(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys where NULL matches NULL; ``other`` has one row per key."""
    right = other.withColumn(_GROUP, group_key(keys)).drop(*keys)
    return df.withColumn(_GROUP, group_key(keys)).join(right, _GROUP).drop(_GROUP)


def total_before(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    weight: Column,
    name: str,
    group_rows: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the sum of ``weight`` over the rows of the group that sort before each row.

    ``order`` must be a total order. Small groups use one window. If a group may exceed
    ``max_group_rows``, the rows are range-partitioned over (keys, order), so that a large group
    becomes many cells; each cell is summed on its own and raised by the total of the earlier cells
    of its group. The cell of a row is fixed by staging before it is used twice.
    """
    preceding = (Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    bound = group_bound(df, keys, group_rows, max_group_rows)
    if bound <= max_group_rows:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*preceding)
        return df.withColumn(name, F.coalesce(F.sum(weight).over(window), zero))

    cells = max(
        int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        math.ceil(4 * bound / max_group_rows),
    )
    celled = stage(
        df.withColumn(_GROUP, group_key(keys))
        .repartitionByRange(cells, *keys, *order)
        .withColumn(_CELL, F.spark_partition_id()),
        "cells",
    )
    by_cell = Window.partitionBy(_GROUP).orderBy(_CELL).rowsBetween(*preceding)
    offsets = (
        celled.groupBy(_GROUP, _CELL)
        .agg(F.sum(weight).alias("_sum"))
        .select(_GROUP, _CELL, F.coalesce(F.sum("_sum").over(by_cell), zero).alias("_offset"))
    )
    in_cell = Window.partitionBy(_GROUP, _CELL).orderBy(*order).rowsBetween(*preceding)
    return (
        celled.withColumn(name, F.coalesce(F.sum(weight).over(in_cell), zero))
        .join(offsets, [_GROUP, _CELL])
        .withColumn(name, F.col(name) + F.col("_offset"))
        .drop(_GROUP, _CELL, "_offset")
    )


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with the place of each row, from 1, in a total order.

    Rows are range-partitioned and sorted, and stored with their place in their task; a task's rows go
    on where those of the tasks before end. So only a count for each task meets in one place.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    placed = stage(in_order.withColumn("_at", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn(_CELL, F.shiftrightunsigned("_at", 33))  # the upper bits are the task's number
    counts = placed.groupBy(_CELL).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(F.lit(0)).orderBy(_CELL).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1
    shifts = counts.select(_CELL, shift.alias("_shift"))
    return placed.join(shifts, _CELL).withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_shift", _CELL)
