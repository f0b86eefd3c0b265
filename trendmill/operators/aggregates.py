"""Second-level totals and shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendmill.functions.measures import share
from trendmill.operators.scale import MAX_GROUP_ROWS, group_bound, join_on_group


def value_at_max(value: str, by: str, tie: str) -> Column:
    """AG3: a non-null value of the row with the largest ``by`` (ties: largest ``tie``)."""
    order = F.when(F.col(value).isNotNull(), F.struct(by, tie))
    return F.max_by(value, order)


def share_of_total(
    df: DataFrame,
    keys: list[str],
    measure: str,
    name: str,
    group_rows: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
    source: DataFrame | None = None,
) -> DataFrame:
    """WN6: share of each row in the total of its group.

    Small groups use a window, which can share its shuffle with a rank over the same keys. For
    large ones the totals are aggregated before the shuffle and joined back. ``source`` may name a
    frame with the same measures that is cheaper to total.
    """
    if group_bound(df, keys, group_rows, max_group_rows) <= max_group_rows:
        total = F.try_sum(measure).over(Window.partitionBy(*keys))
        return df.withColumn(name, share(F.col(measure), total))
    totals = (df if source is None else source).groupBy(*keys).agg(F.try_sum(measure).alias("_total"))
    joined = join_on_group(df, totals, keys)
    return joined.withColumn(name, share(F.col(measure), F.col("_total"))).drop("_total")


def join_totals(df: DataFrame, keys: list[str], totals: dict[str, Column]) -> DataFrame:
    """AG5, JO1: roll up to ``keys`` and join the totals to the rows. Rows with a NULL key drop out.

    Reads ``df`` twice, so it wants a stored table.
    """
    rollup = df.groupBy(*keys).agg(*[column.alias(name) for name, column in totals.items()])
    return df.join(rollup, keys, "inner").select(*df.columns, *totals)


def window_totals(df: DataFrame, keys: list[str], totals: dict[str, Column]) -> DataFrame:
    """Same rows as :func:`join_totals` in one read, for keys with few rows each."""
    window = Window.partitionBy(*keys)
    return df.dropna(how="any", subset=keys).withColumns(
        {name: column.over(window) for name, column in totals.items()}
    )


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """AG9: distinct combinations of columns."""
    return df.select(*columns).distinct()


def loss_accounting(df: DataFrame, keys: list[str]) -> DataFrame:
    """AG13: rows read, kept and dropped for a NULL key, in one pass."""
    any_null = F.greatest(*[F.col(key).isNull() for key in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    return df.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(~any_null).alias("kept_rows"),
        F.count_if(any_null).alias("dropped_rows"),
    )
