"""Latest rows, ranks, top-k and buckets within groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendmill.operators.scale import (
    MAX_GROUP_ROWS,
    group_bound,
    join_on_group,
    total_before,
)
from trendmill.session import stage


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, name: str = "rank") -> DataFrame:
    """SO2: exactly ``n`` rows per group (fewer if the group is smaller), numbered from 1.

    Spark limits each group before the shuffle, so a hot group sends at most ``n`` rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """WN1, FI4: the first row per key in the given order."""
    return top_n(df, keys, order, 1, "_rn").drop("_rn")


def row_number_in_group(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    name: str,
    group_rows: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """WN2: unique rank of every row in its group. ``order`` must be a total order.

    ``group_rows`` is an upper bound the caller knows for the group size; else it is measured.
    """
    bound = group_bound(df, keys, group_rows, max_group_rows)
    if bound <= max_group_rows:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, F.row_number().over(window))
    ranked = total_before(df, keys, order, F.lit(1), name, bound, max_group_rows)
    return ranked.withColumn(name, (F.col(name) + 1).cast("int"))


def rank_in_group(
    df: DataFrame,
    keys: list[str],
    by: str,
    name: str,
    group_rows: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """WN4: gapped rank by a measure, largest first.

    Large groups are first reduced to their distinct values with counts, so ties cost nothing; the
    rank of a value is one more than the rows with larger values, and rows get it by a join. The
    values are stored once, and measured and ranked from there.
    """
    bound = group_bound(df, keys, group_rows, max_group_rows)
    if bound <= max_group_rows:
        return df.withColumn(name, F.rank().over(Window.partitionBy(*keys).orderBy(F.desc(by))))
    values = stage(df.groupBy(*keys, by).agg(F.count(F.lit(1)).alias("_rows")), "values")
    ranked = total_before(values, keys, [F.desc(by)], F.col("_rows"), name, None, max_group_rows)
    ranked = ranked.select(*keys, by, (F.col(name) + 1).cast("int").alias(name))
    return join_on_group(df, ranked, [*keys, by])


def top_n_with_ties(
    df: DataFrame,
    keys: list[str],
    by: str,
    n: int,
    name: str = "rank",
    group_rows: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """SO3, FI5, WN4: rows of gapped rank up to ``n``; ties at the end are all kept (D9).

    In large groups ties could gather in one task. There the values of the first ``n`` rows are
    ranked alone (they are few, and every larger value is among them), and the rows join them.
    """
    bound = group_bound(df, keys, group_rows, max_group_rows)
    window = Window.partitionBy(*keys).orderBy(F.desc(by))
    if bound <= max_group_rows:
        return df.withColumn(name, F.rank().over(window)).filter(F.col(name) <= n)
    leaders = top_n(df.select(*keys, by), keys, [F.desc(by)], n, "_rn")
    ranks = (
        leaders.withColumn(name, F.rank().over(window))
        .groupBy(*keys, by)
        .agg(F.min(name).alias(name))
    )
    return join_on_group(df, ranks, [*keys, by])


def ntile_in_group(df: DataFrame, keys: list[str], order: list[Column], buckets: int, name: str) -> DataFrame:
    """WN5: near-equal buckets in a total order. For groups of bounded size, such as a top-k."""
    return df.withColumn(name, F.ntile(buckets).over(Window.partitionBy(*keys).orderBy(*order)))
