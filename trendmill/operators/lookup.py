"""Names from a fixed dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_dimension(spark: SparkSession, names: dict[int, str], key: str, value: str) -> DataFrame:
    """A small fixed table as an inline relation, so its size is known to the planner."""
    pairs = F.array(*[F.struct(F.lit(number).alias(key), F.lit(name).alias(value)) for number, name in names.items()])
    return spark.range(1).select(F.inline(pairs))


def lookup(df: DataFrame, dimension: DataFrame, key: str, value: str, default: Column) -> DataFrame:
    """JO2, FN18: left join to a fixed dimension; rows without a match get ``default``.

    The dimension is a literal of the program, so the broadcast is bounded by its text.
    """
    joined = df.join(F.broadcast(dimension), key, "left")
    return joined.withColumn(value, F.coalesce(value, default))
