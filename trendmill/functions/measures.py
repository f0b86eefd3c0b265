"""Ratios, differences, rounding and labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_size(array: Column) -> Column:
    """FN9: number of elements; NULL counts 0."""
    return F.when(array.isNull(), F.lit(0)).otherwise(F.size(array))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """FN10: ``numerator / denominator`` where the denominator is positive, else 0.0.

    A NULL numerator over a positive denominator stays NULL (D6).
    """
    quotient = numerator.cast("double") / denominator.cast("double")
    return F.when(denominator > 0, quotient).otherwise(F.lit(0.0))


def percent_change(value: Column, previous: Column) -> Column:
    """FN11: growth over the previous value in percent; NULL unless that was positive."""
    growth = F.try_subtract(value, previous).cast("double") / previous.cast("double")
    return F.when(previous > 0, growth * 100)


def share(part: Column, whole: Column) -> Column:
    """FN15: ``part / whole`` in double precision, NULL for a zero whole (D8)."""
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")


def percent(ratio: Column, digits: int) -> Column:
    """FN16, FN17: a ratio in percent, rounded half up."""
    return F.round(ratio * 100, digits)


def days_between(start: Column, end: Column) -> Column:
    """FN7: whole days from ``start`` to ``end``."""
    return F.datediff(end, start)


def null_to_zero(column: Column, type_name: str) -> Column:
    """FN14: NULL becomes a typed zero."""
    return F.coalesce(column, F.lit(0).cast(type_name))


def label_by_threshold(value: Column, bands: list[tuple[float, str]], equal: tuple[float, str], below: str) -> Column:
    """FN19: label of the first band whose lower bound the value exceeds.

    ``equal`` labels one exact value, ``below`` everything else. NULL stays NULL.
    """
    start = F.when(value.isNull(), F.lit(None).cast("string"))
    chain = reduce(lambda acc, band: acc.when(value > band[0], F.lit(band[1])), bands, start)
    return chain.when(value == equal[0], F.lit(equal[1])).otherwise(F.lit(below))
