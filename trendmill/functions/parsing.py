"""Text to typed values. Malformed text gives NULL, never an error (ANSI mode stays on)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO-8601 durations with days down to seconds. Anchored at the start only.
DURATION = r"^P(?:(\d+)D)?T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?"
DURATION_START = r"^P(?:\d+D)?T"
SECONDS_PER_UNIT = [86400, 3600, 60, 1]


def to_timestamp(text: Column) -> Column:
    """FN1: timestamp, or NULL when the text is none."""
    return F.try_to_timestamp(text)


def to_int(text: Column) -> Column:
    """FN2: integer, or NULL when the text is none. A decimal fraction is cut off."""
    return F.regexp_replace(text, r"\.\d*\s*$", "").try_cast("int")


def count_text_to_long(text: Column) -> Column:
    """FN24: a count given as text; missing, empty and malformed give 0."""
    return F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))


def is_bad_count(text: Column) -> Column:
    """True where text is present but not a count (D11)."""
    return (F.coalesce(text, F.lit("")) != "") & text.try_cast("bigint").isNull()


def duration_seconds(text: Column) -> Column:
    """FN8, UD1: seconds of an ISO-8601 duration.

    A part that is missing counts 0. Text without the leading ``P..T`` gives NULL, and so does a
    duration beyond the integer range.
    """
    seconds = F.lit(0).cast("bigint")
    for group, unit in enumerate(SECONDS_PER_UNIT, start=1):
        # The zero before the digits reads a missing part as 0, so each part is extracted once.
        part = F.concat(F.lit("0"), F.regexp_extract(text, DURATION, group)).try_cast("int")
        seconds = seconds + part.cast("bigint") * F.lit(unit)
    return F.when(text.rlike(DURATION_START), seconds.try_cast("int"))


def truncated(text: Column, length: int) -> Column:
    """FN21: the first ``length`` characters; missing text gives the empty string."""
    return F.substring(F.coalesce(text, F.lit("")), 1, length)


def array_or_empty(array: Column) -> Column:
    """FN23: missing array gives the empty array."""
    return F.coalesce(array, F.array().cast("array<string>"))
