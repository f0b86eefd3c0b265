"""Validation of a history day by day: counts of earlier days are kept, so that their records are not read again.

What is kept of a day is, per uniqueness key and mask of what is wrong with a record, how many records
there are. Such counts add up to those of all records, so the verdicts are the same as if all records
were validated at once, also those on keys that several days share. A day can be replaced.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendmill.functions.parsing import to_timestamp
from trendmill.operators.quality import Expectation, added, mask_counts, results_of
from trendmill.plans.checks import bronze_expectations
from trendmill.plans.silver import SNAPSHOT
from trendmill.session import exists, remove
from trendmill.sources.tables import replace_partitions, write_table

COUNTS = f"check INT, key STRING, mask BIGINT, n BIGINT, {SNAPSHOT} DATE"


class NoCounts(Exception):
    """A day is to be validated with a history whose counts were not kept."""


@dataclass(frozen=True)
class CountStore:
    """Where counts are kept: a table partitioned by day, below a name that stands for the expectations."""

    root: str

    def path(self, expectations: list[Expectation]) -> str:
        declared = repr([(e.name, e.kind, str(e.value), str(e.bad)) for e in expectations])
        return f"{self.root.rstrip('/')}/{hashlib.sha256(declared.encode()).hexdigest()[:16]}"


def seen_on() -> Column:
    """The day of a record; NULL if its time cannot be read."""
    return F.to_date(to_timestamp(F.col("ingested_at"))).alias(SNAPSHOT)


def day_counts(bronze: DataFrame, expectations: list[Expectation] | None = None) -> DataFrame:
    """The counts of each day, from one read of the records."""
    return mask_counts(bronze, expectations or bronze_expectations(), seen_on())


def results_with(
    counts: DataFrame, store: CountStore, day: str | None = None, expectations: list[Expectation] | None = None
) -> DataFrame:
    """DQ16 over the whole history: ``counts`` are all of it, or, with ``day``, replace that day in what is kept.

    Other expectations than those the counts were kept for have no counts here; a run over all records
    makes them.
    """
    expectations = expectations or bronze_expectations()
    if day is not None:
        spark, path = counts.sparkSession, store.path(expectations)
        if not exists(spark, f"{path}/_SUCCESS"):
            raise NoCounts(f"no counts of the other days for these expectations in {store.root}")
        kept = spark.read.schema(COUNTS).parquet(path)
        others = kept.filter(~F.col(SNAPSHOT).eqNullSafe(F.lit(day).cast("date")))
        counts = counts.unionByName(others)
    return results_of(added(counts), expectations)


def store_counts(
    counts: DataFrame, store: CountStore, day: str | None = None, expectations: list[Expectation] | None = None
) -> int:
    """Keep the counts of all days, or those of ``day`` in place of what it had; returns the rows kept.

    ``counts`` must not read what is kept.
    """
    path = store.path(expectations or bronze_expectations())
    if day is None:
        remove(counts.sparkSession, path)
        return write_table(counts, path, [SNAPSHOT])
    return replace_partitions(counts, path, [SNAPSHOT], [{SNAPSHOT: date.fromisoformat(day)}])
