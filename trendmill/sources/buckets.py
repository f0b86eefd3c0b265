"""Tables stored by key: bucketed and sorted, so that work per key needs no shuffle.

Meant for histories with a bounded number of rows per key (silver has one per day), as all rows of a
key are in one bucket. Raw records, of which one key may have any number, are not stored this way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from trendmill.sources.catalog import full_name

ROWS_PER_BUCKET = 2_000_000


@dataclass(frozen=True)
class Bucketed:
    """A table of the catalog whose rows are dealt by ``keys`` and sorted by ``keys`` and ``order``."""

    name: str
    path: str
    keys: tuple[str, ...]
    order: tuple[str, ...] = ()


def buckets_for(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """A power of two, so that tables of other sizes have a multiple of the same buckets and still join in place."""
    return 1 << max(0, (max(rows, 1) - 1) // rows_per_bucket).bit_length()


def write_bucketed(df: DataFrame, table: Bucketed, buckets: int) -> int:
    """SK1-3: write the whole table with one sorted file per bucket, and return its rows.

    This is the one shuffle; what is built on the table by ``keys`` needs no other. ``df`` must not
    read the files at the table's path.
    """
    spark = df.sparkSession
    if "." in table.name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {full_name(table.name.rpartition('.')[0])}")
    counted = Observation()
    dealt = df.observe(counted, F.count(F.lit(1)).alias("rows")).repartition(buckets, *table.keys)
    (
        dealt.write.mode("overwrite")
        .bucketBy(buckets, *table.keys)
        .sortBy(*table.keys, *table.order)
        .option("path", table.path)
        .saveAsTable(full_name(table.name))
    )
    return counted.get["rows"]


def read_bucketed(spark, table: Bucketed) -> DataFrame:
    return spark.table(full_name(table.name))
