"""Tables that are published version by version: a build is written aside, then one switch of the catalog shows it.

A version is a folder ``version=<number>`` below the table's root, complete once Spark's writer has left its
``_SUCCESS`` file there, and never changed after that. The catalog entry of the table names the published one.
So a build that fails leaves a folder that nobody reads, readers of a version keep it, and a new one appears
at once and whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from trendmill.session import children, exists, remove
from trendmill.sources import catalog
from trendmill.sources.tables import DEFAULT_FORMAT, read_table, write_table

DIGITS = 8


@dataclass(frozen=True)
class VersionedTable:
    """A table of the catalog below a root of its own."""

    name: str
    root: str
    schema: str | StructType
    partition_by: tuple[str, ...]
    sort_by: tuple[str, ...] = ()

    def path(self, version: int) -> str:
        return f"{self.root.rstrip('/')}/version={version:0{DIGITS}d}"


class NoVersion(Exception):
    """A version that is not there, or not complete."""


def _folders(spark: SparkSession, table: VersionedTable) -> list[int]:
    return [int(name.partition("=")[2]) for name in children(spark, table.root) if name.startswith("version=")]


def versions(spark: SparkSession, table: VersionedTable) -> list[int]:
    """The complete versions, in order."""
    return [n for n in _folders(spark, table) if exists(spark, f"{table.path(n)}/_SUCCESS")]


def published(spark: SparkSession, table: VersionedTable) -> int | None:
    """The version that the catalog shows; None if the table is not in it."""
    entry = catalog.stored(spark, table.name)
    return int(entry.location.rstrip("/").rpartition("version=")[2]) if entry else None


def published_path(spark: SparkSession, table: VersionedTable) -> str:
    """Where the published version is."""
    version = published(spark, table)
    if version is None:
        raise NoVersion(f"{table.name} is not published")
    return table.path(version)


def write_version(df: DataFrame, table: VersionedTable) -> tuple[int, int]:
    """SK1, SK2: write ``df`` as the next version, without showing it; its number and its rows.

    The number is past every folder's, also those of failed builds. Of two builds that choose the
    same number at once one fails, as a version is never written over.
    """
    version = max(_folders(df.sparkSession, table), default=0) + 1
    return version, write_table(df, table.path(version), list(table.partition_by), list(table.sort_by), mode="error")


def publish(spark: SparkSession, table: VersionedTable, version: int) -> list[str]:
    """SK7: show a complete version, an earlier one as well; the catalog statements that were needed.

    A new location alone is a single statement. A column that is dropped or has a new type makes the
    entry anew.
    """
    if version not in versions(spark, table):
        raise NoVersion(f"{table.name}: version {version} is not complete")
    new = catalog.declared(spark, table.name, table.path(version), table.schema, list(table.partition_by), DEFAULT_FORMAT)
    return catalog.bring(spark, new, tracked=False)


def publish_all(spark: SparkSession, builds: list[tuple[DataFrame, VersionedTable]]) -> dict[str, int]:
    """Write all builds, then show them all; rows per table. If one fails, none is shown."""
    written = [(table, *write_version(df, table)) for df, table in builds]
    for table, version, _ in written:
        publish(spark, table, version)
    return {table.name: rows for table, _, rows in written}


def read_version(spark: SparkSession, table: VersionedTable, version: int | None = None) -> DataFrame:
    """SC3: the table as of a version; the published one if none is named."""
    if version is None:
        version = published(spark, table)
    if version is None or version not in versions(spark, table):
        raise NoVersion(f"{table.name}: version {version} is not complete")
    return read_table(spark, table.path(version), table.schema)


def retain(spark: SparkSession, table: VersionedTable, keep: int) -> list[int]:
    """Remove what is older than the last ``keep`` complete versions, failed builds among it; the numbers removed.

    The published version and later ones stay. Not to be run during a build, whose folder is not complete.
    """
    if keep < 1:
        raise ValueError("at least one version must stay")
    shown, complete = published(spark, table), versions(spark, table)
    first = min([*complete[-keep:], *([shown] if shown is not None else [])], default=0)
    old = [n for n in _folders(spark, table) if n < first]
    for n in old:
        remove(spark, table.path(n))
    return old
