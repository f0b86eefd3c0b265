"""Catalog entries of external tables: what an entry says, how it differs from what is declared, and how to bring it there."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

TRACKING = "spark.sql.hive.manageFilesourcePartitions"


@dataclass(frozen=True)
class Entry:
    """An external table as the catalog has it (or should have it). Columns and types are in order, partition columns last."""

    name: str
    columns: dict[str, str]
    partition_by: list[str]
    location: str
    fmt: str
    properties: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Difference:
    """Columns that are new, gone or of another type, and whether partitioning, order, format or location differ."""

    added: dict[str, str]
    dropped: list[str]
    retyped: dict[str, str]
    partitioning: bool
    order: bool
    fmt: bool
    location: bool

    def __bool__(self) -> bool:
        return bool(self.added or self.dropped or self.retyped or self.partitioning or self.order or self.fmt or self.location)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def full_name(name: str) -> str:
    return ".".join(quoted(part) for part in name.split("."))


def full_path(spark: SparkSession, path: str) -> str:
    """The path as the catalog shows it: with scheme, without a slash at its end."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return str(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString())


def declared(spark: SparkSession, name: str, path: str, schema: str | StructType, partition_by: list[str], fmt: str) -> Entry:
    schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    types = {f.name: f.dataType.simpleString() for f in schema}
    columns = {c: t for c, t in types.items() if c not in partition_by} | {c: types[c] for c in partition_by}
    return Entry(name, columns, list(partition_by), full_path(spark, path), fmt)


def stored(spark: SparkSession, name: str) -> Entry | None:
    """The entry of that name; None if there is none."""
    if not spark.catalog.tableExists(name):
        return None
    columns, partitions, about, part = {}, [], {}, "columns"
    for key, value, _ in spark.sql(f"DESCRIBE TABLE EXTENDED {full_name(name)}").collect():
        if key.startswith("# "):
            part = {"# Partition Information": "partitions", "# col_name": part}.get(key, "about")
        elif key and part == "columns":
            columns[key] = value
        elif key and part == "partitions":
            partitions.append(key)
        elif key:
            about[key] = value
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {full_name(name)}").collect()}
    return Entry(name, columns, partitions, about.get("Location", ""), about.get("Provider", "").lower(), properties)


def difference(old: Entry, new: Entry) -> Difference:
    both = [c for c in old.columns if c in new.columns]
    rest = [c for c in new.columns if c in old.columns]
    return Difference(
        {c: t for c, t in new.columns.items() if c not in old.columns},
        [c for c in old.columns if c not in new.columns],
        {c: t for c, t in new.columns.items() if old.columns.get(c, t) != t},
        old.partition_by != new.partition_by,
        both != rest,
        old.fmt != new.fmt,
        old.location.rstrip("/") != new.location.rstrip("/"),
    )


def create(entry: Entry) -> str:
    columns = ", ".join(f"{quoted(c)} {t}" for c, t in entry.columns.items())
    partitions = f" PARTITIONED BY ({', '.join(map(quoted, entry.partition_by))})" if entry.partition_by else ""
    kept = ", ".join(f"{text(k)} = {text(v)}" for k, v in entry.properties.items())
    properties = f" TBLPROPERTIES ({kept})" if kept else ""
    return f"CREATE TABLE {full_name(entry.name)} ({columns}) USING {entry.fmt}{partitions} LOCATION {text(entry.location)}{properties}"


def statements(old: Entry | None, new: Entry, tracked: bool = True) -> list[str]:
    """What turns the old entry into the new one; nothing where they agree.

    New columns are added to the entry, which stays. Of a table whose partitions are not tracked, a
    new location is one statement, so a reader sees the old or the new files and nothing between.
    The catalog can neither drop nor retype a column of a file table, and tracked partitions keep
    their old places: such an entry is made anew, with its properties. Files are never touched, as
    tables are external.
    """
    if old is None:
        return [create(new)]
    change, name = difference(old, new), full_name(new.name)
    moved = change.location and (tracked and bool(new.partition_by))
    at_end = [c for c in new.columns if c not in new.partition_by][-len(change.added) :] if change.added else []
    if change.dropped or change.retyped or change.partitioning or change.order or change.fmt or moved or at_end != list(change.added):
        return [f"DROP TABLE {name}", create(Entry(**{**new.__dict__, "properties": old.properties}))]
    out = []
    if change.added:
        out.append(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{quoted(c)} {t}' for c, t in change.added.items())})")
    if change.location:
        out.append(f"ALTER TABLE {name} SET LOCATION {text(new.location)}")
    return out


def bring(spark: SparkSession, new: Entry, tracked: bool = True) -> list[str]:
    """Make the catalog's entry what ``new`` says; returns the statements that were needed.

    Tracked partitions are entered and removed by the names of their folders. Those of other tables
    are found by Spark when the table is read.
    """
    if "." in new.name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {full_name(new.name.rpartition('.')[0])}")
    done = statements(stored(spark, new.name), new, tracked)
    before = spark.conf.get(TRACKING)
    spark.conf.set(TRACKING, str(tracked).lower())  # read when a table is made
    try:
        for statement in done:
            spark.sql(statement)
    finally:
        spark.conf.set(TRACKING, before)
    if tracked and new.partition_by:
        spark.sql(f"MSCK REPAIR TABLE {full_name(new.name)} SYNC PARTITIONS")
    spark.catalog.refreshTable(new.name)
    return done
