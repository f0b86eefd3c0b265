"""Stored tables: partitioned writes with observed counts, reads, and catalog registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trendmill.session import remove
from trendmill.sources import catalog

DEFAULT_FORMAT = "parquet"


def read_table(
    spark: SparkSession, path: str, schema: str | StructType | None = None, fmt: str = DEFAULT_FORMAT
) -> DataFrame:
    """SC3. The declared schema fixes the types of partition columns as well.

    Formats that keep a schema of their own are read with that.
    """
    reader = spark.read.format(fmt)
    if schema is not None and fmt == DEFAULT_FORMAT:
        reader = reader.schema(schema)
    return reader.load(path)


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    """SC4."""
    return spark.table(name)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str],
    sort_by: list[str] | None = None,
    fmt: str = DEFAULT_FORMAT,
    dynamic: bool = False,
    mode: str = "overwrite",
) -> int:
    """SK1-3, SK8, SO1: overwrite a partitioned table and return the rows written.

    Rows are gathered by partition before the write to keep files few; the rebalance hint lets AQE
    split a partition that is too large for one task and merge small ones. ``sort_by`` orders the
    rows within each file. The count is observed on the tasks that write, without a second scan.
    ``dynamic`` replaces the partitions present in ``df`` only; else the whole table and its schema.
    With ``mode`` "error" a table that is there already is left as it is, and the write fails.
    """
    counted = Observation()
    laid_out = df.hint("rebalance", *partition_by).observe(counted, F.count(F.lit(1)).alias("rows"))
    if sort_by:
        laid_out = laid_out.sortWithinPartitions(*partition_by, *sort_by)
    writer = laid_out.write.format(fmt).mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.option("partitionOverwriteMode", "static")
        if fmt != DEFAULT_FORMAT:
            writer = writer.option("overwriteSchema", "true")
    writer.partitionBy(*partition_by).save(path)
    return counted.get["rows"]


def database_for(custom: str | None, default: str) -> str:
    """SK9: a custom database name is used as it is, else the default."""
    return default if custom is None else custom.strip()


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: str | StructType,
    partition_by: list[str],
    fmt: str = DEFAULT_FORMAT,
) -> None:
    """SK7: make the files at ``path`` known as an external table of the declared schema.

    An existing entry is brought to that schema, partitioning and location, and keeps its properties;
    where nothing has changed, only partitions that are new or gone are entered or removed.
    """
    if fmt != DEFAULT_FORMAT:
        if "." in name:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rpartition('.')[0]}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
        return
    catalog.bring(spark, catalog.declared(spark, name, path, schema, partition_by, fmt))


def register_view(df: DataFrame, name: str) -> None:
    """SK4: a lazy view of the session, where no catalog keeps the tables."""
    df.createOrReplaceTempView(name)


def register_catalog_view(spark: SparkSession, name: str, query: str) -> None:
    """SK4: a view that the catalog keeps, over tables that it knows; it outlives the session."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {catalog.full_name(name.rpartition('.')[0])}")
    spark.sql(f"CREATE OR REPLACE VIEW {catalog.full_name(name)} AS {query}")


def drop_partitions(spark: SparkSession, path: str, partitions: list[dict]) -> None:
    """Remove the folders of partitions; NULL is the name that Spark writes for it."""
    for values in partitions:
        named = [f"{k}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for k, v in values.items()]
        remove(spark, "/".join([path.rstrip("/"), *named]))


def replace_partitions(df: DataFrame, path: str, partition_by: list[str], touched: list[dict], sort_by: list[str] | None = None) -> int:
    """Write ``df`` over the partitions ``touched``, all of it, and remove those that got no row.

    ``df`` must not read the files at ``path``, and must have rows of touched partitions only.
    """
    spark = df.sparkSession
    rows = write_table(df, path, partition_by, sort_by, dynamic=True)
    filled = {tuple(row) for row in df.select(*partition_by).distinct().collect()}
    gone = [values for values in touched if tuple(values[c] for c in partition_by) not in filled]
    drop_partitions(spark, path, gone)
    return rows
