"""Catalog entries that follow schema and location, and tables published version by version."""

import pytest
from pyspark.sql import functions as F

from trendmill.sources import catalog, tables, versions
from trendmill.sources.versions import NoVersion, VersionedTable, publish, publish_all, published, read_version, retain, write_version

NAME = "trendmill_entries.t"


@pytest.fixture
def entries(spark):
    spark.sql("DROP DATABASE IF EXISTS trendmill_entries CASCADE")
    yield spark
    spark.sql("DROP DATABASE IF EXISTS trendmill_entries CASCADE")


def register(spark, df, path, schema):
    tables.write_table(df, path, ["p"])
    old = catalog.stored(spark, NAME)
    new = catalog.declared(spark, NAME, path, schema, ["p"], "parquet")
    needed = catalog.statements(old, new)
    tables.register_table(spark, NAME, path, schema, ["p"])
    return [s.split()[0] for s in needed]


def rows(spark, *columns):
    return sorted(tuple(r) for r in spark.table(NAME).select(*columns).collect())


def test_entry_follows_schema_and_location(entries, tmp_path):
    spark, path = entries, str(tmp_path / "one")
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "p string, v int, w string")
    assert register(spark, df, path, "v int, w string, p string") == ["CREATE"]
    spark.sql(f"ALTER TABLE {NAME} SET TBLPROPERTIES ('kept' = 'it''s')")
    assert register(spark, df, path, "v int, w string, p string") == []

    wider = df.withColumn("n", F.lit(5).cast("bigint"))
    assert register(spark, wider, path, "v int, w string, n bigint, p string") == ["ALTER"]
    assert rows(spark, "p", "v", "w", "n") == [("a", 1, "x", 5), ("b", 2, "y", 5)]

    narrow = wider.select("p", F.col("v").cast("double"), "n")  # w is gone, v has another type
    assert register(spark, narrow, path, "v double, n bigint, p string") == ["DROP", "CREATE"]
    assert spark.table(NAME).dtypes == [("v", "double"), ("n", "bigint"), ("p", "string")]
    assert rows(spark, "p", "v") == [("a", 1.0), ("b", 2.0)]

    moved = spark.createDataFrame([("c", 3.0, 1)], "p string, v double, n bigint")
    register(spark, moved, str(tmp_path / "two"), "v double, n bigint, p string")
    assert rows(spark, "p", "v") == [("c", 3.0)]
    assert catalog.stored(spark, NAME).properties["kept"] == "it's"
    assert spark.read.parquet(path).count() == 2  # the files of the old place stay


def test_differences(entries, tmp_path):
    def entry(schema, partition_by=("p",), path="/a", fmt="parquet"):
        return catalog.declared(entries, NAME, path, schema, list(partition_by), fmt)

    old = entry("v int, w string, p string")
    assert not catalog.difference(old, entry("v int, w string, p string", path="/a/"))
    change = catalog.difference(old, entry("w int, x date, p string", path="/b"))
    assert (change.added, change.dropped, change.retyped, change.location) == ({"x": "date"}, ["v"], {"w": "int"}, True)
    assert catalog.difference(old, entry("w string, v int, p string")).order
    assert catalog.difference(old, entry("v int, w string, p string", ("w", "p"))).partitioning
    assert [s.split()[0] for s in catalog.statements(old, entry("n int, v int, w string, p string"))] == ["DROP", "CREATE"]
    assert catalog.statements(old, entry("v int, w string, p string", path="/b"), tracked=False) == [
        "ALTER TABLE `trendmill_entries`.`t` SET LOCATION 'file:/b'"
    ]


def test_odd_names(entries, tmp_path):
    path = str(tmp_path / "it's")
    tables.write_table(entries.createDataFrame([(1, "a")], "`a b` int, p string"), path, ["p"])
    tables.register_table(entries, NAME, path, "`a b` int, p string", ["p"])
    tables.register_table(entries, NAME, path, "`a b` int, `x``y` int, p string", ["p"])
    assert rows(entries, "`a b`", "`x``y`") == [(1, None)]


def test_catalog_view(entries, tmp_path):
    tables.write_table(entries.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), str(tmp_path / "t"), ["p"])
    tables.register_table(entries, NAME, str(tmp_path / "t"), "v int, p string", ["p"])
    tables.register_catalog_view(entries, "trendmill_entries.large", f"SELECT * FROM {NAME} WHERE v > 1")
    assert [tuple(r) for r in entries.newSession().table("trendmill_entries.large").collect()] == [(2, "b")]


# Versions


def numbers(spark, *values):
    return spark.createDataFrame([(v, "even" if v % 2 == 0 else "odd") for v in values], "v int, p string")


@pytest.fixture
def table(tmp_path):
    return VersionedTable(NAME, str(tmp_path / "t"), "v int, p string", ("p",), ("v",))


def seen(df):
    return sorted(r.v for r in df.collect())


def failing(df):
    return df.withColumn("v", F.when(F.col("p") == "odd", F.raise_error(F.lit("half-way")).cast("int")).otherwise(F.col("v")))


def test_versions_are_read_and_switched(entries, table):
    spark = entries
    assert versions.versions(spark, table) == [] and published(spark, table) is None
    first, rows_written = write_version(numbers(spark, 1, 2), table)
    assert (first, rows_written) == (1, 2) and published(spark, table) is None
    publish(spark, table, 1)
    held = spark.table(NAME)
    assert seen(held) == [1, 2]
    second, _ = write_version(numbers(spark, 3), table)
    assert seen(spark.table(NAME)) == [1, 2]
    assert publish(spark, table, second) == [f"ALTER TABLE `trendmill_entries`.`t` SET LOCATION 'file:{table.path(2)}'"]
    assert seen(spark.table(NAME)) == [3] and seen(read_version(spark, table)) == [3] and seen(read_version(spark, table, 1)) == [1, 2]
    publish(spark, table, 1)  # back again
    assert seen(spark.table(NAME)) == [1, 2]


def test_a_failed_build_is_never_seen(entries, table):
    spark = entries
    publish(spark, table, write_version(numbers(spark, 1, 2), table)[0])
    with pytest.raises(Exception, match="half-way"):
        write_version(failing(numbers(spark, 4, 5)), table)
    assert versions.versions(spark, table) == [1] and seen(spark.table(NAME)) == [1, 2]
    with pytest.raises(NoVersion):
        publish(spark, table, 2)
    with pytest.raises(NoVersion):
        read_version(spark, table, 2)
    number, _ = write_version(numbers(spark, 6), table)
    publish(spark, table, number)
    assert seen(spark.table(NAME)) == [6] and seen(read_version(spark, table, 1)) == [1, 2]


def test_a_version_is_never_written_over(entries, table, monkeypatch):
    write_version(numbers(entries, 1), table)
    monkeypatch.setattr(versions, "_folders", lambda spark, t: [])  # another build that looked before
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        write_version(numbers(entries, 2), table)
    monkeypatch.undo()
    assert seen(read_version(entries, table, 1)) == [1]


def test_all_tables_or_none(entries, table, tmp_path):
    other = VersionedTable("trendmill_entries.u", str(tmp_path / "u"), "v int, p string", ("p",))
    assert publish_all(entries, [(numbers(entries, 1), table), (numbers(entries, 2, 3), other)]) == {NAME: 1, other.name: 2}
    with pytest.raises(Exception, match="half-way"):
        publish_all(entries, [(numbers(entries, 7), table), (failing(numbers(entries, 8, 9)), other)])
    assert seen(entries.table(NAME)) == [1] and seen(entries.table(other.name)) == [2, 3]


def test_retention(entries, table):
    for v in range(5):
        publish(entries, table, write_version(numbers(entries, v), table)[0])
    publish(entries, table, 3)
    assert retain(entries, table, 1) == [1, 2] and versions.versions(entries, table) == [3, 4, 5]
    publish(entries, table, 5)
    assert retain(entries, table, 2) == [3] and seen(read_version(entries, table, 4)) == [3]
    with pytest.raises(ValueError):
        retain(entries, table, 0)


def test_a_version_with_other_columns(entries, table):
    publish(entries, table, write_version(numbers(entries, 1), table)[0])
    wider = VersionedTable(NAME, table.root, "v bigint, n string, p string", ("p",))
    df = numbers(entries, 2).select(F.col("v").cast("bigint"), F.lit("x").alias("n"), "p")
    publish(entries, wider, write_version(df, wider)[0])
    assert [tuple(r) for r in entries.table(NAME).collect()] == [(2, "x", "even")]
    assert seen(read_version(entries, table, 1)) == [1]


def test_a_versioned_lake_shows_whole_layers(entries, tmp_path):
    """A second build changes what the catalog shows, not what was read before; a day cannot be replaced in it."""
    from test_layers import at
    from test_quality import records
    from trendmill.plans import daily

    spark = entries
    lake = daily.Lake(str(tmp_path / "lake"), database="trendmill_entries", versioned=True)
    for n in (2, 3):
        bronze = records(spark, *[at(d, video_id=f"v{i}", view_count=10 * i * d) for i in range(n) for d in (1, 2)])
        daily.build_silver(bronze, lake)
        assert daily.build_gold(spark, lake)["view_velocity"] == 2 * n
        run = daily.build_marts(spark, lake)
        assert run.rows["fct_top_channels"] == spark.table("trendmill_entries.fct_top_channels").count() > 0
        assert spark.table("trendmill_entries.gold_view_velocity").count() == daily.read_gold(spark, lake)["view_velocity"].count() == 2 * n
    first = read_version(spark, lake.versions("gold", "view_velocity", daily.GOLD["view_velocity"]), 1)
    assert first.count() == 4
    with pytest.raises(ValueError, match="versions"):
        daily.build_silver(bronze, lake, day="2026-01-01")
    with pytest.raises(ValueError, match="database"):
        daily.Lake("x", versioned=True)
