"""The daily run: validate, then build silver, gold, staging and marts, then test what was built."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial, reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trendmill.functions.parsing import to_timestamp
from trendmill.operators.filters import partition_safe
from trendmill.operators.scale import MAX_GROUP_ROWS, group_key, largest_group
from trendmill.operators.tabletests import observed_tests, require_counts, watched
from trendmill.plans import checks, gold, marts, staging
from trendmill.plans.silver import ENTITY, SNAPSHOT, silver_videos
from trendmill.plans.validation import CountStore, day_counts, results_with, store_counts
from trendmill.schemas import GOLD, GOLD_PARTITIONS, MART_PARTITIONS, SILVER, SILVER_PARTITIONS
from trendmill.session import configure, discarding_staged, exists, remove, side_by_side, stage
from trendmill.sources.bronze import read_bronze, require_input
from trendmill.sources.tables import (
    DEFAULT_FORMAT,
    database_for,
    read_table,
    register_table,
    register_view,
    replace_partitions,
    write_table,
)
from trendmill.sources.versions import VersionedTable, publish_all, published_path
from trendmill.streaming.feed import Feed, change_lists, feed_silver, read_changes


@dataclass(frozen=True)
class Lake:
    """Where the layers live. Databases are named only if the tables are to be registered.

    ``versioned`` tables are published version by version (see ``sources.versions``): the tables of a
    layer are all written before any is shown, and nothing that is read is ever written over. Such a
    lake needs a database and is built whole.
    """

    root: str
    database: str | None = None
    mart_database: str | None = None
    fmt: str = DEFAULT_FORMAT
    versioned: bool = False

    def __post_init__(self) -> None:
        if self.versioned and (self.database is None or self.fmt != DEFAULT_FORMAT):
            raise ValueError(f"versioned tables need a database and {DEFAULT_FORMAT}")

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def name(self, layer: str, table: str) -> str:
        """The table's name in the catalog."""
        if layer == "marts":
            return f"{database_for(self.mart_database, self.database)}.{table}"
        return f"{self.database}.{layer}_{table}"

    def versions(self, layer: str, table: str, schema: str = "", partition_by: list[str] = (), sort_by: list[str] = ()) -> VersionedTable:
        return VersionedTable(self.name(layer, table), self.path(layer, table), schema, tuple(partition_by), tuple(sort_by))


def read_layer(spark: SparkSession, lake: Lake, layer: str, table: str, schema: str | StructType) -> DataFrame:
    """A table of the lake; of a versioned lake the version that is published."""
    path = lake.path(layer, table)
    if lake.versioned:
        path = published_path(spark, lake.versions(layer, table))
    return read_table(spark, path, schema, lake.fmt)


def store_layer(
    lake: Lake, layer: str, tables: dict[str, DataFrame], schemas: dict[str, str], partition_by: list[str], order: dict[str, list[str]]
) -> dict[str, int]:
    """Write whole tables of a layer, and register them if the lake has a database; rows per table."""
    if lake.versioned:
        builds = [(df, lake.versions(layer, name, schemas[name], partition_by, order.get(name, []))) for name, df in tables.items()]
        spark = builds[0][0].sparkSession
        counts = publish_all(spark, builds)
        return {name: counts[lake.name(layer, name)] for name in tables}
    writes = [partial(write_table, df, lake.path(layer, name), partition_by, order.get(name), lake.fmt) for name, df in tables.items()]
    rows = {}
    for (name, df), count in zip(tables.items(), side_by_side(writes)):
        rows[name] = count
        if lake.database:
            register_table(df.sparkSession, lake.name(layer, name), lake.path(layer, name), schemas[name], partition_by, lake.fmt)
    return rows


@dataclass
class Run:
    """What a run wrote: rows per table, warnings of the validation, and failed table tests."""

    rows: dict[str, int] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)
    failed_tests: list[str] = field(default_factory=list)


def validate_layer(
    bronze: DataFrame, bronze_path: str, lake: Lake, fail_on_error: bool = True, results: DataFrame | None = None
) -> list[str]:
    """TB14: validate (or take the given results), write the report, then let a critical failure stop the run."""
    results = checks.fixed_results(checks.validate_bronze(bronze) if results is None else results)
    stamp = checks.run_timestamp()
    checks.write_report(checks.report_document(results, bronze_path, stamp), lake.path("reports", stamp))
    return checks.gate(results, fail_on_error)


class OtherDays(Exception):
    """Records of a day run that do not belong to its day."""


def require_day(bronze: DataFrame, day: str) -> None:
    """Raise unless all records were seen on ``day``; those without a readable time belong to no day."""
    seen = F.to_date(to_timestamp(F.col("ingested_at")))
    if not bronze.filter(~seen.eqNullSafe(F.lit(day).cast("date"))).isEmpty():
        raise OtherDays(f"records of other days, or without a day, in the input for {day}")


def build_silver(bronze: DataFrame, lake: Lake, grain: str = "day", day: str | None = None) -> int:
    """TB1, SK1. The input is checked before anything is overwritten.

    With ``day`` the input must be all records of that day; they replace that day in the history.
    Partitions follow the publishing month, so those with rows of the day, old or new, are written
    again, and no other.
    """
    require_input(bronze, "silver")
    if day is not None:
        if lake.versioned:
            raise ValueError("a day can be replaced in tables without versions only")
        if lake.fmt != DEFAULT_FORMAT:
            raise ValueError(f"a day can be replaced in {DEFAULT_FORMAT} tables only")
        if grain != "day":
            raise ValueError("only a history with a row per day can have a day replaced")
        require_day(bronze, day)
    return write_silver(silver_videos(bronze, grain), lake, day)


def write_silver(silver: DataFrame, lake: Lake, day: str | None = None) -> int:
    """Store silver rows, all or those of a day."""
    spark, path = silver.sparkSession, lake.path("silver", "videos")
    if day is None or not exists(spark, path):
        return store_layer(lake, "silver", {"videos": silver}, {"videos": SILVER}, SILVER_PARTITIONS, {"videos": ["ingested_at"]})["videos"]
    else:
        old = read_table(spark, path, SILVER, lake.fmt)
        # Bounds on the stored time itself are pushed down to the files, which are sorted by it.
        begin = F.lit(day).cast("timestamp")
        of_day = (F.col("ingested_at") >= begin) & (F.col("ingested_at") < begin + F.expr("INTERVAL 1 DAY"))
        fresh = stage(silver, "silver")
        found = old.filter(of_day).select(*SILVER_PARTITIONS).union(fresh.select(*SILVER_PARTITIONS)).distinct()
        touched = [row.asDict() for row in found.collect()]  # regions times months
        near = reduce(or_, [reduce(and_, [F.col(c) == v for c, v in values.items()]) for values in touched], F.lit(False))
        others = old.filter(near & (~of_day | F.col("ingested_at").isNull()))
        merged = stage(others.unionByName(fresh), "silver")
        rows = replace_partitions(merged, path, SILVER_PARTITIONS, touched, ["ingested_at"])
    if lake.database:
        register_table(spark, lake.name("silver", "videos"), path, SILVER, SILVER_PARTITIONS, lake.fmt)
    return rows


def gold_tables(
    snaps: DataFrame, group_rows: int, max_group_rows: int = MAX_GROUP_ROWS
) -> dict[str, DataFrame]:
    """``group_rows`` bounds the rows of ``snaps`` per region and day, on which only plans depend."""
    return {
        "daily_trending_rank": gold.daily_trending_rank(snaps, group_rows, max_group_rows=max_group_rows),
        "category_stats": gold.category_stats(snaps),
        "channel_stats": gold.channel_stats(snaps),
        "channel_titles": gold.channel_titles(snaps),
        "view_velocity": gold.view_velocity(snaps),
    }


def days_after(history: DataFrame, keys: DataFrame, day: str) -> list[str]:
    """The days of the next snapshots, after ``day``, of the given videos and regions."""
    later = history.filter(F.col(SNAPSHOT) > F.lit(day).cast("date")).select(*ENTITY, SNAPSHOT)
    following = later.join(keys.distinct(), ENTITY, "left_semi").groupBy(*ENTITY).agg(F.min(SNAPSHOT).alias(SNAPSHOT))
    return [str(row[0]) for row in following.select(SNAPSHOT).distinct().collect()]


def build_gold(
    spark: SparkSession, lake: Lake, day: str | None = None, max_group_rows: int = MAX_GROUP_ROWS
) -> dict[str, int]:
    """TB2-TB5, SK2. Each table is one read of the needed silver columns and one write.

    With ``day`` that day's partitions are replaced, and removed where the day has no more rows.
    Growth is also renewed on the days that hold the next snapshot of a video that is, or was, in it.
    """
    silver = read_layer(spark, lake, "silver", "videos", SILVER)
    require_input(silver, "gold")
    history = gold.snapshots(silver)
    snaps = gold.snapshots(silver, day)
    tables = gold_tables(snaps, largest_group(snaps, gold.DAY), max_group_rows)
    if day is None:
        return store_layer(lake, "gold", tables, GOLD, GOLD_PARTITIONS, GOLD_ORDER)
    renewed = {name: [day] for name in tables}
    before = read_layer(spark, lake, "gold", "view_velocity", GOLD["view_velocity"])
    keys = gold.on_date(before, SNAPSHOT, day).select(*ENTITY).union(snaps.select(*ENTITY))
    renewed["view_velocity"] = [day, *days_after(history, keys, day)]
    tables["view_velocity"] = gold.velocity_of_days(history, renewed["view_velocity"])
    old = {name: read_layer(spark, lake, "gold", name, GOLD[name]).filter(gold.is_on(renewed[name])) for name in tables}
    return replace_gold(spark, lake, tables, {name: df.select(*GOLD_PARTITIONS) for name, df in old.items()})


GOLD_ORDER = {"daily_trending_rank": ["trending_rank"]}


def replace_gold(spark: SparkSession, lake: Lake, tables: dict[str, DataFrame], partitions: dict[str, DataFrame]) -> dict[str, int]:
    """Write tables over their partitions in gold and remove those of ``partitions`` (regions times days) that they have no row of."""

    def replace(name: str) -> int:
        touched = [row.asDict() for row in partitions[name].distinct().collect()]
        return replace_partitions(stage(tables[name], name), lake.path("gold", name), GOLD_PARTITIONS, touched, GOLD_ORDER.get(name))

    rows = {}
    for name, count in zip(tables, side_by_side([partial(replace, name) for name in tables])):
        rows[name] = count
        if lake.database:
            register_table(spark, lake.name("gold", name), lake.path("gold", name), GOLD[name], GOLD_PARTITIONS, lake.fmt)
    return rows


def read_gold(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    return {name: read_layer(spark, lake, "gold", name, schema) for name, schema in GOLD.items()}


def staging_views(gold_layer: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """SK4, SC5: staging is lazy; each table is also a view of the session."""
    views = {}
    for name, (source, build) in staging.STAGING.items():
        views[name] = build(gold_layer[source])
        register_view(views[name], name)
    return views


def mart_tables(
    stg: dict[str, DataFrame], group_rows: int, max_group_rows: int = MAX_GROUP_ROWS
) -> dict[str, DataFrame]:
    """``group_rows`` bounds the rows of every staging table per region and day."""
    scale = {"group_rows": group_rows, "max_group_rows": max_group_rows}
    return {
        "fct_trending_leaderboard": marts.fct_trending_leaderboard(stg["stg_daily_trending_rank"]),
        "fct_top_channels": marts.fct_top_channels(stg["stg_channel_stats"], **scale),
        "fct_category_performance": marts.fct_category_performance(stg["stg_category_stats"], **scale),
        "fct_momentum_videos": marts.fct_momentum_videos(stg["stg_view_velocity"], **scale),
    }


def store_tested_marts(
    spark: SparkSession, lake: Lake, max_group_rows: int = MAX_GROUP_ROWS
) -> tuple[dict[str, int], DataFrame]:
    """TB10-TB13, SK3: write the marts; rows per mart, and the verdicts of all declared tests (DQ18, DQ19).

    Every mart reads its gold table and staging view whole. All tests are counted during these
    writes, so that tables are read again only for tests that fail.
    """
    layer = read_gold(spark, lake)
    views = staging_views(layer)
    bound = largest_group(layer["daily_trending_rank"], gold.DAY)
    watches = []

    def watch(df: DataFrame, name: str) -> DataFrame:
        seen, own = watched(df, name, checks.NOT_NULL, checks.ACCEPTED)
        watches.append(own)
        return seen

    # The views of the session are other frames, as filters of later readers must reach the files.
    stg = {name: watch(build(watch(layer[source], source)), name) for name, (source, build) in staging.STAGING.items()}
    tables = {name: watch(df, name) for name, df in mart_tables(stg, bound, max_group_rows).items()}
    schemas = {name: df.schema for name, df in tables.items()}
    order = {name: [c for c in marts.REPORT_ORDER[name] if c not in MART_PARTITIONS] for name in tables}
    rows = store_layer(lake, "marts", tables, schemas, MART_PARTITIONS, order)
    built = {name: read_layer(spark, lake, "marts", name, schema) for name, schema in schemas.items()}
    return rows, observed_tests(spark, watches, layer | views | built)


def build_marts(spark: SparkSession, lake: Lake, max_group_rows: int = MAX_GROUP_ROWS) -> Run:
    """The marts with the declared tests of all tables, then the row gate (DQ18-20)."""
    run = Run()
    run.rows, tests = store_tested_marts(spark, lake, max_group_rows)
    failed = tests.filter("should_error").collect()
    run.failed_tests = [f"{row.test}_{row.table_name}_{row.column_name}" for row in failed]
    require_counts(run.rows)
    return run


APPLIED = "name STRING"


def _applied_path(lake: Lake, grain: str) -> str:
    return lake.path("applied", f"feed-{grain}")


def _mark_applied(spark: SparkSession, lake: Lake, grain: str, names: list[str], mode: str) -> None:
    spark.createDataFrame([(name,) for name in names], APPLIED).coalesce(1).write.mode(mode).json(_applied_path(lake, grain))


def pending_changes(spark: SparkSession, feed: Feed, lake: Lake, grain: str = "day") -> list[str] | None:
    """The lists of changes that the lake has not taken up; None if it was not built from the feed with that grain."""
    path = _applied_path(lake, grain)
    if not exists(spark, f"{path}/_SUCCESS"):
        return None
    done = {row.name for row in spark.read.schema(APPLIED).json(path).collect()}  # one for each batch
    return [name for name in change_lists(spark, feed) if name not in done]


def _only(df: DataFrame, keys: DataFrame, columns: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose values of ``columns`` are (not) in ``keys``; NULL matches NULL."""
    wanted = keys.select(group_key(columns).alias("_key")).distinct()
    return df.withColumn("_key", group_key(columns)).join(wanted, "_key", how).drop("_key")


def _silver_partitions(changes: DataFrame) -> list[dict]:
    """The partitions that hold, or held, a changed record: regions times months."""
    times = F.explode(F.array(to_timestamp(F.col("published_at")), to_timestamp(F.col("old_published_at")))).alias("published")
    found = changes.select("region", times).select("region", F.year("published").alias("published_year"), F.month("published").alias("published_month"))
    return [row.asDict() for row in partition_safe(found, SILVER_PARTITIONS).distinct().collect()]


def apply_to_silver(spark: SparkSession, feed: Feed, lake: Lake, changes: DataFrame, days: list) -> int:
    """Write the partitions again that changed records are, or were, in; other rows of these are kept as they are."""
    path, touched = lake.path("silver", "videos"), _silver_partitions(changes)
    if not touched:
        return 0
    near = reduce(or_, [reduce(and_, [F.col(c) == v for c, v in values.items()]) for values in touched])
    old = gold.snapshots(read_table(spark, path, SILVER, lake.fmt).filter(near))
    new = _only(gold.snapshots(feed_silver(spark, feed, days=days)), changes, [*ENTITY, SNAPSHOT])
    changed_day = F.coalesce(gold.is_on([str(day) for day in days if day is not None]), F.lit(None in days))
    kept = old.filter(~changed_day)  # rows of other days have other keys, so they need no join
    merged = kept.unionByName(_only(old.filter(changed_day), changes, [*ENTITY, SNAPSHOT], "left_anti")).unionByName(new).drop(SNAPSHOT)
    rows = replace_partitions(stage(merged, "silver"), path, SILVER_PARTITIONS, touched, ["ingested_at"])
    if lake.database:
        register_table(spark, lake.name("silver", "videos"), path, SILVER, SILVER_PARTITIONS, lake.fmt)
    return rows


def following_days(history: DataFrame, changes: DataFrame) -> DataFrame:
    """region and day of the next snapshot of each changed video; a record without a day comes before all others."""
    first = F.lit("0001-01-01").cast("date")
    changed = changes.select(*ENTITY, F.coalesce(SNAPSHOT, first).alias("_changed")).distinct()
    later = history.select(*ENTITY, SNAPSHOT).join(changed, ENTITY).filter(F.col(SNAPSHOT) > F.col("_changed"))
    return later.groupBy(*ENTITY, "_changed").agg(F.min(SNAPSHOT).alias(SNAPSHOT)).select(*GOLD_PARTITIONS)


def apply_to_gold(
    spark: SparkSession, feed: Feed, lake: Lake, changes: DataFrame, days: list, max_group_rows: int = MAX_GROUP_ROWS
) -> dict[str, int]:
    """TB2-TB5: write the regions and days again that have a changed record, and no others.

    The rows come from the state of the feed, which is partitioned by day, so other days are not
    read. Growth is also renewed where the next snapshot of a changed video is; for that the keys of
    the whole history are read, and the series of the videos that are on these days.
    """
    pairs = stage(changes.filter("region <> ''").select(*GOLD_PARTITIONS).distinct(), "pairs")
    snaps = stage(_only(gold.snapshots(feed_silver(spark, feed, days=days)), pairs, GOLD_PARTITIONS), "snaps")
    tables = gold_tables(snaps, largest_group(snaps, gold.DAY), max_group_rows)
    history = gold.snapshots(feed_silver(spark, feed))
    renewed = stage(pairs.unionByName(following_days(history, changes)).distinct(), "renewed")
    videos = _only(history.select(*ENTITY, SNAPSHOT), renewed, GOLD_PARTITIONS)
    # No record is without video or region; joined by these columns, the series are in place for their window.
    series = history.select(*gold.VELOCITY_COLUMNS).join(videos.select(*ENTITY).distinct(), ENTITY, "left_semi")
    tables["view_velocity"] = _only(gold.view_velocity(series), renewed, GOLD_PARTITIONS)
    return replace_gold(spark, lake, tables, {name: renewed if name == "view_velocity" else pairs for name in tables})


def run_feed(
    spark: SparkSession, feed: Feed, lake: Lake, grain: str = "day", max_group_rows: int = MAX_GROUP_ROWS
) -> Run:
    """ST1 to the marts: silver and gold from the state of the feed, then marts as in the daily run.

    The first run builds all. Later ones take up the changes that the feed's batches have listed: only
    silver partitions, and regions and days of gold, with a changed record are written again. They are
    marked as taken up at the end, so that a run that fails is repeated by the next one. A lake with
    versions, or with one row per video, is built whole each time.
    """
    configure(spark)
    with discarding_staged(spark):
        whole = grain != "day" or lake.versioned or lake.fmt != DEFAULT_FORMAT
        names = None if whole else pending_changes(spark, feed, lake, grain)
        if names is None:
            names = change_lists(spark, feed)  # before the state is read
            remove(spark, lake.path("applied", ""))
            rows = {"silver_videos": write_silver(feed_silver(spark, feed, grain), lake)}
            rows |= build_gold(spark, lake, None, max_group_rows)
            mode = "overwrite"
        else:
            rows, mode = {}, "append"
            changes = stage(read_changes(spark, feed, names), "changes") if names else None
            if changes is not None and not changes.isEmpty():
                days = [row[0] for row in changes.select(SNAPSHOT).distinct().collect()]
                rows = {"silver_videos": apply_to_silver(spark, feed, lake, changes, days)}
                rows |= apply_to_gold(spark, feed, lake, changes, days, max_group_rows)
        run = build_marts(spark, lake, max_group_rows)
        if not whole and (names or mode == "overwrite"):
            _mark_applied(spark, lake, grain, names, mode)
    return Run(rows | run.rows, [], run.failed_tests)


def run_daily(
    spark: SparkSession,
    bronze_path: str | list[str],
    lake: Lake,
    grain: str = "day",
    day: str | None = None,
    fail_on_error: bool = True,
    max_group_rows: int = MAX_GROUP_ROWS,
    on_step: Callable[[str], None] = lambda step: None,
    keep_counts: bool = False,
) -> Run:
    """All steps in order; any failure stops the run.

    With ``day`` the input is that day's records: silver and gold of the day are replaced, and the
    marts, which are small, built again. ``max_group_rows`` is the largest group of one region and
    day that one task may have to sort. With ``keep_counts`` the verdicts are on the whole history: the
    counts of its days are kept in the lake, and a day run reads them instead of the older records.
    """
    configure(spark)
    bronze = read_bronze(spark, bronze_path)
    with discarding_staged(spark):
        on_step("validate")
        store, counts, results = CountStore(lake.path("validation", "counts")), None, None
        if keep_counts:
            counts = stage(day_counts(bronze), "counts")
            results = results_with(counts, store, day)
        warnings = validate_layer(bronze, str(bronze_path), lake, fail_on_error, results)
        on_step("silver")
        rows = {"silver_videos": build_silver(bronze, lake, grain, day)}
        if counts is not None:
            store_counts(counts, store, day)
        on_step("gold")
        rows |= build_gold(spark, lake, day, max_group_rows)
        on_step("marts")
        run = build_marts(spark, lake, max_group_rows)
    return Run(rows | run.rows, warnings, run.failed_tests)
