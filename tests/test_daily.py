"""The whole run over landed files, and the plans it relies on."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from trendmill.operators.quality import ExpectationsFailed
from trendmill.plans import daily, gold, marts, staging
from trendmill.plans.silver import silver_videos
from trendmill.session import scratch_root
from trendmill.sources.bronze import EmptyInput, land, landing_glob
from trendmill.sources.events import bronze_from_events, read_events

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events_bronze(spark):
    """The records of five days, one with an unknown category; few partitions keep the runs short."""
    return bronze_from_events(read_events(spark, SF_DIR).filter("ts >= '2024-01-13' AND ts < '2024-01-18'"))


@pytest.fixture(scope="module")
def expected_rows(events_bronze):
    silver = silver_videos(events_bronze)
    layer = daily.gold_tables(gold.snapshots(silver), 1)
    stg = {name: build(layer[source]) for name, (source, build) in staging.STAGING.items()}
    tables = {"silver_videos": silver} | layer | daily.mart_tables(stg, 1)
    return {name: df.count() for name, df in tables.items()}


@pytest.fixture(scope="module")
def landed(events_bronze, tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    land(events_bronze.repartition(3), f"{root}/2024/01/01/00")
    return landing_glob(f"{root}/2024")


@pytest.fixture(scope="module")
def run(spark, landed, tmp_path_factory):
    lake = daily.Lake(str(tmp_path_factory.mktemp("lake")), "lake", "lake_marts")
    steps = []
    result = daily.run_daily(spark, landed, lake, fail_on_error=False, on_step=steps.append)
    assert steps == ["validate", "silver", "gold", "marts"]
    return lake, result


def test_rows_written(spark, run, expected_rows):
    lake, result = run
    assert result.rows == expected_rows and min(expected_rows.values()) > 0
    for name, rows in result.rows.items():
        layer = "silver" if name.startswith("silver") else "marts" if name.startswith("fct") else "gold"
        table = "videos" if layer == "silver" else name
        assert spark.read.parquet(lake.path(layer, table)).count() == rows


def test_tables_are_registered(spark, run):
    _, result = run
    names = {"silver_videos": "lake.silver_videos", "category_stats": "lake.gold_category_stats"}
    names |= {name: f"lake_marts.{name}" for name in marts.REPORT_ORDER}
    assert {name: spark.table(table).count() for name, table in names.items()} == {
        name: result.rows[name] for name in names
    }
    assert spark.sql("SELECT count(*) FROM stg_channel_stats").first()[0] == result.rows["channel_stats"]


def test_only_unknown_categories_fail_tests(run):
    _, result = run
    assert sorted(result.failed_tests) == [
        "not_null_category_stats_category_id",
        "not_null_stg_category_stats_category_id",
    ]
    assert result.warnings == ["video_region_key_mostly_unique"]


def test_report_is_written_before_the_gate_stops_the_run(spark, landed, tmp_path):
    lake = daily.Lake(str(tmp_path))
    with pytest.raises(ExpectationsFailed):
        daily.run_daily(spark, landed, lake)
    assert [p.name for p in tmp_path.iterdir()] == ["reports"]


def test_empty_input_keeps_the_old_table(spark, run):
    lake, _ = run
    with pytest.raises(EmptyInput):
        daily.build_silver(spark.createDataFrame([], "video_id string"), lake)
    assert spark.read.parquet(lake.path("silver", "videos")).count() == run[1].rows["silver_videos"]


def test_rerun_changes_nothing(spark, run, landed):
    lake, result = run
    before = {n: spark.read.parquet(lake.path("marts", n)).collect() for n in marts.REPORT_ORDER}
    again = daily.run_daily(spark, landed, lake, fail_on_error=False)
    assert again.rows == result.rows
    for name, rows in before.items():
        assert sorted(map(str, spark.read.parquet(lake.path("marts", name)).collect())) == sorted(map(str, rows))


def test_large_groups_give_the_same_tables(spark, run, landed, tmp_path):
    lake, result = run
    split = daily.Lake(str(tmp_path))
    folder = Path(scratch_root(spark).removeprefix("file:"), "trendmill")
    before = set(folder.glob("*"))
    rows = daily.run_daily(spark, landed, split, fail_on_error=False, max_group_rows=3).rows
    assert rows == result.rows
    names = [("gold", name) for name in daily.GOLD] + [("marts", name) for name in marts.REPORT_ORDER]
    for layer, name in names:
        whole, parts = (
            spark.read.parquet(each.path(layer, name)).drop("_gold_processed_at") for each in (lake, split)
        )
        assert whole.exceptAll(parts).isEmpty() and parts.exceptAll(whole).isEmpty(), name
    assert not set(folder.glob("*")) - before, "nothing staged stays behind"


def contents(spark, lake):
    tables = daily.read_gold(spark, lake) | {"silver": spark.read.parquet(lake.path("silver", "videos"))}
    stamps = ["_gold_processed_at", "_silver_processed_at"]
    return {
        name: sorted(map(str, df.drop(*stamps).select(sorted(set(df.columns) - set(stamps))).collect()))
        for name, df in tables.items()
    }


def test_one_day_is_replaced(spark, events_bronze, tmp_path):
    """Late, changed and vanished records of a day, a region it loses, and the next snapshots."""
    day = "2024-01-15"
    of_day = F.col("ingested_at").startswith(day)
    early = events_bronze.filter(~of_day | (F.col("comment_count") % 2 == 0))
    lost = events_bronze.filter(of_day & (F.col("region") == "US")).withColumn("region", F.lit("ZZ"))
    lake, whole = daily.Lake(str(tmp_path / "a")), daily.Lake(str(tmp_path / "b"))
    daily.build_silver(early.unionByName(lost), lake)
    daily.build_gold(spark, lake)
    daily.build_silver(events_bronze.filter(of_day), lake, day=day)
    daily.build_gold(spark, lake, day)
    daily.build_silver(events_bronze, whole)
    daily.build_gold(spark, whole)
    assert contents(spark, lake) == contents(spark, whole)


def test_a_day_run_refuses_other_days(spark, run, events_bronze):
    lake, result = run
    with pytest.raises(daily.OtherDays):
        daily.build_silver(events_bronze, lake, day="2024-01-16")
    assert spark.read.parquet(lake.path("silver", "videos")).count() == result.rows["silver_videos"]


def test_day_reads_prune_gold_and_push_down_in_silver(spark, run):
    lake, _ = run
    table = daily.read_gold(spark, lake)["view_velocity"]
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan_of(gold.on_date(table, "snapshot_date", "2024-01-16"))
    assert "PartitionFilters: [snapshot_date" in plan_of(table.filter(gold.is_on(["2024-01-16", "2024-01-17"])))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_plan(events_bronze):
    plan = plan_of(silver_videos(events_bronze))
    assert "Python" not in plan
    assert plan.count("Exchange") == 1
    assert plan.count("WindowGroupLimit") == 2
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below, "rows are limited before they are shuffled"


def test_leaderboard_plan(events_bronze):
    snaps = gold.snapshots(silver_videos(events_bronze))
    best = gold.daily_trending_rank(snaps, top=10)
    plan = plan_of(marts.fct_trending_leaderboard(staging.stg_daily_trending_rank(best)))
    assert plan.count("Exchange hashpartitioning") == 2, "deduplication, then region and day"
    assert "BroadcastHashJoin" in plan and plan.count("WindowGroupLimit") == 4


def test_momentum_plan(events_bronze):
    snaps = gold.snapshots(silver_videos(events_bronze))
    stg = staging.stg_view_velocity(gold.view_velocity(snaps))
    plan = plan_of(marts.fct_momentum_videos(stg, group_rows=1))
    assert plan.count("WindowGroupLimit") == 4 and plan.count("Exchange hashpartitioning") == 3


def test_rank_and_share_use_one_shuffle(events_bronze):
    snaps = gold.snapshots(silver_videos(events_bronze))
    stg = staging.stg_channel_stats(gold.channel_stats(snaps))
    plan = plan_of(marts.fct_top_channels(stg, 1))
    assert plan.count("Exchange hashpartitioning") == 3, "deduplication, channels, region and day"
    assert "collect_list" not in plan, "titles are not gathered when they are not read"


def test_stored_leaderboard_prunes_and_pushes_down(spark, run):
    lake, _ = run
    table = daily.read_gold(spark, lake)["daily_trending_rank"]
    plan = plan_of(marts.fct_trending_leaderboard(staging.stg_daily_trending_rank(table)))
    assert "LessThanOrEqual(trending_rank,10)" in plan
    assert "_gold_processed_at" not in plan
