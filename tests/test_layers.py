"""Silver, gold, staging and marts on small literal records."""

import pytest
from pyspark.sql import functions as F

from trendmill.operators.filters import on_date, partition_safe
from trendmill.plans import gold, marts, staging
from trendmill.plans.silver import latest_records, silver_videos
from trendmill.schemas import BRONZE, GOLD, SILVER
from test_quality import GOOD, records


def at(day, hour=0, **more):
    return {"video_id": "v", "ingested_at": f"2026-01-{day:02}T{hour:02}:00:00Z"} | more


def schema_of(spark, ddl):
    return [(f.name, f.dataType.simpleString()) for f in spark.createDataFrame([], ddl).schema.fields]


def test_silver_schema(spark):
    assert silver_videos(records(spark, {})).dtypes == schema_of(spark, SILVER)


def test_null_keys_drop(spark):
    df = records(spark, {"video_id": None}, {"region": None}, {"region": ""}, {})
    assert [r.video_id for r in silver_videos(df).collect()] == ["v3"]


def test_grains(spark):
    df = records(spark, at(1, 1, view_count=1), at(1, 2, view_count=2), at(2, 1, view_count=3))
    assert sorted(r.view_count for r in silver_videos(df, "day").collect()) == [2, 3]
    assert [r.view_count for r in silver_videos(df, "latest").collect()] == [3]


def test_bad_latest_record_hides_older_ones(spark):
    df = records(spark, at(1, 1), at(1, 2, published_at="bad"))
    assert silver_videos(df).isEmpty()


def test_equal_times_resolve_the_same_way_in_any_order(spark):
    rows = [at(1, 1, view_count=n, title=f"t{n}") for n in range(20)]
    one = latest_records(records(spark, *rows)).select("title").first()[0]
    other = latest_records(records(spark, *reversed(rows)).repartition(4)).select("title").first()[0]
    assert one == other


def test_unparsable_times_are_kept_as_null(spark):
    silver = silver_videos(records(spark, {"ingested_at": "bad"}))
    assert silver.first().ingested_at is None
    assert gold.snapshots(silver).first().snapshot_date is None


def test_parsing_in_silver(spark):
    row = silver_videos(
        records(spark, {"category_id": "n/a", "tags": None, "view_count": 0, "duration": "P1DT1H"})
    ).first()
    assert (row.category_id, row.tags_count, row.engagement_rate, row.duration_seconds) == (None, 0, 0.0, 90000)
    assert (row.published_year, row.published_month, str(row.published_date)) == (2026, 1, "2026-01-01")
    assert row._silver_processed_at is not None and row._pipeline_version == "1.0"


def test_partition_safe_checks_text_only_for_emptiness(spark):
    df = spark.createDataFrame([("", 1), ("a", None), ("a", 1), (None, 1)], "s string, i int")
    assert partition_safe(df, ["s", "i"]).count() == 1


def snaps_of(spark, *changes):
    return gold.snapshots(silver_videos(records(spark, *changes)))


def test_gold_schemas(spark):
    snaps = snaps_of(spark, {})
    for name, ddl in GOLD.items():
        seen = dict(getattr(gold, name)(snaps).dtypes)
        assert seen == dict(schema_of(spark, ddl)), name


def test_one_day_only(spark):
    snaps = snaps_of(spark, at(1), at(2))
    assert on_date(snaps, "snapshot_date", "2026-01-02").count() == 1
    assert on_date(snaps, "snapshot_date", None).count() == 2


def test_trending_ranks_are_consecutive(spark):
    snaps = snaps_of(spark, *[{"view_count": n // 2} for n in range(9)])
    ranks = sorted(r.trending_rank for r in gold.daily_trending_rank(snaps).collect())
    assert ranks == list(range(1, 10))
    tied = gold.daily_trending_rank(snaps).orderBy("trending_rank").collect()
    assert [r.video_id for r in tied][:3] == ["v8", "v6", "v7"]


def test_velocity(spark):
    views = {1: 0, 2: 100, 3: 120, 6: 145, 7: 145, 8: 100}
    velocity = gold.view_velocity(snaps_of(spark, *[at(day, view_count=n) for day, n in views.items()]))
    labelled = staging.stg_view_velocity(velocity).orderBy("snapshot_date").collect()
    seen = [(r.view_count_delta, r.days_since_prev_snapshot, r.momentum_label) for r in labelled]
    assert seen == [
        (None, None, None),
        (100, 1, None),
        (20, 1, "growing"),
        (25, 3, "accelerating"),
        (0, 1, "flat"),
        (-45, 1, "declining"),
    ]
    assert labelled[2].velocity_pct == 20.0


@pytest.mark.parametrize("day", range(1, 9))
def test_velocity_of_one_day(spark, day):
    rows = [at(d, view_count=v, video_id=k) for k, v, d in
            [("a", 0, 1), ("a", 5, 2), ("a", None, 4), ("a", 6, 5), ("b", 3, 2), ("b", 4, 5), ("c", 9, 8)]]
    undated = [{"video_id": "b", "ingested_at": "bad", "view_count": 2}]
    snaps = snaps_of(spark, *rows, *undated)
    date = f"2026-01-{day:02}"
    whole = on_date(gold.view_velocity(snaps), "snapshot_date", date).drop(gold.PROCESSED)
    alone = gold.view_velocity_on(snaps, date).drop(gold.PROCESSED)
    assert alone.columns == whole.columns
    assert sorted(map(str, alone.collect())) == sorted(map(str, whole.collect()))


def test_velocity_needs_history(spark):
    df = records(spark, at(1, view_count=10), at(2, view_count=20))
    latest = gold.view_velocity(gold.snapshots(silver_videos(df, "latest")))
    assert [r.velocity_pct for r in latest.collect()] == [None]


def test_category_names(spark):
    df = spark.createDataFrame([(10,), (99,), (None,)], "category_id int")
    seen = {r.category_id: r.category_name for r in staging.with_category_name(df).collect()}
    assert seen == {10: "Music", 99: "Unknown (99)", None: None}


def test_missing_measures_become_zero(spark):
    snaps = snaps_of(spark, {"view_count": None, "like_count": None})
    row = staging.stg_category_stats(gold.category_stats(snaps)).first()
    assert (row.video_count, row.total_views, row.avg_like_count, row.max_view_count) == (1, 0, 0.0, 0)


def test_category_performance_drops_unknown_category(spark):
    snaps = snaps_of(spark, {"category_id": "n/a"}, {"category_id": "10"}, {"category_id": "10", "region": "GB"})
    for by_join in (False, True):
        stg = staging.stg_category_stats(gold.category_stats(snaps))
        rows = marts.fct_category_performance(stg, by_join=by_join).collect()
        assert {(r.category_id, r.region, r.global_video_count) for r in rows} == {(10, "US", 2), (10, "GB", 2)}


def test_totals_average_regional_averages(spark):
    snaps = snaps_of(
        spark,
        {"like_count": 0, "comment_count": 1},
        {"like_count": 0, "comment_count": 1},
        {"region": "GB", "like_count": 1, "comment_count": 1},
    )
    row = marts.fct_category_performance(staging.stg_category_stats(gold.category_stats(snaps))).first()
    assert row.global_avg_engagement_pct == 150.0


def test_top_channels_share(spark):
    snaps = snaps_of(spark, {"view_count": 5}, {"view_count": 4, "channel_id": "other"})
    for limit in (10**9, 1):
        stg = staging.stg_channel_stats(gold.channel_stats(snaps))
        rows = marts.fct_top_channels(stg, max_group_rows=limit).orderBy("channel_rank").collect()
        seen = [(r.channel_id, r.channel_rank, r.view_share_pct) for r in rows]
        assert seen == [("c", 1, 55.56), ("other", 2, 44.44)]


def test_titles_are_complete(spark):
    hot = [{"channel_id": "hot", "title": f"t{n:02}"} for n in range(20)]
    small = [{"channel_id": "b", "title": "y"}, {"channel_id": "b", "title": "x"}, {"channel_id": None}]
    snaps = snaps_of(spark, *hot, *small)
    whole = {r.channel_id: r for r in gold.channel_stats(snaps).collect()}
    assert whole["hot"].trending_video_titles == sorted(h["title"] for h in hot)
    assert whole["hot"].trending_video_count == 20
    assert whole["b"].trending_video_titles == ["x", "y"] and whole[None].trending_video_titles == ["t"]
    rows = gold.channel_titles(snaps).collect()
    assert len(rows) == 23
    for channel, row in whole.items():
        assert sorted(r.title for r in rows if r.channel_id == channel) == row.trending_video_titles


def test_leaderboard(spark):
    snaps = snaps_of(spark, *[{"view_count": 100 - n, "like_count": n} for n in range(12)])
    stg = staging.stg_daily_trending_rank(gold.daily_trending_rank(snaps))
    rows = marts.in_report_order(marts.fct_trending_leaderboard(stg), "fct_trending_leaderboard").collect()
    assert [r.trending_rank for r in rows] == list(range(1, 11))
    assert [r.engagement_quintile for r in rows] == [5, 5, 4, 4, 3, 3, 2, 2, 1, 1]
    assert {r.days_to_trend for r in rows} == {1}


@pytest.mark.parametrize("column", ["title", "video_id"])
def test_top_video_has_most_views(spark, column):
    snaps = snaps_of(spark, {"view_count": 1}, {"view_count": 9, "title": None}, {"view_count": 5, "title": "best"})
    row = gold.category_stats(snaps).first()
    assert (row.top_video_title, row.top_video_id) == ("best", "v1")


def test_bronze_fixture_has_the_declared_columns(spark):
    assert list(GOOD) == [f.name for f in spark.createDataFrame([], BRONZE).schema.fields]


def test_processing_time_is_one_per_query(spark):
    snaps = snaps_of(spark, {}, {})
    assert gold.daily_trending_rank(snaps).agg(F.count_distinct("_gold_processed_at")).first()[0] == 1
