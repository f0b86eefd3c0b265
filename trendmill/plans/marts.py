"""Marts: the reporting tables (TB10-TB13).

Rows come unordered; ``REPORT_ORDER`` gives the order of each report. Writers sort files by it, and
:func:`in_report_order` sorts a result for reading.

The lists of column names are fixed values: the columns that the tables must have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmill.functions.measures import days_between, percent, share
from trendmill.operators.aggregates import join_totals, share_of_total, window_totals
from trendmill.operators.ranking import ntile_in_group, rank_in_group, top_n_with_ties
from trendmill.operators.scale import MAX_GROUP_ROWS, group_bound
from trendmill.plans.gold import DAY

# Sizes of the reports.
LEADERBOARD_SIZE = 10
MOMENTUM_SIZE = 20
ENGAGEMENT_BUCKETS = 5

REPORT_ORDER = {
    "fct_trending_leaderboard": [*DAY, "trending_rank"],
    "fct_top_channels": [*DAY, "channel_rank"],
    "fct_category_performance": [*DAY, "category_rank_in_region"],
    "fct_momentum_videos": [*DAY, "velocity_rank"],
}


def in_report_order(df: DataFrame, name: str) -> DataFrame:
    """SO1."""
    return df.orderBy(*REPORT_ORDER[name])


def fct_trending_leaderboard(stg: DataFrame) -> DataFrame:
    """TB10: the ten most viewed per region and day, in engagement quintiles.

    The quintiles are cut among those ten; equal engagement goes by rank (D3).
    """
    best = stg.filter(F.col("trending_rank") <= LEADERBOARD_SIZE)
    aged = best.withColumn("days_to_trend", days_between(F.col("published_date"), F.col("snapshot_date")))
    order = [F.desc("engagement_rate"), F.asc("trending_rank")]
    return ntile_in_group(aged, DAY, order, ENGAGEMENT_BUCKETS, "engagement_quintile").select(
        "video_id", "title", "channel_id", "channel_title", "category_id", "category_name",
        "region", "snapshot_date", "trending_rank", "view_count", "like_count", "comment_count",
        "engagement_rate", "like_to_view_ratio", "duration_seconds", "tags_count",
        "published_date", "days_to_trend", "engagement_quintile",
    )


def fct_top_channels(
    stg: DataFrame, group_rows: int | None = None, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """TB11: channels ranked by views, with their share of the region's day (D8)."""
    slim = stg.drop("trending_video_titles", "_gold_processed_at")
    bound = group_bound(slim, DAY, group_rows, max_group_rows)
    ranked = rank_in_group(slim, DAY, "total_views", "channel_rank", bound, max_group_rows)
    shared = share_of_total(ranked, DAY, "total_views", "view_share", bound, max_group_rows, slim)
    return shared.select(
        "channel_id", "channel_title", "region", "snapshot_date", "channel_rank",
        "trending_video_count", "total_views", "total_likes", "total_comments",
        F.round("avg_view_count", 0).alias("avg_view_count"),
        percent(F.col("avg_engagement_rate"), 4).alias("avg_engagement_rate_pct"),
        "max_video_views",
        percent(F.col("view_share"), 2).alias("view_share_pct"),
    )


def category_totals() -> dict:
    """AG5: totals of a category over all regions; the average is one of regional averages (D7)."""
    return {
        "global_video_count": F.sum("video_count"),
        "global_total_views": F.try_sum("total_views"),
        "global_avg_engagement": F.avg("avg_engagement_rate"),
    }


def with_category_totals(stg: DataFrame, by_join: bool = False) -> DataFrame:
    """Totals per category and day on each row; rows without a category drop out.

    A (category, day) has one row per region, so the window form is safe and reads once. The join
    form gives the same rows.
    """
    attach = join_totals if by_join else window_totals
    return attach(stg, ["category_id", "snapshot_date"], category_totals())


def fct_category_performance(
    stg: DataFrame, group_rows: int | None = None, by_join: bool = False, **scale: int
) -> DataFrame:
    """TB12: categories ranked by views in their region, against their totals over all regions."""
    totals = with_category_totals(stg, by_join)
    ranked = rank_in_group(totals, DAY, "total_views", "category_rank_in_region", group_rows, **scale)
    return ranked.select(
        "category_id", "category_name", "region", "snapshot_date", "category_rank_in_region",
        "video_count", "total_views", "total_likes", "total_comments",
        F.round("avg_view_count", 0).alias("avg_view_count"),
        percent(F.col("avg_engagement_rate"), 4).alias("avg_engagement_rate_pct"),
        F.round(F.col("avg_duration_seconds") / 60.0, 1).alias("avg_duration_minutes"),
        "max_view_count", "top_video_title", "top_video_id", "global_video_count",
        "global_total_views",
        percent(F.col("global_avg_engagement"), 4).alias("global_avg_engagement_pct"),
        percent(share(F.col("total_views"), F.col("global_total_views")), 2).alias(
            "region_view_share_pct"
        ),
    )


def fct_momentum_videos(stg: DataFrame, group_rows: int | None = None, **scale: int) -> DataFrame:
    """TB13: the twenty fastest risers per region and day; ties on the last rank all stay."""
    moving = stg.filter(F.col("velocity_pct").isNotNull())
    risers = top_n_with_ties(
        moving, DAY, "velocity_pct", MOMENTUM_SIZE, "velocity_rank", group_rows, **scale
    )
    return risers.select(
        "video_id", "title", "channel_id", "channel_title", "category_id", "region",
        "snapshot_date", "velocity_rank", "view_count", "view_count_delta",
        F.round("velocity_pct", 2).alias("velocity_pct"),
        "days_since_prev_snapshot", "momentum_label", "like_count", "comment_count",
        percent(F.col("engagement_rate"), 4).alias("engagement_rate_pct"),
    )
