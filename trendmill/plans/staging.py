"""Staging: gold with names and labels added and missing measures set to zero (TB6-TB9).

The lists of column names are fixed values: the columns that the tables must have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmill.functions.measures import label_by_threshold, null_to_zero
from trendmill.operators.lookup import literal_dimension, lookup
from trendmill.schemas import CATEGORY_NAMES

# Lower bounds of growth in percent.
MOMENTUM_BANDS = [(20, "accelerating"), (0, "growing")]


def _zeroed(df: DataFrame, longs: list[str], doubles: list[str]) -> DataFrame:
    zeroed = {name: null_to_zero(F.col(name), "bigint") for name in longs}
    zeroed |= {name: null_to_zero(F.col(name), "double") for name in doubles}
    return df.withColumns(zeroed)


def with_category_name(df: DataFrame) -> DataFrame:
    """Unknown ids are named after themselves; a NULL id has no name (FN13)."""
    unknown = F.concat(F.lit("Unknown ("), F.col("category_id").cast("string"), F.lit(")"))
    dimension = literal_dimension(df.sparkSession, CATEGORY_NAMES, "category_id", "category_name")
    return lookup(df, dimension, "category_id", "category_name", unknown)


def stg_daily_trending_rank(gold: DataFrame) -> DataFrame:
    """TB6."""
    named = with_category_name(gold)
    counts = ["view_count", "like_count", "comment_count"]
    return _zeroed(named, counts, ["engagement_rate", "like_to_view_ratio"]).select(
        "video_id", "title", "channel_id", "channel_title", "category_id", "category_name",
        "region", "snapshot_date", "trending_rank", *counts, "engagement_rate",
        "like_to_view_ratio", "duration_seconds", "tags_count", "published_date",
        "_gold_processed_at",
    )


def stg_category_stats(gold: DataFrame) -> DataFrame:
    """TB7."""
    longs = ["video_count", "total_views", "total_likes", "total_comments"]
    averages = [
        "avg_view_count", "avg_like_count", "avg_comment_count", "avg_engagement_rate",
        "avg_duration_seconds",
    ]
    extremes = ["max_view_count", "min_view_count"]
    return _zeroed(with_category_name(gold), longs + extremes, averages).select(
        "category_id", "category_name", "region", "snapshot_date", *longs, *averages, *extremes,
        "top_video_title", "top_video_id", "_gold_processed_at",
    )


def stg_channel_stats(gold: DataFrame) -> DataFrame:
    """TB8."""
    longs = ["trending_video_count", "total_views", "total_likes", "total_comments"]
    averages = ["avg_view_count", "avg_engagement_rate"]
    return _zeroed(gold, [*longs, "max_video_views"], averages).select(
        "channel_id", "channel_title", "region", "snapshot_date", *longs, *averages,
        "max_video_views", "trending_video_titles", "_gold_processed_at",
    )


def stg_view_velocity(gold: DataFrame) -> DataFrame:
    """TB9."""
    counts = ["view_count", "like_count", "comment_count"]
    label = label_by_threshold(F.col("velocity_pct"), MOMENTUM_BANDS, (0, "flat"), "declining")
    return (
        _zeroed(gold, counts, ["engagement_rate"])
        .withColumn("momentum_label", label)
        .select(
            "video_id", "title", "channel_id", "channel_title", "category_id", "region",
            "snapshot_date", *counts, "engagement_rate", "view_count_delta", "velocity_pct",
            "days_since_prev_snapshot", "momentum_label", "_gold_processed_at",
        )
    )


STAGING = {
    "stg_daily_trending_rank": ("daily_trending_rank", stg_daily_trending_rank),
    "stg_category_stats": ("category_stats", stg_category_stats),
    "stg_channel_stats": ("channel_stats", stg_channel_stats),
    "stg_view_velocity": ("view_velocity", stg_view_velocity),
}
