"""Silver: cleaned, typed records, one per key (TB1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendmill.functions.measures import array_size, safe_ratio
from trendmill.functions.parsing import duration_seconds, to_int, to_timestamp
from trendmill.operators.filters import drop_null_keys, partition_safe
from trendmill.operators.ranking import latest_per_key
from trendmill.schemas import BRONZE_COLUMNS, SILVER_PARTITIONS

ENTITY = ["video_id", "region"]
SNAPSHOT = "snapshot_date"

# One row per video and region, or a history with one row per day as well (D1).
GRAINS = {"latest": ENTITY, "day": [*ENTITY, SNAPSHOT]}


def newest(records: DataFrame, grain: str, *then: Column) -> DataFrame:
    """The latest record per key. Equal times are decided by the other columns in their order.

    So only records that are equal throughout tie (``then`` decides between these), and the choice
    neither depends on the order of arrival nor on the steps in which it is made.
    """
    rest = [F.desc(name) for name in BRONZE_COLUMNS if name != "ingested_at"]
    return latest_per_key(records, GRAINS[grain], [F.desc("ingested_at"), *rest, *then])


def timed_records(bronze: DataFrame) -> DataFrame:
    """Records with keys, with the day they were seen, still as text but for ``ingested_at``."""
    seen = to_timestamp(F.col("ingested_at"))
    return drop_null_keys(bronze, ENTITY).withColumns({"ingested_at": seen, SNAPSHOT: F.to_date(seen)})


def latest_records(bronze: DataFrame, grain: str = "day") -> DataFrame:
    """The latest of the timed records per key of the grain.

    Runs before the other columns are parsed, so only survivors pay for that.
    """
    return newest(timed_records(bronze), grain)


def typed(records: DataFrame) -> DataFrame:
    """Parse and derive the silver columns in one projection."""
    views, likes, comments = F.col("view_count"), F.col("like_count"), F.col("comment_count")
    published = to_timestamp(F.col("published_at"))
    return records.select(
        "video_id",
        "channel_id",
        "region",
        "title",
        "description",
        "channel_title",
        to_int(F.col("category_id")).alias("category_id"),
        "tags",
        "default_language",
        published.alias("published_at"),
        "ingested_at",
        "view_count",
        "like_count",
        "comment_count",
        "source",
        duration_seconds(F.col("duration")).alias("duration_seconds"),
        array_size(F.col("tags")).alias("tags_count"),
        safe_ratio(F.try_add(likes, comments), views).alias("engagement_rate"),
        safe_ratio(likes, views).alias("like_to_view_ratio"),
        F.year(published).alias("published_year"),
        F.month(published).alias("published_month"),
        F.to_date(published).alias("published_date"),
        F.current_timestamp().alias("_silver_processed_at"),
        F.col("pipeline_version").alias("_pipeline_version"),
    )


def silver_videos(bronze: DataFrame, grain: str = "day") -> DataFrame:
    """TB1. A key whose latest record cannot be placed in a partition has no row at all."""
    return partition_safe(typed(latest_records(bronze, grain)), SILVER_PARTITIONS)
