"""Gold: ranks, category and channel statistics, and growth per snapshot (TB2-TB5).

The lists of column names are fixed values: the columns that the tables must have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendmill.functions.measures import days_between, percent_change
from trendmill.operators.aggregates import value_at_max
from trendmill.operators.filters import on_date
from trendmill.operators.ranking import row_number_in_group, top_n
from trendmill.operators.series import with_last_before, with_previous
from trendmill.plans.silver import ENTITY, SNAPSHOT

DAY = ["region", SNAPSHOT]
PROCESSED = "_gold_processed_at"


def snapshots(silver: DataFrame, day: str | None = None) -> DataFrame:
    """Silver rows with the date they were seen; optionally of one day only (D14)."""
    return on_date(silver.withColumn(SNAPSHOT, F.to_date("ingested_at")), SNAPSHOT, day)


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn(PROCESSED, F.current_timestamp())


def daily_trending_rank(
    snaps: DataFrame, group_rows: int | None = None, top: int | None = None, **scale: int
) -> DataFrame:
    """TB2: rank by views per region and day; equal views rank by video id.

    With ``top`` only the best rows are ranked, which Spark limits before the shuffle.
    """
    columns = [
        "video_id", "title", "channel_id", "channel_title", "category_id", "region", SNAPSHOT,
        "view_count", "like_count", "comment_count", "engagement_rate", "like_to_view_ratio",
        "duration_seconds", "tags_count", "published_date",
    ]
    order = [F.desc("view_count"), F.asc("video_id")]
    wanted = snaps.select(*columns)
    if top is not None:
        ranked = top_n(wanted, DAY, order, top, "trending_rank")
    else:
        ranked = row_number_in_group(wanted, DAY, order, "trending_rank", group_rows, **scale)
    return _stamped(ranked)


def category_stats(snaps: DataFrame) -> DataFrame:
    """TB3, AG1, AG8: measures per category, region and day, with the most viewed video (D4)."""
    return _stamped(
        snaps.groupBy("category_id", *DAY).agg(
            F.count("video_id").alias("video_count"),
            F.try_sum("view_count").alias("total_views"),
            F.try_sum("like_count").alias("total_likes"),
            F.try_sum("comment_count").alias("total_comments"),
            F.avg("view_count").alias("avg_view_count"),
            F.avg("like_count").alias("avg_like_count"),
            F.avg("comment_count").alias("avg_comment_count"),
            F.avg("engagement_rate").alias("avg_engagement_rate"),
            F.avg("duration_seconds").alias("avg_duration_seconds"),
            F.max("view_count").alias("max_view_count"),
            F.min("view_count").alias("min_view_count"),
            value_at_max("title", "view_count", "video_id").alias("top_video_title"),
            value_at_max("video_id", "view_count", "video_id").alias("top_video_id"),
        )
    )


CHANNEL_DAY = ["channel_id", "channel_title", *DAY]


def channel_stats(snaps: DataFrame) -> DataFrame:
    """TB4, AG2, AG4: measures per channel, region and day, with all titles in order (D5).

    A reader that leaves the titles out does not compute them. The array is as long as the channel
    has videos on that day; :func:`channel_titles` has the same titles as rows, for channels whose
    array would be unwieldy.
    """
    return _stamped(
        snaps.groupBy(*CHANNEL_DAY).agg(
            F.count("video_id").alias("trending_video_count"),
            F.try_sum("view_count").alias("total_views"),
            F.try_sum("like_count").alias("total_likes"),
            F.try_sum("comment_count").alias("total_comments"),
            F.avg("view_count").alias("avg_view_count"),
            F.avg("engagement_rate").alias("avg_engagement_rate"),
            F.max("view_count").alias("max_video_views"),
            F.sort_array(F.collect_list("title")).alias("trending_video_titles"),
        )
    )


def channel_titles(snaps: DataFrame) -> DataFrame:
    """The titles of :func:`channel_stats`, one per row."""
    return snaps.filter(F.col("title").isNotNull()).select(*CHANNEL_DAY, "title")


LAGS = {"view_count": "_previous_views", SNAPSHOT: "_previous_date"}
VELOCITY_COLUMNS = [
    "video_id", "title", "channel_id", "channel_title", "category_id", "region", SNAPSHOT,
    "view_count", "like_count", "comment_count", "engagement_rate",
]


def _velocity(with_lags: DataFrame) -> DataFrame:
    views, previous = F.col("view_count"), F.col(LAGS["view_count"])
    return _stamped(
        with_lags.withColumns(
            {
                "view_count_delta": F.try_subtract(views, previous),
                "velocity_pct": percent_change(views, previous),
                "days_since_prev_snapshot": days_between(F.col(LAGS[SNAPSHOT]), F.col(SNAPSHOT)),
            }
        ).drop(*LAGS.values())
    )


def view_velocity(snaps: DataFrame) -> DataFrame:
    """TB5: change of views since the previous snapshot of the same video and region.

    A series has one row per day, so its length is bounded by the days of history. A row without a
    date comes first, as Spark sorts it.
    """
    return _velocity(with_previous(snaps.select(*VELOCITY_COLUMNS), ENTITY, [F.asc(SNAPSHOT)], LAGS))


def is_on(days: list[str]) -> Column:
    """Whether a row is of one of the days, as literals that prune partitions."""
    return F.col(SNAPSHOT).isin([F.lit(day).cast("date") for day in days])


def velocity_of_days(snaps: DataFrame, days: list[str]) -> DataFrame:
    """The rows of :func:`view_velocity` for some days: only series with a row on them are sorted."""
    wanted = snaps.filter(is_on(days)).select(*ENTITY).distinct()
    series = snaps.select(*VELOCITY_COLUMNS).join(wanted, ENTITY, "left_semi")
    return view_velocity(series).filter(is_on(days))


def view_velocity_on(snaps: DataFrame, day: str) -> DataFrame:
    """The rows of :func:`view_velocity` for one day, without sorting the history."""
    current = on_date(snaps, SNAPSHOT, day).select(*VELOCITY_COLUMNS)
    date = F.col(SNAPSHOT)
    earlier = snaps.filter(date.isNull() | (date < F.lit(day).cast("date")))
    order = F.coalesce(date, F.lit("0001-01-01").cast("date"))
    return _velocity(with_last_before(current, earlier, ENTITY, order, LAGS))
