"""Table schemas (DDL) and fixed values of the data model."""

from __future__ import annotations

# What the feed delivers and the checks accept.
REGIONS = ["US", "GB", "IN", "CA"]
SOURCE = "youtube_trending"
PIPELINE_VERSION = "1.0"
DESCRIPTION_LENGTH = 500

# Category ids and their names.
CATEGORY_NAMES = {
    1: "Film & Animation",
    2: "Autos & Vehicles",
    10: "Music",
    15: "Pets & Animals",
    17: "Sports",
    18: "Short Movies",
    19: "Travel & Events",
    20: "Gaming",
    21: "Videoblogging",
    22: "People & Blogs",
    23: "Comedy",
    24: "Entertainment",
    25: "News & Politics",
    26: "Howto & Style",
    27: "Education",
    28: "Science & Technology",
    29: "Nonprofits & Activism",
}

# Momentum labels, fastest first.
MOMENTUM_LABELS = ["accelerating", "growing", "flat", "declining"]

# One page of the provider's answer. Counts arrive as text.
PAYLOAD = """
    items ARRAY<STRUCT<
        id: STRING,
        snippet: STRUCT<
            channelId: STRING, title: STRING, description: STRING, channelTitle: STRING,
            categoryId: STRING, defaultLanguage: STRING, publishedAt: STRING, tags: ARRAY<STRING>>,
        statistics: STRUCT<viewCount: STRING, likeCount: STRING, commentCount: STRING>,
        contentDetails: STRUCT<duration: STRING>>>
"""

BRONZE = """
    video_id STRING, channel_id STRING, region STRING, title STRING, description STRING,
    channel_title STRING, category_id STRING, tags ARRAY<STRING>, duration STRING,
    default_language STRING, published_at STRING, ingested_at STRING,
    view_count BIGINT, like_count BIGINT, comment_count BIGINT,
    source STRING, pipeline_version STRING
"""
BRONZE_COLUMNS = [field.split()[0] for field in BRONZE.split(",")]

SILVER = """
    video_id STRING, channel_id STRING, region STRING, title STRING, description STRING,
    channel_title STRING, category_id INT, tags ARRAY<STRING>, default_language STRING,
    published_at TIMESTAMP, ingested_at TIMESTAMP,
    view_count BIGINT, like_count BIGINT, comment_count BIGINT, source STRING,
    duration_seconds INT, tags_count INT, engagement_rate DOUBLE, like_to_view_ratio DOUBLE,
    published_year INT, published_month INT, published_date DATE,
    _silver_processed_at TIMESTAMP, _pipeline_version STRING
"""

GOLD = {
    "channel_titles": "channel_id STRING, channel_title STRING, region STRING, snapshot_date DATE, title STRING",
    "daily_trending_rank": """
        video_id STRING, title STRING, channel_id STRING, channel_title STRING, category_id INT,
        region STRING, snapshot_date DATE, view_count BIGINT, like_count BIGINT,
        comment_count BIGINT, engagement_rate DOUBLE, like_to_view_ratio DOUBLE,
        duration_seconds INT, tags_count INT, published_date DATE, trending_rank INT,
        _gold_processed_at TIMESTAMP
    """,
    "category_stats": """
        category_id INT, region STRING, snapshot_date DATE, video_count BIGINT,
        total_views BIGINT, total_likes BIGINT, total_comments BIGINT, avg_view_count DOUBLE,
        avg_like_count DOUBLE, avg_comment_count DOUBLE, avg_engagement_rate DOUBLE,
        avg_duration_seconds DOUBLE, max_view_count BIGINT, min_view_count BIGINT,
        top_video_title STRING, top_video_id STRING, _gold_processed_at TIMESTAMP
    """,
    "channel_stats": """
        channel_id STRING, channel_title STRING, region STRING, snapshot_date DATE,
        trending_video_count BIGINT, total_views BIGINT, total_likes BIGINT,
        total_comments BIGINT, avg_view_count DOUBLE, avg_engagement_rate DOUBLE,
        max_video_views BIGINT, trending_video_titles ARRAY<STRING>, _gold_processed_at TIMESTAMP
    """,
    "view_velocity": """
        video_id STRING, title STRING, channel_id STRING, channel_title STRING, category_id INT,
        region STRING, snapshot_date DATE, view_count BIGINT, like_count BIGINT,
        comment_count BIGINT, engagement_rate DOUBLE, view_count_delta BIGINT,
        velocity_pct DOUBLE, days_since_prev_snapshot INT, _gold_processed_at TIMESTAMP
    """,
}

SILVER_PARTITIONS = ["region", "published_year", "published_month"]
GOLD_PARTITIONS = ["region", "snapshot_date"]
MART_PARTITIONS = ["region"]
