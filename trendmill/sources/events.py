"""Bronze-shaped records derived from the ``events`` test table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendmill.schemas import PIPELINE_VERSION, SOURCE

ITEMS_PER_PAGE = 50


def _every(n: int):
    return F.col("event_id") % n == 0


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _tags() -> Column:
    """None to four tags that differ from each other and from row to row, not in order."""
    return F.expr(
        "transform(filter(sequence(0, 3), i -> i < event_id % 5), i -> concat('tag ', (event_id * 7 + i * 4) % 11))"
    )


def bronze_from_events(events: DataFrame, *extra: str) -> DataFrame:
    """Records with every flaw the engine must handle: NULL keys, bad text, zero and NULL counts.

    ``extra`` names columns of ``events`` to carry along.
    """
    user, event = F.col("user_id"), F.col("event_id")
    region = (
        F.when(F.col("event_type") == "click", "US")
        .when(F.col("event_type") == "view", "GB")
        .when(F.col("event_type") == "purchase", "IN")
        .when(F.col("event_type") == "signup", "CA")
        .otherwise("")
    )
    duration = (
        F.when(_every(13), F.lit(None).cast("string"))
        .when(_every(17), "P1DT2H")
        .when(_every(19), "P0D")
        .otherwise(F.concat(F.lit("PT"), event % 3, F.lit("H"), event % 60, F.lit("M")))
    )
    published = F.date_format(F.date_sub(F.to_date("ts"), (user % 10).cast("int")), "yyyy-MM-dd")
    return events.select(
        F.when(~_every(211), F.concat(F.lit("v"), user)).alias("video_id"),
        F.concat(F.lit("c"), user % 40).alias("channel_id"),
        region.alias("region"),
        F.concat(F.lit("title "), user).alias("title"),
        F.concat(F.lit("description "), event).alias("description"),
        F.concat(F.lit("channel "), user % 40).alias("channel_title"),
        F.when(_every(503), "n/a").otherwise((user % 31).cast("string")).alias("category_id"),
        F.when(~_every(7), _tags()).alias("tags"),
        duration.alias("duration"),
        F.lit("en").alias("default_language"),
        F.when(_every(97), "bad").otherwise(F.concat(published, F.lit("T00:00:00Z"))).alias("published_at"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ingested_at"),
        F.when(_every(101), F.lit(0)).otherwise(F.round(F.col("value") * 100)).cast("bigint").alias("view_count"),
        F.when(~_every(89), F.get_json_object("props", "$.k").try_cast("bigint")).alias("like_count"),
        (event % 50).alias("comment_count"),
        F.lit(SOURCE).alias("source"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
        *extra,
    )


def payloads_from_events(events: DataFrame) -> DataFrame:
    """The same records as answers of the provider: one JSON text per (region, page).

    A page covers 50 consecutive event ids, so no answer holds more than 50 items. Some counts are
    empty or malformed, some descriptions missing or long, and every 37th page is cut short.
    """
    views, likes, comments = [F.col(f"{c}_count").cast("string") for c in ("view", "like", "comment")]
    statistics = F.struct(
        views.alias("viewCount"),
        F.when(_every(71), "").otherwise(likes).alias("likeCount"),
        F.when(_every(73), "many").otherwise(comments).alias("commentCount"),
    )
    snippet = F.struct(
        F.col("channel_id").alias("channelId"),
        "title",
        F.when(~_every(11), F.repeat("description", 40)).alias("description"),
        F.col("channel_title").alias("channelTitle"),
        F.col("category_id").alias("categoryId"),
        F.col("default_language").alias("defaultLanguage"),
        F.col("published_at").alias("publishedAt"),
        "tags",
    )
    item = F.struct(
        F.concat(F.lit("e"), F.col("event_id")).alias("id"),
        snippet.alias("snippet"),
        statistics.alias("statistics"),
        F.struct("duration").alias("contentDetails"),
    )
    page = F.floor(F.col("event_id") / ITEMS_PER_PAGE)
    answers = (
        bronze_from_events(events, "event_id")
        .groupBy("region", page.alias("page"))
        .agg(
            F.max("ingested_at").alias("ingested_at"),
            F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("payload"),
        )
    )
    cut = F.when(F.col("page") % 37 == 0, F.substring("payload", 1, 40)).otherwise(F.col("payload"))
    return answers.select("region", "ingested_at", cut.alias("payload"))
