"""Answers of the provider as VARIANT values: fields that are new, missing or of another type keep their rows.

The fixed struct of ``sources.bronze`` reads an answer only as far as it has the declared types; here each
field is taken on its own by its path, so that one retyped field is lost (or converted) alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendmill.functions.parsing import array_or_empty, count_text_to_long, truncated
from trendmill.schemas import DESCRIPTION_LENGTH, PIPELINE_VERSION, SOURCE


def decode_variant(payloads: DataFrame, text: str = "payload") -> DataFrame:
    """Each answer with its ``items`` as VARIANT values; ``readable`` is false if it is no JSON."""
    answer = payloads.withColumn("_answer", F.try_parse_json(F.col(text)))
    return answer.select(
        *[F.col(name) for name in payloads.columns if name != text],
        F.col("_answer").isNotNull().alias("readable"),
        F.try_variant_get("_answer", "$.items", "array<variant>").alias("items"),
    )


def _text(path: str) -> Column:
    return F.try_variant_get("item", f"$.{path}", "string")


def items_of(decoded: DataFrame, *keep: str) -> DataFrame:
    """One row per item, a VARIANT, with the columns ``keep`` of its answer."""
    items = decoded.select(*keep, F.explode("items").alias("item"))
    return items.filter(~F.is_variant_null("item"))


def flatten_variant(decoded: DataFrame) -> DataFrame:
    """SC6, FN21-24, PR7: one bronze record per item. A count may be text or a number; tags that are no list count as none."""
    views, likes, comments = [count_text_to_long(_text(f"statistics.{name}")) for name in ("viewCount", "likeCount", "commentCount")]
    return items_of(decoded, "region", "ingested_at").select(
        _text("id").alias("video_id"),
        _text("snippet.channelId").alias("channel_id"),
        "region",
        _text("snippet.title").alias("title"),
        truncated(_text("snippet.description"), DESCRIPTION_LENGTH).alias("description"),
        _text("snippet.channelTitle").alias("channel_title"),
        _text("snippet.categoryId").alias("category_id"),
        array_or_empty(F.try_variant_get("item", "$.snippet.tags", "array<string>")).alias("tags"),
        _text("contentDetails.duration").alias("duration"),
        _text("snippet.defaultLanguage").alias("default_language"),
        _text("snippet.publishedAt").alias("published_at"),
        "ingested_at",
        views.alias("view_count"),
        likes.alias("like_count"),
        comments.alias("comment_count"),
        F.lit(SOURCE).alias("source"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
    )


def item_schemas(decoded: DataFrame) -> DataFrame:
    """The schema that all items of a region have together, as text: where it differs from the declared one, the feed has drifted."""
    return items_of(decoded, "region").groupBy("region").agg(F.schema_of_variant_agg("item").alias("item_schema"))
