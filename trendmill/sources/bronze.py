"""Raw records: JSON-lines scans, and flattening of the provider's nested answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendmill.functions.parsing import array_or_empty, count_text_to_long, is_bad_count, truncated
from trendmill.schemas import BRONZE, DESCRIPTION_LENGTH, PAYLOAD, PIPELINE_VERSION, SOURCE

COUNTS = ["viewCount", "likeCount", "commentCount"]


class EmptyInput(Exception):
    """A layer has no input rows."""


def landing_glob(prefix: str) -> str:
    """SC2: files below ``prefix/month/day/hour/``."""
    return f"{prefix.rstrip('/')}/*/*/*/*"


def read_bronze(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SC1, SE1: one JSON object per line with the declared schema; no inference pass.

    A line that is no JSON becomes an all-NULL row, a field of the wrong type becomes NULL.
    """
    return spark.read.schema(BRONZE).option("multiLine", False).json(path)


def require_input(df: DataFrame, layer: str) -> DataFrame:
    """SC8: raise if there is nothing to read. Looks for one row only."""
    if df.isEmpty():
        raise EmptyInput(f"{layer}: no input rows")
    return df


def decode_payload(payloads: DataFrame, text: str = "payload") -> DataFrame:
    """Parse the answer text of each (region, ingested_at); ``readable`` is false if it is no JSON."""
    schema = f"{PAYLOAD.rstrip()}, _corrupt STRING"
    parsed = F.from_json(F.col(text), schema, {"columnNameOfCorruptRecord": "_corrupt"})
    decoded = payloads.withColumn("_parsed", parsed)
    readable = F.col("_parsed").isNotNull() & F.col("_parsed._corrupt").isNull()
    return (
        decoded.withColumn("readable", readable)
        .withColumn("items", F.when(readable, F.col("_parsed.items")))
        .drop("_parsed", text)
    )


def flatten_payload(decoded: DataFrame) -> DataFrame:
    """SC6, FN21-24, PR7: one bronze record per item of every readable answer.

    The outer explode keeps Spark from inferring a filter on the array, which it would push below
    the parsing and so parse every answer again.
    """
    item = F.col("item")
    snippet, statistics = item["snippet"], item["statistics"]
    views, likes, comments = [count_text_to_long(statistics[name]) for name in COUNTS]
    items = decoded.withColumn("item", F.explode_outer("items")).filter(item.isNotNull())
    return items.select(
        item["id"].alias("video_id"),
        snippet["channelId"].alias("channel_id"),
        "region",
        snippet["title"].alias("title"),
        truncated(snippet["description"], DESCRIPTION_LENGTH).alias("description"),
        snippet["channelTitle"].alias("channel_title"),
        snippet["categoryId"].alias("category_id"),
        array_or_empty(snippet["tags"]).alias("tags"),
        item["contentDetails"]["duration"].alias("duration"),
        snippet["defaultLanguage"].alias("default_language"),
        snippet["publishedAt"].alias("published_at"),
        "ingested_at",
        views.alias("view_count"),
        likes.alias("like_count"),
        comments.alias("comment_count"),
        F.lit(SOURCE).alias("source"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
    )


def ingest_summary(decoded: DataFrame) -> DataFrame:
    """AG11, SE1, D11: per region the records, unreadable answers and malformed items.

    A region with any of the latter two is PARTIAL. ``decoded`` is read once; every answer is
    counted from its own array, before the shuffle.
    """

    def malformed(item):
        bad = item["id"].isNull()
        for name in COUNTS:
            bad = bad | is_bad_count(item["statistics"][name])
        return F.coalesce(bad, F.lit(False))

    records = F.coalesce(F.size("items"), F.lit(0))
    bad_items = F.coalesce(F.size(F.filter("items", malformed)), F.lit(0))
    return (
        decoded.select("region", "readable", records.alias("n"), bad_items.alias("bad"))
        .groupBy("region")
        .agg(
            F.sum(F.greatest("n", F.lit(0))).alias("records"),
            F.count_if(~F.col("readable")).alias("unreadable_payloads"),
            F.sum(F.greatest("bad", F.lit(0))).alias("malformed_items"),
        )
        .withColumn(
            "status",
            F.when((F.col("unreadable_payloads") > 0) | (F.col("malformed_items") > 0), "PARTIAL").otherwise(
                "SUCCESS"
            ),
        )
    )


def ingest_total(summary: DataFrame) -> DataFrame:
    """SE1: all regions in one row: status, records, and the regions that are not a success, in order."""
    failed = F.array_sort(F.collect_list(F.when(F.col("status") != "SUCCESS", F.col("region"))))
    totals = summary.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"), F.array_join(failed, ",").alias("failed_regions"))
    return totals.withColumn("status", F.when(F.col("failed_regions") == "", "SUCCESS").otherwise("PARTIAL"))


def land(records: DataFrame, path: str, mode: str = "append", rows_per_file: int = 0) -> None:
    """SK6, FN26: write records as JSON lines; ``rows_per_file`` limits the files, 0 does not."""
    records.write.mode(mode).option("maxRecordsPerFile", rows_per_file).json(path)
