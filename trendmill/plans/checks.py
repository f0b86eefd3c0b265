"""The declared checks of every layer, and the validation report (TB14)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendmill.functions.measures import percent, safe_ratio
from trendmill.operators.quality import (
    SUMMARY,
    Expectation,
    ExpectationsFailed,
    expect_at_least,
    expect_in_set,
    expect_match,
    expect_not_null,
    expect_rows,
    expect_unique,
    summarize,
    validate,
)
from trendmill.schemas import MOMENTUM_LABELS, REGIONS, SOURCE

# Formats of raw text. Durations here have no days, unlike those silver can read (D10).
PUBLISHED_FORMAT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
INGESTED_FORMAT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
DURATION_FORMAT = r"^PT(\d+H)?(\d+M)?(\d+S)?$"
MOSTLY = 0.95
KEY_SEPARATOR = "::"

# Columns that must not be NULL, per table.
GOLD_NOT_NULL = {
    "daily_trending_rank": ["video_id", "trending_rank", "region", "snapshot_date"],
    "category_stats": ["category_id", "region", "snapshot_date"],
    "channel_stats": ["channel_id", "region", "snapshot_date"],
    "view_velocity": ["video_id", "region", "snapshot_date"],
}
STAGING_NOT_NULL = {f"stg_{table}": columns for table, columns in GOLD_NOT_NULL.items()}
MART_NOT_NULL = {
    "fct_trending_leaderboard": ["video_id", "region", "snapshot_date", "trending_rank", "engagement_quintile"],
    "fct_top_channels": ["channel_id", "region", "snapshot_date", "channel_rank"],
    "fct_category_performance": ["category_id", "region", "snapshot_date"],
    "fct_momentum_videos": ["video_id", "region", "snapshot_date", "velocity_rank", "momentum_label"],
}
NOT_NULL = GOLD_NOT_NULL | STAGING_NOT_NULL | MART_NOT_NULL

# Accepted values, per table and column.
ACCEPTED = {
    ("stg_daily_trending_rank", "region"): REGIONS,
    ("stg_view_velocity", "momentum_label"): MOMENTUM_LABELS,
    ("fct_trending_leaderboard", "engagement_quintile"): [1, 2, 3, 4, 5],
    ("fct_momentum_videos", "momentum_label"): MOMENTUM_LABELS,
}


def video_region_key():
    """FN12: the key as one text; a NULL part is skipped."""
    return F.concat_ws(KEY_SEPARATOR, "video_id", "region")


def bronze_expectations() -> list[Expectation]:
    """DQ1-15 in report order."""
    required = ["video_id", "region", "ingested_at", "view_count", "channel_id"]
    counts = ["view_count", "like_count", "comment_count"]
    return [
        *[expect_not_null(f"{column}_not_null", column) for column in required],
        expect_in_set("region_in_expected_set", "region", REGIONS),
        *[expect_at_least(f"{column}_non_negative", column, 0) for column in counts],
        expect_in_set(f"source_is_{SOURCE}", "source", [SOURCE]),
        expect_match("published_at_iso8601_format", "published_at", PUBLISHED_FORMAT, MOSTLY),
        expect_match("ingested_at_iso8601_format", "ingested_at", INGESTED_FORMAT, MOSTLY),
        expect_match("duration_iso8601_format", "duration", DURATION_FORMAT, MOSTLY),
        expect_unique("video_region_key_mostly_unique", video_region_key(), MOSTLY, critical=False),
        expect_rows("dataset_not_empty", 1),
    ]


def validate_bronze(bronze: DataFrame) -> DataFrame:
    return validate(bronze, bronze_expectations())


def fixed_results(results: DataFrame) -> DataFrame:
    """The few result rows as a literal table, so that later readers do not validate again."""
    return results.sparkSession.createDataFrame(results.collect(), results.schema)


def run_timestamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def report_document(results: DataFrame, source_path: str, stamp: str) -> DataFrame:
    """FN26, SC7: the report as one row with one JSON text; the results keep their order."""
    checked = F.col("element_count") - F.col("missing_count")
    detail = F.struct(
        "element_count",
        "missing_count",
        "unexpected_count",
        percent(safe_ratio(F.col("missing_count"), F.col("element_count")), 4).alias("missing_percent"),
        percent(safe_ratio(F.col("unexpected_count"), checked), 4).alias("unexpected_percent"),
    )
    entry = F.struct("expectation", "critical", "success", detail.alias("result"))
    document = F.struct(
        F.lit(stamp).alias("run_timestamp"),
        F.lit(source_path).alias("bronze_path"),
        *SUMMARY,
        "results",
    )
    totals = summarize(results, F.collect_list(entry).alias("results"))
    return totals.select(F.to_json(document, {"pretty": "true"}).alias("content"))


def write_report(document: DataFrame, path: str) -> None:
    """SK5: one text file; the document is a single row."""
    document.coalesce(1).write.mode("overwrite").text(path)


def gate(results: DataFrame, fail_on_error: bool = True) -> list[str]:
    """DQ17: raise if a critical check failed; else return the names of the warnings."""
    failed = results.filter(~F.col("success")).select("expectation", "critical").collect()
    critical = [row.expectation for row in failed if row.critical]
    if critical and fail_on_error:
        raise ExpectationsFailed(f"{len(critical)} critical expectation(s) not met: {', '.join(critical)}")
    return [row.expectation for row in failed if not row.critical]


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)
