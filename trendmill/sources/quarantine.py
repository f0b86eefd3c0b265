"""Lines of landed files that are no record, or not wholly: set aside with their file and text, counted, and replayed.

Reading JSON lines alone turns a line that is no JSON into an empty record, which the key filter then drops, and
a field of another type into NULL. Here each line keeps its text until it is known to be sound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendmill.schemas import BRONZE, BRONZE_COLUMNS

NOT_JSON, WRONG_TYPE, NO_KEY = "not_json", "wrong_type", "no_key"
REASONS = [NOT_JSON, WRONG_TYPE, NO_KEY]
QUARANTINE = ["reason", "file", "block_start", "line"]
KEYS = ["video_id", "region"]

_CORRUPT = "_corrupt"


def parse_lines(lines: DataFrame, text: str = "line") -> DataFrame:
    """The columns of bronze and ``reason`` beside those of ``lines``; reason is NULL for a sound line.

    not_json: no record could be read. wrong_type: a field did not fit and is NULL, the others are
    there. no_key: sound, but without a video or region, so silver has no place for it. A line of
    another shape, as a list or a number, is not_json.
    """
    record = F.from_json(F.col(text), f"{BRONZE}, {_CORRUPT} STRING", {"columnNameOfCorruptRecord": _CORRUPT})
    parsed = lines.withColumn("_record", record)
    corrupt = F.col(f"_record.{_CORRUPT}").isNotNull()
    empty = F.coalesce(*[F.col(f"_record.{name}").cast("string") for name in BRONZE_COLUMNS]).isNull()
    no_key = F.col("_record.video_id").isNull() | F.col("_record.region").isNull()
    unread = F.col("_record").isNull() | (corrupt & empty) | ~F.ltrim(text).startswith("{")
    reason = F.when(unread, NOT_JSON).when(corrupt, WRONG_TYPE).when(no_key, NO_KEY)
    return parsed.select(*lines.columns, *[F.col(f"_record.{name}").alias(name) for name in BRONZE_COLUMNS], reason.alias("reason"))


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SC1, SE1: every line of the landed files that is not blank, parsed, with its file and its text."""
    text = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start")
    )
    return parse_lines(text.filter(F.trim("line") != ""))


def records(lines: DataFrame) -> DataFrame:
    """The bronze records among the lines: sound ones, and those of which a field is missing. Nothing is lost beside the quarantine."""
    return lines.filter(F.col("reason").isNull() | (F.col("reason") != NOT_JSON)).select(*BRONZE_COLUMNS)


def quarantined(lines: DataFrame) -> DataFrame:
    """The lines to set aside, with the reason."""
    return lines.filter(F.col("reason").isNotNull()).select(*QUARANTINE)


def write_quarantine(lines: DataFrame, path: str) -> None:
    """Set lines aside, by reason; those of an earlier run stay."""
    quarantined(lines).write.mode("append").partitionBy("reason").parquet(path)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("file STRING, block_start BIGINT, line STRING, reason STRING").parquet(path).select(*QUARANTINE)


def line_counts(lines: DataFrame, by: Column) -> DataFrame:
    """Lines, sound ones, and those of each reason, per file or another group of ``by`` (with its alias)."""
    return lines.groupBy(by).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("reason").isNull()).alias("sound"),
        *[F.count_if(F.col("reason") == reason).alias(reason) for reason in REASONS],
    )


def replayed(quarantine: DataFrame, repaired: Column) -> DataFrame:
    """The set-aside lines parsed again as ``repaired``, an expression over their columns; what is still not sound keeps a reason.

    A repaired record stands beside the one with a missing field; both are of one time, and the one
    that has the field is the latest.
    """
    return parse_lines(quarantine.select("file", "block_start", repaired.alias("line")))
