"""ST1, AG11: wait for landed files with a deadline, and count what arrives by region and hour.

Every batch leaves its own counts under its name, which a repeated batch writes over. So the totals
hold each record once, and none is dropped for being late, as rows behind a stream's watermark would
be: an hour is only called closed when the latest record seen is further on than the allowed lateness.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from trendmill.functions.parsing import to_timestamp
from trendmill.session import children, exists
from trendmill.streaming.feed import Feed, start_feed

COUNTS = "region STRING, hour TIMESTAMP, records BIGINT, last_seen TIMESTAMP"


class NoArrival(Exception):
    """Nothing has arrived before the deadline."""


def batch_counts(batch: DataFrame) -> DataFrame:
    """Records per region and hour, without an hour where the time cannot be read."""
    seen = to_timestamp(F.col("ingested_at"))
    return (
        batch.select("region", seen.alias("seen"))
        .groupBy("region", F.date_trunc("hour", "seen").alias("hour"))
        .agg(F.count(F.lit(1)).alias("records"), F.max("seen").alias("last_seen"))
    )


def arrival_counts(spark: SparkSession, feed: Feed, lateness: str = "1 hour") -> DataFrame:
    """AG11: records per region and hour over all batches; ``closed`` hours ended more than ``lateness`` before the last record."""
    names = [name for name in children(spark, feed.arrivals) if exists(spark, f"{feed.arrivals}/{name}/_SUCCESS")]
    counted = spark.createDataFrame([], COUNTS)
    if names:
        counted = spark.read.schema(COUNTS).parquet(*[f"{feed.arrivals}/{name}" for name in names])
    latest = counted.agg(F.max("last_seen").alias("_latest"))  # one row
    totals = counted.groupBy("region", "hour").agg(F.sum("records").alias("records"), F.max("last_seen").alias("last_seen"))
    ended = F.col("hour") + F.expr("INTERVAL 1 HOUR") + F.expr(f"INTERVAL {lateness}")
    closed = F.coalesce(ended <= F.col("_latest"), F.lit(False))
    return totals.join(F.broadcast(latest)).withColumn("closed", closed).drop("_latest")


def _idle(query: StreamingQuery) -> bool:
    status = query.status
    return not status["isTriggerActive"] and not status["isDataAvailable"]


def wait_for_arrivals(
    bronze: DataFrame, feed: Feed, every: str = "120 seconds", timeout: float = 3600, quiet: float = 300
) -> int:
    """Run the feed until files have arrived and none more for ``quiet`` seconds; returns the records merged.

    New files are looked for at each interval. Raises after ``timeout`` seconds if none came; if some
    did, but more are still coming, the rest is left to the next start. A batch that is under way is
    finished first.
    """
    spark = bronze.sparkSession
    names, last = [], time.monotonic()

    def count(batch: DataFrame, name: str) -> None:
        nonlocal last
        batch_counts(batch).write.mode("overwrite").parquet(f"{feed.arrivals}/{name}")
        names.append(name)
        last = time.monotonic()

    began = time.monotonic()
    query = start_feed(bronze, feed, every, count)
    try:
        while not query.awaitTermination(1):  # true if somebody else stopped it; a failure is raised here
            now = time.monotonic()
            settled = names and now - last >= quiet
            if (settled or now - began >= timeout) and _idle(query):
                break
    finally:
        query.stop()
    merged = 0
    if names:
        counted = spark.read.schema(COUNTS).parquet(*[f"{feed.arrivals}/{name}" for name in dict.fromkeys(names)])
        merged = counted.agg(F.sum("records")).first()[0] or 0
    if not merged:
        raise NoArrival(f"nothing has arrived within {timeout:g} seconds")
    return merged
