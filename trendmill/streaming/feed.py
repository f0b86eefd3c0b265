"""ST1: incremental feed from landed JSON files to the current records per key.

The state table holds the latest record per video, region and day, also those that cannot be
published, because a bad record must keep hiding the older ones of its key. It is partitioned by the
day. The day belongs to the key, so a batch can only change the days it has records of, and however
large the history is, only those are read and written.

A batch is merged into its days in two steps. The merged rows are first written aside and marked
complete, then they replace the days. A batch that is run again after a crash finds the mark and only
repeats the second step, so no crash can lose the rows being replaced. A mark names the stream as well
as the batch: with a new checkpoint the numbers start again, but the stream has another id.

Each batch also leaves the list of keys whose current record has changed, for the tables built on the
state: with it they follow without reading what has not changed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from trendmill.operators.filters import partition_safe
from trendmill.operators.scale import group_key
from trendmill.plans.silver import ENTITY, SNAPSHOT, newest, timed_records, typed
from trendmill.schemas import BRONZE, BRONZE_COLUMNS, SILVER_PARTITIONS
from trendmill.session import children, exists


@dataclass(frozen=True)
class Feed:
    """Folders of one feed below a shared root."""

    root: str

    @property
    def state(self) -> str:
        return f"{self.root}/state"

    @property
    def merged(self) -> str:
        return f"{self.root}/merged"

    @property
    def changes(self) -> str:
        return f"{self.root}/changes"

    @property
    def arrivals(self) -> str:
        return f"{self.root}/arrivals"

    @property
    def marks(self) -> str:
        return f"{self.root}/marks"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


def stream_bronze(spark: SparkSession, source: str, files_per_batch: int | None = None) -> DataFrame:
    """New JSON-lines files of a landing folder (or glob), as they arrive."""
    reader = spark.readStream.schema(BRONZE)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(source)


def _state_schema() -> StructType:
    typed_time = BRONZE.replace("ingested_at STRING", "ingested_at TIMESTAMP")
    return StructType.fromDDL(f"{typed_time}, {SNAPSHOT} DATE")


def prepare_feed(spark: SparkSession, feed: Feed) -> None:
    """Create the empty state and the first mark of a new feed; an existing feed stays as it is."""
    empty = spark.createDataFrame([], _state_schema())
    empty.write.mode("ignore").partitionBy(SNAPSHOT).parquet(feed.state)
    _mark(spark, feed, "first", "", -1, "ignore")


def stream_id(spark: SparkSession, feed: Feed) -> str:
    """The id that the checkpoint of the running stream keeps over all its restarts."""
    return spark.read.schema("id STRING").json(f"{feed.checkpoint}/metadata").first()["id"]


def _mark(spark: SparkSession, feed: Feed, name: str, stream: str, batch_id: int, mode: str) -> None:
    done = spark.range(1).select(F.lit(stream).alias("stream"), F.lit(batch_id).cast("bigint").alias("batch_id"))
    done.write.mode(mode).json(f"{feed.marks}/{name}")


def _is_marked(spark: SparkSession, feed: Feed, stream: str, batch_id: int) -> bool:
    marks = spark.read.schema("stream STRING, batch_id BIGINT").option("recursiveFileLookup", True).json(feed.marks)
    return not marks.filter((F.col("stream") == stream) & (F.col("batch_id") == batch_id)).isEmpty()


def _replace_days(df: DataFrame, path: str, mode: str) -> None:
    """Overwrite all days (static) or those in ``df`` (dynamic)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(SNAPSHOT).parquet(path)


KEY = [*ENTITY, SNAPSHOT]
FRESH = "_fresh"
CHANGES = f"video_id STRING, region STRING, {SNAPSHOT} DATE, published_at STRING, old_published_at STRING"


def change_name(stream: str, batch_id: int) -> str:
    return f"{stream or 'none'}-{batch_id:010d}"


def _changes(won: DataFrame, current: DataFrame) -> DataFrame:
    """Keys whose record is new or another one, with the publishing times of both, as text."""
    before = current.select(*KEY, F.col("published_at").alias("old_published_at")).withColumn("_key", group_key(KEY)).drop(*KEY)
    after = won.select(*KEY, "published_at").withColumn("_key", group_key(KEY))
    return after.join(before, "_key", "left").drop("_key")


def change_lists(spark: SparkSession, feed: Feed) -> list[str]:
    """The names of the lists of changed keys that batches have left, also of one that is not done; its end repeats it."""
    return [name for name in children(spark, feed.changes) if exists(spark, f"{feed.changes}/{name}/_SUCCESS")]


def read_changes(spark: SparkSession, feed: Feed, names: list[str]) -> DataFrame:
    return spark.read.schema(CHANGES).parquet(*[f"{feed.changes}/{name}" for name in names])


def merge_batch(batch: DataFrame, batch_id: int, feed: Feed, stream: str = "") -> None:
    """Merge one batch of bronze records into the state. Running a batch of a stream twice changes nothing."""
    spark, schema = batch.sparkSession, _state_schema()
    if not _is_marked(spark, feed, stream, batch_id):
        fresh = timed_records(batch).select(*BRONZE_COLUMNS, SNAPSHOT).persist(StorageLevel.DISK_ONLY)
        try:
            # Older records of the batch go in the merge below, in one pass with those of the state.
            # A batch has few days; their dates become literals, which prune the partitions of the state.
            days = [row[0] for row in fresh.select(SNAPSHOT).distinct().collect()]
            touched = F.col(SNAPSHOT).isin([day for day in days if day is not None])
            if None in days:
                touched = touched | F.col(SNAPSHOT).isNull()
            current = spark.read.schema(schema).parquet(feed.state).filter(touched)
            both = current.withColumn(FRESH, F.lit(0)).unionByName(fresh.withColumn(FRESH, F.lit(1)))
            merged = newest(both, "day", F.asc(FRESH))  # an equal record changes nothing
            _replace_days(merged.hint("rebalance", SNAPSHOT), feed.merged, "static")  # AQE splits a day too large for a task
            won = spark.read.schema(_state_schema().add(FRESH, "integer")).parquet(feed.merged).filter(F.col(FRESH) == 1)
            _changes(won, current).write.mode("overwrite").parquet(f"{feed.changes}/{change_name(stream, batch_id)}")
            _mark(spark, feed, "last", stream, batch_id, "overwrite")
        finally:
            fresh.unpersist()
    # These files have one day each, so they are copied as they are, without another shuffle.
    _replace_days(spark.read.schema(schema).parquet(feed.merged), feed.state, "dynamic")


def start_feed(
    bronze: DataFrame,
    feed: Feed,
    every: str | None = None,
    also: Callable[[DataFrame, str], None] = lambda batch, name: None,
) -> StreamingQuery:
    """Process everything that has arrived, in batches, then stop; a later start goes on from there.

    With ``every``, an interval, it goes on looking for new files until it is stopped. ``also`` is
    called with each batch and its name before it is merged; a repeated batch has the same name.
    """
    spark = bronze.sparkSession
    prepare_feed(spark, feed)

    def merge(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id(spark, feed)
        also(batch, change_name(stream, batch_id))
        merge_batch(batch, batch_id, feed, stream)

    writer = bronze.writeStream.foreachBatch(merge).option("checkpointLocation", feed.checkpoint)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()


def feed_silver(spark: SparkSession, feed: Feed, grain: str = "day", days: list | None = None) -> DataFrame:
    """The silver table as of the last batch; equals the batch build over all files so far.

    The coarser grain is the latest of the daily records, found when it is read. With ``days`` (None
    among them: without a day) only these partitions of the state are read.
    """
    records = spark.read.schema(_state_schema()).parquet(feed.state)
    if days is not None:
        wanted = F.col(SNAPSHOT).isin([F.lit(day).cast("date") for day in days if day is not None])
        records = records.filter(wanted | F.col(SNAPSHOT).isNull() if None in days else wanted)
    if grain != "day":
        records = newest(records, grain)
    return partition_safe(typed(records), SILVER_PARTITIONS)
