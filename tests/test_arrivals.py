"""Waiting for files, and counts of what has arrived."""

import threading

import pytest
from pyspark.sql import functions as F

from trendmill.plans.silver import silver_videos
from trendmill.sources.bronze import land
from trendmill.streaming.arrivals import NoArrival, arrival_counts, batch_counts, wait_for_arrivals
from trendmill.streaming.feed import Feed, feed_silver, start_feed, stream_bronze
from test_feed import batches, rows_of
from test_quality import records


def counts_of(df):
    return sorted(map(str, df.select("region", "hour", "records").collect()))


def test_files_landed_while_it_runs_are_counted(spark, tmp_path):
    landing, feed = str(tmp_path / "landing"), Feed(str(tmp_path / "feed"))
    first, *later = [records(spark, *batch) for batch in batches()]
    land(first.limit(0), landing)  # the folder

    def arrive():
        for batch in (first, *later):
            land(batch, landing)

    timer = threading.Timer(3, arrive)
    timer.start()
    merged = wait_for_arrivals(stream_bronze(spark, landing), feed, "1 seconds", timeout=90, quiet=6)
    timer.join()
    everything = spark.read.schema(first.schema).json(landing)
    assert merged == everything.count() == sum(len(batch) for batch in batches())
    assert rows_of(feed_silver(spark, feed)) == rows_of(silver_videos(everything))
    assert counts_of(arrival_counts(spark, feed)) == counts_of(batch_counts(everything))
    assert not spark.streams.active


def test_no_arrival_raises_after_the_deadline(spark, tmp_path):
    landing, feed = str(tmp_path / "landing"), Feed(str(tmp_path / "feed"))
    land(records(spark, {}).limit(0), landing)
    with pytest.raises(NoArrival):
        wait_for_arrivals(stream_bronze(spark, landing), feed, "1 seconds", timeout=3, quiet=1)
    assert not spark.streams.active
    assert arrival_counts(spark, feed).count() == 0


def test_repeated_batch_is_counted_once_and_late_records_too(spark, tmp_path):
    landing, feed = str(tmp_path / "landing"), Feed(str(tmp_path / "feed"))
    names = []

    def count(batch, name):
        for _ in range(2):
            batch_counts(batch).write.mode("overwrite").parquet(f"{feed.arrivals}/{name}")
        names.append(name)

    for hour in (9, 3, 5):  # the later files have earlier records
        land(records(spark, {"ingested_at": f"2026-01-01T0{hour}:10:00Z", "region": "US"}, {"ingested_at": "bad", "region": "US"}), landing)
        start_feed(stream_bronze(spark, landing), feed, also=count).awaitTermination()
    assert len(set(names)) == 3
    found = arrival_counts(spark, feed, "4 hours").withColumn("hour", F.hour("hour"))
    got = {(row.hour, row.records, row.closed) for row in found.collect()}
    assert got == {(9, 1, False), (3, 1, True), (5, 1, False), (None, 3, False)}
