"""The incremental feed against the batch build."""

from functools import reduce

import pytest
from pyspark.sql import DataFrame

from trendmill.plans import silver
from trendmill.plans.silver import newest, silver_videos
from trendmill.sources.bronze import land
from trendmill.streaming import feed as streaming
from trendmill.streaming.feed import Feed, feed_silver, merge_batch, prepare_feed, start_feed, stream_bronze
from test_layers import at
from test_quality import records

STAMP = "_silver_processed_at"


def rows_of(df):
    return sorted(map(str, df.drop(STAMP).select(sorted(c for c in df.columns if c != STAMP)).collect()))


def batches():
    return [
        [at(1, 1, view_count=1), at(1, 2, view_count=2), at(2, 1, view_count=3), {"video_id": None}],
        [at(1, 1, view_count=9), at(2, 3, published_at="bad"), at(3, 1, region="GB"), {"ingested_at": "bad"}],
        [at(2, 2, view_count=4), at(3, 2, region="GB", view_count=7), at(1, 2, view_count=8)],
    ]


def test_feed_equals_batch_build(spark, tmp_path):
    landing = str(tmp_path / "landing")
    feed = Feed(str(tmp_path / "feed"))
    for batch in batches():
        land(records(spark, *batch), landing)
        start_feed(stream_bronze(spark, landing), feed).awaitTermination()
    everything = spark.read.schema(records(spark, {}).schema).json(landing)
    for grain in ("day", "latest"):
        assert rows_of(feed_silver(spark, feed, grain)) == rows_of(silver_videos(everything, grain))


def test_repeated_batch_changes_nothing(spark, tmp_path):
    feed = Feed(str(tmp_path))
    prepare_feed(spark, feed)
    for number, batch in enumerate(batches()):
        merge_batch(records(spark, *batch), number, feed)
        once = rows_of(feed_silver(spark, feed))
        merge_batch(records(spark, *batch), number, feed)
        assert rows_of(feed_silver(spark, feed)) == once


@pytest.mark.parametrize("landed_again", [1, 2])
def test_a_new_checkpoint_loses_nothing(spark, tmp_path, landed_again):
    """Batch numbers start again; also with as many batches as before."""
    first, second = Feed(str(tmp_path / "feed")), str(tmp_path / "other")
    for number, batch in enumerate(batches()[: landed_again + 1]):
        land(records(spark, *batch), str(tmp_path / f"landing{number}"))
    start_feed(stream_bronze(spark, str(tmp_path / "landing0")), first).awaitTermination()
    for number in range(1, landed_again + 1):
        class Renewed(Feed):
            @property
            def checkpoint(self):
                return f"{second}/{number}"

        start_feed(stream_bronze(spark, str(tmp_path / f"landing{number}")), Renewed(first.root)).awaitTermination()
    everything = reduce(DataFrame.union, [records(spark, *batch) for batch in batches()[: landed_again + 1]])
    assert rows_of(feed_silver(spark, first)) == rows_of(silver_videos(everything))


def test_equal_times_are_decided_by_all_columns(spark, tmp_path):
    pair = [at(1, 1, like_count=5, comment_count=None), at(1, 1, like_count=None, comment_count=5)]
    found = []
    for number, order in enumerate((pair, pair[::-1])):
        feed = Feed(str(tmp_path / str(number)))
        prepare_feed(spark, feed)
        for batch, row in enumerate(order):
            merge_batch(records(spark, row), batch, feed)
        found += [rows_of(feed_silver(spark, feed)), rows_of(silver_videos(records(spark, *order)))]
    assert len(found[0]) == 1 and all(rows == found[0] for rows in found)


@pytest.mark.parametrize("broken_step", ["static", "dynamic"])
def test_crash_in_a_batch_is_repaired_by_the_next_run(spark, tmp_path, monkeypatch, broken_step):
    feed, twin = Feed(str(tmp_path / "a")), Feed(str(tmp_path / "b"))
    first, second = (records(spark, *batch) for batch in batches()[:2])
    for each in (feed, twin):
        prepare_feed(spark, each)
        merge_batch(first, 0, each)
    merge_batch(second, 1, twin)

    replace = streaming._replace_days

    def crashing(df, path, mode):
        if mode == broken_step:
            if mode == "dynamic":
                # A crash between deletion and renaming can leave the touched partitions empty,
                # and this batch touches them all.
                replace(df.limit(0), path, "static")
            raise RuntimeError("lost driver")
        replace(df, path, mode)

    monkeypatch.setattr(streaming, "_replace_days", crashing)
    with pytest.raises(RuntimeError):
        merge_batch(second, 1, feed)
    monkeypatch.setattr(streaming, "_replace_days", replace)
    merge_batch(second, 1, feed)
    assert rows_of(feed_silver(spark, feed)) == rows_of(feed_silver(spark, twin))


def test_a_batch_leaves_other_days_alone(spark, tmp_path):
    feed = Feed(str(tmp_path))
    prepare_feed(spark, feed)
    merge_batch(records(spark, at(1), at(2)), 0, feed)
    first_day = {f for f in spark.read.parquet(feed.state).inputFiles() if "2026-01-01" in f}
    merge_batch(records(spark, at(2, 5, view_count=6)), 1, feed)
    assert first_day and first_day <= set(spark.read.parquet(feed.state).inputFiles())
    assert [r.view_count for r in feed_silver(spark, feed).orderBy("ingested_at").collect()] == [1, 6]


def test_a_batch_is_sorted_once_with_the_state(spark, tmp_path, monkeypatch):
    calls = []

    def counting(records, grain, *then):
        calls.append(grain)
        return newest(records, grain, *then)

    for module in (streaming, silver):
        monkeypatch.setattr(module, "newest", counting)
    feed = Feed(str(tmp_path))
    prepare_feed(spark, feed)
    for number, batch in enumerate(batches()):
        once = records(spark, *batch)
        merge_batch(once.union(once), number, feed)
        assert len(calls) == number + 1
    monkeypatch.undo()
    whole = reduce(DataFrame.unionByName, [records(spark, *batch) for batch in batches()])
    assert rows_of(feed_silver(spark, feed)) == rows_of(silver_videos(whole))


def test_the_state_is_copied_without_a_shuffle(spark, tmp_path, monkeypatch):
    plans, replace = {}, streaming._replace_days

    def watching(df, path, mode):
        plans[mode] = df._jdf.queryExecution().optimizedPlan().toString()
        replace(df, path, mode)

    monkeypatch.setattr(streaming, "_replace_days", watching)
    feed = Feed(str(tmp_path))
    prepare_feed(spark, feed)
    merge_batch(records(spark, *batches()[0]), 0, feed)
    assert "RebalancePartitions" in plans["static"] and "Rebalance" not in plans["dynamic"]
