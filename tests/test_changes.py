"""A lake that follows the feed: only what has changed is written, and it equals the whole build."""

from functools import partial
from pathlib import Path
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from trendmill.plans import daily
from trendmill.schemas import GOLD, SILVER
from trendmill.session import side_by_side
from trendmill.sources.bronze import land
from trendmill.sources.tables import read_table
from trendmill.streaming.feed import Feed, change_lists, feed_silver, read_changes, start_feed, stream_bronze
from test_layers import at
from test_quality import records

STAMPS = ("_silver_processed_at", "_gold_processed_at")


def rows_of(df):
    columns = [F.round(c, 9) if kind == "double" else F.col(c) for c, kind in sorted(df.dtypes) if c not in STAMPS]  # sums of doubles
    return sorted(map(str, df.select(columns).collect()))


def files(lake, layer, table):
    return {str(p.relative_to(lake.path(layer, table))): p.stat().st_mtime_ns for p in Path(lake.path(layer, table)).rglob("*.parquet")}


def folders(names):
    return {str(Path(n).parent) for n in names}


def video(i, day, **more):
    return at(day, video_id=f"v{i}", view_count=10 * i * day + 5, **more)


FIRST = [video(i, d, region=r) for i in range(1, 4) for d in (1, 2, 4, 6) for r in ("US", "GB")]
LATE = [
    video(1, 3),  # a day that was not there: growth of day 4 changes as well
    video(2, 2, hour=1) | {"view_count": 999},  # a correction
    video(3, 4, hour=1) | {"published_at": "bad"},  # a row that goes; growth of day 6 changes
    video(1, 6, region="GB"),  # nothing new
    video(2, 6, hour=2, region="GB") | {"published_at": "2025-11-05T00:00:00Z"},  # to another partition of silver
    {"video_id": "v9", "ingested_at": "bad"}, {"video_id": None}, video(4, 1, region=""),
]


def feed_in(spark, landing, feed, batch):
    land(records(spark, *batch), landing)
    start_feed(stream_bronze(spark, landing), feed).awaitTermination()


def same_as_whole_build(spark, feed, lake, root):
    whole = daily.Lake(root)
    daily.write_silver(feed_silver(spark, feed), whole)
    daily.build_gold(spark, whole)
    assert rows_of(read_table(spark, lake.path("silver", "videos"), SILVER)) == rows_of(read_table(spark, whole.path("silver", "videos"), SILVER))
    for name, table in daily.read_gold(spark, whole).items():
        assert rows_of(read_table(spark, lake.path("gold", name), GOLD[name])) == rows_of(table), name


def test_only_changes_are_written(spark, tmp_path):
    landing, feed, lake = str(tmp_path / "landing"), Feed(str(tmp_path / "feed")), daily.Lake(str(tmp_path / "lake"))
    feed_in(spark, landing, feed, FIRST)
    daily.run_feed(spark, feed, lake)
    same_as_whole_build(spark, feed, lake, str(tmp_path / "whole1"))
    assert daily.pending_changes(spark, feed, lake) == []
    tables = [("silver", "videos"), *[("gold", name) for name in GOLD]]
    before = {t: files(lake, *t) for t in tables}

    feed_in(spark, landing, feed, LATE)
    pending = daily.pending_changes(spark, feed, lake)
    changed = {(r.video_id, r.region, str(r.snapshot_date)) for r in read_changes(spark, feed, pending).collect()}
    assert changed == {
        ("v1", "US", "2026-01-03"), ("v2", "US", "2026-01-02"), ("v3", "US", "2026-01-04"), ("v2", "GB", "2026-01-06"),
        ("v9", "US", "None"), ("v4", "", "2026-01-01"),
    }
    run = daily.run_feed(spark, feed, lake)
    assert run.rows["daily_trending_rank"] == 1 + 3 + 2 + 3 + 1
    same_as_whole_build(spark, feed, lake, str(tmp_path / "whole2"))

    days = {"region=US/snapshot_date=2026-01-03", "region=US/snapshot_date=2026-01-02", "region=US/snapshot_date=2026-01-04", "region=GB/snapshot_date=2026-01-06"}
    days |= {"region=US/snapshot_date=__HIVE_DEFAULT_PARTITION__"}
    for layer, name in tables:
        after = files(lake, layer, name)
        new = folders(n for n, time in after.items() if before[layer, name].get(n) != time)
        if layer == "gold":
            more = {"region=US/snapshot_date=2026-01-06"} if name == "view_velocity" else set()
            assert new == days | more, name
        else:
            assert "region=GB/published_year=2025/published_month=11" in new

    again = {t: files(lake, *t) for t in tables}
    daily.run_feed(spark, feed, lake)  # nothing has come in
    assert {t: files(lake, *t) for t in tables} == again


def test_a_failed_run_is_repeated(spark, tmp_path, monkeypatch):
    landing, feed, lake = str(tmp_path / "landing"), Feed(str(tmp_path / "feed")), daily.Lake(str(tmp_path / "lake"))
    feed_in(spark, landing, feed, FIRST)
    daily.run_feed(spark, feed, lake)
    feed_in(spark, landing, feed, LATE[:3])

    def fails(*args, **more):
        raise RuntimeError("half-way")

    with monkeypatch.context() as broken:
        broken.setattr(daily, "apply_to_gold", fails)
        with pytest.raises(RuntimeError, match="half-way"):
            daily.run_feed(spark, feed, lake)
    assert len(daily.pending_changes(spark, feed, lake)) == 1
    feed_in(spark, landing, feed, [video(3, 4, hour=2)])
    assert len(daily.pending_changes(spark, feed, lake)) == 2
    daily.run_feed(spark, feed, lake)
    same_as_whole_build(spark, feed, lake, str(tmp_path / "whole"))
    assert len(change_lists(spark, feed)) == 3 and daily.pending_changes(spark, feed, lake) == []


def test_tables_of_a_layer_are_written_at_one_time(spark, tmp_path, monkeypatch):
    feed, lake = Feed(str(tmp_path / "feed")), daily.Lake(str(tmp_path / "lake"))
    feed_in(spark, str(tmp_path / "landing"), feed, FIRST)
    daily.run_feed(spark, feed, lake)
    feed_in(spark, str(tmp_path / "landing"), feed, LATE)
    replace, write, together = daily.replace_partitions, daily.write_table, {"gold": Barrier(5), "marts": Barrier(4)}

    def waiting(step):
        def run(df, path, *more, **named):
            layer = Path(path).parent.name
            if layer in together:
                together[layer].wait(120)  # breaks unless all tables of the layer come this far
            return step(df, path, *more, **named)

        return run

    monkeypatch.setattr(daily, "replace_partitions", waiting(replace))
    monkeypatch.setattr(daily, "write_table", waiting(write))
    daily.run_feed(spark, feed, lake)
    same_as_whole_build(spark, feed, lake, str(tmp_path / "whole"))


def test_rows_of_other_days_need_no_join(spark, tmp_path, monkeypatch):
    feed, lake = Feed(str(tmp_path / "feed")), daily.Lake(str(tmp_path / "lake"))
    feed_in(spark, str(tmp_path / "landing"), feed, FIRST)
    daily.run_feed(spark, feed, lake)
    feed_in(spark, str(tmp_path / "landing"), feed, [LATE[1], {"video_id": "v9", "ingested_at": "bad"}])
    joined, only = [], daily._only

    def watching(df, keys, columns, how="left_semi"):
        if how == "left_anti":
            joined.extend(str(row.snapshot_date) for row in df.select("snapshot_date").distinct().collect())
        return only(df, keys, columns, how)

    monkeypatch.setattr(daily, "_only", watching)
    daily.run_feed(spark, feed, lake)
    assert joined == ["2026-01-02"]
    same_as_whole_build(spark, feed, lake, str(tmp_path / "whole"))


def test_failures_are_raised_in_order_when_all_have_ended():
    ended = []

    def job(name, fails):
        if fails:
            raise ValueError(name)
        ended.append(name)
        return name

    found = side_by_side([partial(job, "a", False), partial(job, "b", True), partial(job, "c", True), partial(job, "d", False)])
    assert next(found) == "a"
    with pytest.raises(ValueError, match="b"):
        next(found)
    assert sorted(ended) == ["a", "d"]
    assert list(side_by_side([])) == []
