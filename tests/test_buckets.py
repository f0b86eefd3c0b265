"""Tables stored by key: the same rows, and no shuffle above the scan."""

import uuid

from pyspark.sql import functions as F

from trendmill.plans import gold
from trendmill.plans.silver import ENTITY, silver_videos
from trendmill.sources.buckets import Bucketed, buckets_for, read_bucketed, write_bucketed
from test_layers import at
from test_quality import records

STAMPS = ["_silver_processed_at", "_gold_processed_at"]


def rows_of(df):
    return sorted(map(str, df.drop(*STAMPS).select(sorted(c for c in df.columns if c not in STAMPS)).collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path, rows, buckets=4):
    snaps = gold.snapshots(silver_videos(records(spark, *rows)))
    table = Bucketed(f"trendmill_check.by_key_{uuid.uuid4().hex}", str(tmp_path / "by_key"), tuple(ENTITY), (gold.SNAPSHOT,))
    assert write_bucketed(snaps, table, buckets) == snaps.count()
    return snaps, read_bucketed(spark, table)


ROWS = [at(d, video_id=f"v{i}", region=r, view_count=10 * i * d) for i in range(9) for d in (1, 2, 5) for r in ("US", "GB")]


def test_growth_needs_no_exchange(spark, tmp_path):
    snaps, table = stored(spark, tmp_path, ROWS)
    assert rows_of(table) == rows_of(snaps)
    growth = gold.view_velocity(table)
    assert "Exchange" in plan_of(gold.view_velocity(snaps))
    assert "Exchange" not in plan_of(growth)
    assert rows_of(growth) == rows_of(gold.view_velocity(snaps))


def test_growth_of_some_days_joins_in_place(spark, tmp_path):
    snaps, table = stored(spark, tmp_path, ROWS)
    growth = gold.velocity_of_days(table.hint("merge"), ["2026-01-02"])
    assert rows_of(growth) == rows_of(gold.velocity_of_days(snaps, ["2026-01-02"]))
    assert "ShuffleExchange" not in plan_of(growth) and "Exchange hashpartitioning" not in plan_of(growth)


def test_latest_per_key_needs_no_exchange(spark, tmp_path):
    snaps, table = stored(spark, tmp_path, ROWS)
    latest = table.groupBy(*ENTITY).agg(F.max_by("view_count", "ingested_at").alias("views"))
    assert "Exchange" not in plan_of(latest)
    assert rows_of(latest) == rows_of(snaps.groupBy(*ENTITY).agg(F.max_by("view_count", "ingested_at").alias("views")))


def test_empty_and_written_again(spark, tmp_path):
    snaps, table = stored(spark, tmp_path, ROWS[:3])
    again = Bucketed(f"trendmill_check.by_key_{uuid.uuid4().hex}", str(tmp_path / "other"), tuple(ENTITY))
    assert write_bucketed(snaps, again, 2) == snaps.count()
    assert write_bucketed(snaps.limit(0), again, 4) == 0
    assert read_bucketed(spark, again).count() == 0


def test_number_of_buckets():
    assert [buckets_for(n, 10) for n in (0, 1, 10, 11, 20, 21, 41)] == [1, 1, 1, 2, 2, 4, 8]
