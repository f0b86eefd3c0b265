"""Ranks on small groups, on groups split into cells, and on one hot group."""

import random

import pytest
from pyspark.sql import functions as F

from trendmill.operators import ranking, scale
from trendmill.operators.aggregates import join_totals, share_of_total, value_at_max, window_totals

WINDOW, CELLS = 10**9, 100


def skewed_rows(n=900, seed=3):
    """One group holds a third of the rows, a third of which share one measure; some keys are NULL."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i < n // 3 else rng.choice(["a", "b", None, *[f"g{j}" for j in range(40)]])
        measure = 7 if i % 3 == 0 else rng.choice([None, *range(50)])
        rows.append((key, measure, f"id{i:04}"))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.createDataFrame(skewed_rows(), "k string, m bigint, id string").repartition(6).persist()


def by_group(rows):
    groups = {}
    for key, measure, ident in rows:
        groups.setdefault(key, []).append((measure, ident))
    return groups


def descending(group):
    return sorted(group, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))


@pytest.mark.parametrize("limit", [WINDOW, CELLS])
def test_row_number(skewed, limit):
    order = [F.desc("m"), F.asc("id")]
    seen = ranking.row_number_in_group(skewed, ["k"], order, "rn", max_group_rows=limit)
    expected = {
        ident: i for group in by_group(skewed_rows()).values() for i, (_, ident) in enumerate(descending(group), 1)
    }
    assert {row.id: row.rn for row in seen.collect()} == expected
    assert dict(seen.dtypes)["rn"] == "int"


@pytest.mark.parametrize("limit", [WINDOW, CELLS])
def test_rank_has_gaps(skewed, limit):
    seen = ranking.rank_in_group(skewed, ["k"], "m", "r", max_group_rows=limit).collect()
    assert len(seen) == 900
    groups = by_group(skewed_rows())
    for row in seen:
        larger = [m for m, _ in groups[row.k] if m is not None and (row.m is None or m > row.m)]
        assert row.r == len(larger) + 1


@pytest.mark.parametrize("limit", [WINDOW, CELLS])
def test_top_n_keeps_ties(skewed, limit):
    ranked = ranking.rank_in_group(skewed, ["k"], "m", "r", max_group_rows=WINDOW)
    expected = {(row.id, row.r) for row in ranked.collect() if row.r <= 4}
    seen = ranking.top_n_with_ties(skewed, ["k"], "m", 4, "r", max_group_rows=limit).collect()
    assert {(row.id, row.r) for row in seen} == expected
    assert len(seen) == len(expected)


def test_ties_at_the_last_rank(spark):
    rows = [("g", float(100 - i), i) for i in range(18)] + [("g", 1.0, 100 + i) for i in range(4)]
    df = spark.createDataFrame(rows, "k string, v double, id int")
    for limit in (WINDOW, CELLS):
        seen = ranking.top_n_with_ties(df, ["k"], "v", 20, "r", max_group_rows=limit).collect()
        assert sorted(row.r for row in seen) == [*range(1, 19), 19, 19, 19, 19]


def test_top_n_is_exact(skewed):
    seen = ranking.top_n(skewed, ["k"], [F.desc("m"), F.asc("id")], 3, "rn").collect()
    for key, group in by_group(skewed_rows()).items():
        mine = sorted((row.rn, row.id) for row in seen if row.k == key)
        assert mine == [(i, ident) for i, (_, ident) in enumerate(descending(group)[:3], 1)]


def test_latest_per_key_has_unique_input_rows(skewed):
    seen = ranking.latest_per_key(skewed, ["k"], [F.desc("m"), F.desc("id")])
    assert seen.count() == seen.select("k").distinct().count() == len(by_group(skewed_rows()))
    assert seen.exceptAll(skewed).isEmpty()


@pytest.mark.parametrize("limit", [WINDOW, CELLS])
def test_shares_add_up(skewed, limit):
    seen = share_of_total(skewed, ["k"], "m", "s", max_group_rows=limit)
    assert seen.count() == 900
    for row in seen.groupBy("k").agg(F.sum("s").alias("s")).collect():
        assert row.s == pytest.approx(1.0)


def test_totals_before_use_weights(skewed):
    order = [F.desc("m"), F.asc("id")]
    both = [
        scale.total_before(skewed, ["k"], order, F.coalesce("m", F.lit(0)), "t", max_group_rows=limit)
        for limit in (WINDOW, CELLS)
    ]
    assert sorted(map(str, both[0].collect())) == sorted(map(str, both[1].collect()))


def test_join_and_window_totals_agree(spark):
    rows = [(c, r, d, v) for c in (1, 2, None) for r in "ab" for d in (1, 2, None) for v in (1, 5)]
    df = spark.createDataFrame(rows, "c int, r string, d int, v bigint")
    totals = {"total": F.sum("v"), "mean": F.avg("v")}
    joined = join_totals(df, ["c", "d"], totals)
    windowed = window_totals(df, ["c", "d"], totals)
    assert joined.columns == windowed.columns
    assert joined.exceptAll(windowed).isEmpty() and windowed.exceptAll(joined).isEmpty()
    assert joined.filter("c IS NULL OR d IS NULL").isEmpty()


def test_value_at_max_skips_nulls(spark):
    rows = [(None, 9, "a"), ("x", 5, "b"), ("y", 5, "c"), ("z", None, "d")]
    df = spark.createDataFrame(rows, "t string, v int, id string")
    assert df.agg(value_at_max("t", "v", "id")).first()[0] == "y"
    assert df.filter("t IS NULL").agg(value_at_max("t", "v", "id")).first()[0] is None


def test_ntile_sizes(spark):
    df = spark.createDataFrame([("g", i) for i in range(12)], "k string, v int")
    seen = ranking.ntile_in_group(df, ["k"], [F.asc("v")], 5, "q").groupBy("q").count().orderBy("q").collect()
    assert [row["count"] for row in seen] == [3, 3, 2, 2, 2]


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, m bigint, id string")
    assert ranking.row_number_in_group(df, ["k"], [F.desc("m")], "rn").count() == 0
    assert ranking.rank_in_group(df, ["k"], "m", "r").count() == 0
    assert share_of_total(df, ["k"], "m", "s").count() == 0
