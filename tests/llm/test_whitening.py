"""Whitening against numpy's own decomposition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendmill.llm import whitening


def expected(vectors, k):
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (x * n - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1]
    keep = order[values[order] > 1e-9 * values.max()][:k]
    return n, np.square(x * n - sums).sum(axis=1), centred @ vectors[:, keep] / np.sqrt(values[keep]), values[keep] / values.sum()


def check(rows, vectors, ids, k, near=1e-9):
    n, deviation, white, share = expected(vectors, k)
    c = white.shape[1]
    assert len(rows) == n * c and {r.component for r in rows} == set(range(1, c + 1)) and {r.n for r in rows} == {n}
    got = np.full((n, c), np.nan)
    place = {i: at for at, i in enumerate(ids)}
    for r in rows:
        assert r.deviation == deviation[place[r.vec_id]] and abs(r.explained - share[r.component - 1]) <= 1e-10
        got[place[r.vec_id], r.component - 1] = r.whitened
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error <= 1e-8
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got * sign - white).max() < near


def test_given_embeddings(tables):
    df = tables("embeddings")
    vectors = df.collect()
    check(whitening.whitened(df.repartition(5)).collect(), [r.embedding for r in vectors], [r.vec_id for r in vectors], 32, 1e-8)


def test_null_odd_repeated_and_clashing(spark):
    chance = np.random.default_rng(1)
    good = [chance.normal(size=5).astype(np.float32).tolist() for _ in range(60)] + [[1.0] * 5] * 40
    odd = [None, [], [1.0, None, 1.0, 1.0, 1.0], [float("nan")] * 5, [float("inf"), 1.0, 1.0, 1.0, 1.0], [1.0, 2.0]]
    rows = [(i, v, 1, "x") for i, v in enumerate(good + odd)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component int, x string")
    check(whitening.whitened(df, 32).collect(), good, range(100), 32)
    check(whitening.whitened(df, 3).collect(), good, range(100), 3)
    nameless = df.withColumn("vec_id", F.lit(None).cast("long"))
    assert whitening.whitened(nameless, 2).where("vec_id IS NULL").count() == 200


def test_fewer_directions_than_dimensions(spark):
    turn = np.random.default_rng(2).integers(-3, 4, (2, 6))
    vectors = [(np.array([i % 7, i * i % 5]) @ turn).astype(float).tolist() for i in range(50)]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    check(whitening.whitened(df).collect(), vectors, range(50), 32)


def test_equal_variances_are_all_found(spark):
    """The corners of a cross: every direction has the same variance."""
    vectors = [[s * 2.0 if i == j else 0.0 for j in range(4)] for i in range(4) for s in (1, -1)] * 3
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    rows = whitening.whitened(df).collect()
    assert {r.component for r in rows} == {1, 2, 3, 4} and all(abs(r.explained - 0.25) < 1e-12 for r in rows)
    white = np.zeros((24, 4))
    for r in rows:
        white[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(white.T @ white / 24 - np.eye(4)).max() < 1e-12


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[3.0, 4.0]] * 9, [None, []]])
def test_nothing_varies(spark, vectors):
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    assert whitening.whitened(df).count() == 0


def test_very_large_entries(spark):
    vectors = [[3e38, 1.0], [-3e38, 2.0], [1.0, 3.0], [1.0, 1.0]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    rows = whitening.whitened(df, 1).collect()
    assert len(rows) == 4 and all(np.isfinite(r.whitened) for r in rows)
    assert {r.vec_id for r in rows if r.deviation is None} == {0, 1} and abs(sum(r.whitened**2 for r in rows) / 4 - 1) < 1e-9
