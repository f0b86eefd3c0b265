"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

The bidiagonalisation alternates products X v and Xᵀ u over the centred rows X, one pass for each step. A left
vector u is as long as the table and is never stored: each is X w for a w that is as short as a row, so that
a pass works out all left vectors of its rows again by one small matrix product. What a pass returns are sums
over all rows, as many as dimensions and steps; the driver keeps vectors of that length alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmill.session import stage

SCALE, SHIFT = 64, 1_000_000  # of the whole numbers that entries become
LARGEST = 2.0**52  # entries beyond, as scaled, count as this
ROWS_AT_ONCE = 1 << 13
TINY = 1e-12  # deviations below this share of the largest count as none
SEED = 7


@dataclass(frozen=True)
class Fit:
    """Of n rows: sums of each dimension, components (unit rows) by falling variances, and the trace of the covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float


def whole_numbers(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id and x, floor(64 c) + 1000000 for each entry c, of the vectors whose entries are all finite.

    Null and empty vectors and those with a null, NaN or infinite entry are dropped. The longest
    vector fixes the dimensions; a shorter one lacks entries and is dropped as well.
    """
    vector = F.col(f"`{vector_column}`")
    entry = F.transform(vector, lambda c: c.cast("double"))
    finite = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(entry, lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))).cast("long") + SHIFT)
    rows = vectors.select(F.col(f"`{id_column}`").alias("vec_id"), whole.alias("x"), finite.alias("finite"), F.size(vector).alias("size"))
    rows = stage(rows.where("finite AND size > 0").select("vec_id", "x", "size"), "whole")
    size = rows.agg(F.max("size")).first()[0]
    return rows.where(F.col("size") == (size or 0)).select("vec_id", "x")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Some thousands of rows at a time, with their vectors as a matrix of longs."""
    held, n = [], 0

    def matrix() -> tuple[pa.RecordBatch, np.ndarray]:
        rows = pa.concat_batches(held)
        return rows, rows["x"].flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
            if n >= ROWS_AT_ONCE:
                yield matrix()
                held, n = [], 0
    if held:
        yield matrix()


def _sums(rows: DataFrame) -> list[int]:
    """The exact sum of each dimension."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in _blocks(batches):
            for at in range(0, len(x), 1 << 10):  # so few entries of at most LARGEST do not leave 64 bits
                part = x[at : at + (1 << 10)].sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(part))), pa.array(part)], ["i", "part"])

    total = rows.mapInArrow(partial, "i LONG, part LONG").groupBy("i").agg(F.sum(F.col("part").cast("decimal(38,0)")))
    return [int(row[1]) for row in sorted(total.collect())]


def _totals(rows: DataFrame, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of ``work``, which gives a vector for a block of them; summed in Spark, entry by entry."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for _, x in _blocks(batches):
            part = work(x)
            found = part if found is None else found + part
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found))), pa.array(found)], ["i", "part"])

    total = rows.mapInArrow(partial, "i LONG, part DOUBLE").groupBy("i").agg(F.sum("part"))
    return np.array([row[1] for row in sorted(total.collect())])


def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """x less the mean, whose whole part is taken off exactly."""
    return (x - whole).astype(np.float64) - rest


def _mean(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    whole = [s // n for s in sums]
    return np.array(whole, np.int64), np.array([(s - n * w) / n for s, w in zip(sums, whole, strict=True)])


def fitted(rows: DataFrame, k: int = 32) -> Fit | None:
    """The first ``k`` principal components of ``whole_numbers``, or None without rows.

    Each step takes v, the next right vector, to p = X v less its part along the last left vector,
    in one pass that also returns the products of p with all left vectors, for the full
    reorthogonalisation, and Xᵀ p. Where a step leads nowhere new (fewer directions than dimensions,
    or equal variances), the next one starts from another random vector. After as many steps as
    dimensions the small bidiagonal matrix gives all components and deviations; fewer steps could
    miss one of two equal variances. Directions without variance are no components.
    """
    n = rows.count()
    if not n:
        return None
    sums = _sums(rows)
    whole, rest = _mean(n, sums)
    d = len(sums)
    trace = _totals(rows, lambda x: np.square(_centred(x, whole, rest)).sum().reshape(1))[0] / n
    if not trace:
        return Fit(n, sums, np.empty((0, d)), np.empty(0), 0.0)

    chance, least = np.random.default_rng(SEED), TINY * np.sqrt(n * trace)
    right, w, z = np.empty((d, 0)), np.empty((d, 0)), np.empty((d, 0))
    alphas, betas = [], []

    def apart(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - right @ (right.T @ v)
        return v

    v = chance.standard_normal(d)
    while True:
        v = v / np.linalg.norm(v)
        steps = len(alphas)
        y = v - (betas[-1] * w[:, -1] if steps else 0)

        def step(x: np.ndarray, w: np.ndarray = w, y: np.ndarray = y) -> np.ndarray:
            x = _centred(x, whole, rest)
            p = x @ y
            return np.concatenate([(x @ w).T @ p, x.T @ p, [p @ p]])

        found = _totals(rows, step)
        h, xp, square = found[:steps], found[steps:-1], found[-1]
        alpha = np.sqrt(max(square - h @ h, 0.0))
        if alpha <= least:
            alpha, own, product = 0.0, np.zeros(d), np.zeros(d)
        else:
            own, product = (y - w @ h) / alpha, (xp - z @ h) / alpha
        right, w, z = (np.column_stack(pair) for pair in ((right, v), (w, own), (z, product)))
        alphas.append(alpha)
        if len(alphas) == d:
            break
        r = apart(product - alpha * v)
        beta = np.linalg.norm(r)
        if beta <= least:
            beta, r = 0.0, apart(chance.standard_normal(d))
        betas.append(beta)
        v = r
    _, deviations, turned = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
    keep = deviations > 10 * TINY * deviations[0]
    components = (right @ turned.T).T[keep][:k]
    return Fit(n, sums, components / np.linalg.norm(components, axis=1, keepdims=True), deviations[keep][:k] ** 2 / n, trace)


def identity_error(rows: DataFrame, fit: Fit) -> float:
    """The largest difference of the whitened rows' covariance from the identity, over all ``rows``."""
    whole, rest = _mean(fit.n, fit.sums)
    turn = (fit.components / np.sqrt(fit.variances)[:, None]).T
    k = len(fit.variances)

    def work(x: np.ndarray) -> np.ndarray:
        y = _centred(x, whole, rest) @ turn
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    found = _totals(rows, work) / fit.n
    mean, square = found[:k], found[k:].reshape(k, k)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum of (n x - S)^2 over the dimensions of each row, exact; null beyond 64 bits."""
    if not len(x):
        return []
    apart = np.abs(x.astype(np.float64) * n - np.array(sums, np.float64))
    if float((apart**2).sum(axis=1).max()) < 2.0**62 and max(map(abs, sums)) < 2**62 and np.abs(x).max() * float(n) < 2.0**62:
        return np.square(x * n - np.array(sums, np.int64)).sum(axis=1).tolist()
    exact = [sum((v * n - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v < 2**63 else None for v in exact]


def whitened(vectors: DataFrame, k: int = 32, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, a row for each vector and component.

    What is dropped is said in ``whole_numbers``. whitened is the centred row along the component,
    over the root of the component's variance; the covariance of whitened values over all rows is
    the identity up to identity_error. explained is the component's share of the whole variance.
    deviation is null where it does not fit 64 bits. Repeated vectors count each time. Vectors that
    are all equal, and an empty table, have no components and so no rows. Components of equal
    variance may be turned against each other. Other columns may have any name.
    """
    rows = whole_numbers(vectors, id_column, vector_column)
    fit = fitted(rows, k)
    schema = "vec_id LONG, component INT, n LONG, deviation LONG, whitened DOUBLE, explained DOUBLE, identity_error DOUBLE"
    if fit is None or not len(fit.variances):
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, fit)
    whole, rest = _mean(fit.n, fit.sums)
    turn = (fit.components / np.sqrt(fit.variances)[:, None]).T
    share, c = fit.variances / fit.trace, len(fit.variances)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _blocks(batches):
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), c))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"].cast(pa.int64()).take(each), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), m)), pa.array(np.full(m * c, fit.n)),
                    pa.array(_deviation(x, fit.n, fit.sums), pa.int64()).take(each), pa.array((_centred(x, whole, rest) @ turn).ravel()),
                    pa.array(np.tile(share, m)), pa.array(np.full(m * c, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(project, schema)
