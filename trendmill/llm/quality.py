"""A quality classifier: regularised quadratic discriminant analysis of document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendmill.llm.rules import STATS, text_statistics
from trendmill.llm.words import per_slice, slices, texts_only
from trendmill.session import stage

#: Features: square roots of shares, which are less skewed than the shares, and the logarithm of the length.
#: Each share is taken with some words, lines or letters of ordinary prose added, since those of short texts say little.
SHARES = {
    "symbols": ("n_symbols", 0.0, "n_words", 20),
    "noisy": ("n_noisy", 0.0, "n_words", 20),
    "loud": ("n_loud", 0.0, "n_words", 20),
    "frequent": ("n_frequent", 0.2, "n_words", 20),
    "repeated": ("n_repeat_words", 0.0, "n_words", 20),
    "same_lines": ("n_dup_lines", 0.0, "n_lines", 2),
    "ended_lines": ("n_ended_lines", 1.0, "n_lines", 2),
    "capitals": ("n_upper", 0.02, "n_letters", 100),
    "letters": ("n_letters", 0.97, "word_chars", 100),
    "word_length": ("word_chars", 5.0, "n_words", 20),
}
FEATURES = [*SHARES, "length"]
TO_POOLED = 0.5  # weight of the pooled covariance in that of a class
TO_SPHERE = 0.1  # weight of a sphere with the class's mean variance
THRESHOLD = 0.3

SCORES = "doc_id BIGINT, score DOUBLE"


def held_out(id_column: str = "doc_id", folds: int = 5) -> Column:
    """Whether an id belongs to the fold that is not learnt from; a null id does not."""
    crc = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(crc % folds == 0, F.lit(False))


def _features(texts: pa.Array) -> np.ndarray:
    counts = dict(zip(STATS, (np.asarray(x, float) for x in text_statistics(texts)), strict=True))
    shares = [np.sqrt((counts[a] + usual * n) / (counts[b] + n)) for a, usual, b, n in SHARES.values()]
    return np.stack([*shares, np.log1p(counts["n_words"])], axis=1)


def features(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and the array x of FEATURES of each whole text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _features(batch["text"])
        lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES), pa.array(x.ravel()))
        return pa.RecordBatch.from_arrays([batch["doc_id"], lists], ["doc_id", "x"])

    rows = texts_only(docs, id_column, text_column).withColumn("doc_id", F.col("doc_id").cast("long"))
    return per_slice(rows, "text", work, "doc_id BIGINT, x ARRAY<DOUBLE>")


@dataclass(frozen=True)
class Discriminant:
    """means, factors (lower Cholesky), log densities' constants and log odds of two classes; log_odds alone if one is missing."""

    log_odds: float
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    constants: np.ndarray | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1 of each row of x, by the difference of the two log densities."""
        log_odds = np.full(len(x), self.log_odds)
        if self.means is not None:
            for sign, mean, factor, constant in zip((-1, 1), self.means, self.factors, self.constants, strict=True):
                away = np.linalg.solve(factor, (x - mean).T)
                log_odds += sign * (constant - 0.5 * (away**2).sum(axis=0))
        return 1 / (1 + np.exp(-np.clip(log_odds, -500, 500)))


def _sums(rows: DataFrame) -> np.ndarray:
    """For class 0 and 1 the sum of (1, x) (1, x)^T, added up per task and then by entry in the cluster."""
    n = len(FEATURES) + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, n, n))
        for batch in batches:
            if batch.num_rows:
                x = batch["x"].flatten().to_numpy().reshape(batch.num_rows, -1)
                x = np.hstack([np.ones((len(x), 1)), x])
                label = batch["label"].to_numpy()
                for c in range(2):
                    total[c] += x[label == c].T @ x[label == c]
        entry = pa.array(np.arange(total.size, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([entry, pa.array(total.ravel())], ["entry", "value"])

    out = np.zeros(2 * n * n)
    for entry, value in rows.mapInArrow(work, "entry INT, value DOUBLE").groupBy("entry").agg(F.sum("value")).collect():
        out[entry] = value
    return out.reshape(2, n, n)


def fit(xs: DataFrame, labels: DataFrame) -> Discriminant:
    """Learn from the rows of ``xs`` (doc_id, x) that have a row in ``labels`` (doc_id, label 0 or 1).

    Covariances are shrunk towards the pooled one and then towards a sphere, in units of the pooled
    standard deviations. Every row with a label counts; ids with both labels count for both. Without
    rows of both classes the score of all documents is the share of class 1 (a half without labels).
    """
    rows = xs.join(labels.where("label IN (0, 1)").distinct(), "doc_id").select("x", F.col("label").cast("int").alias("label"))
    sums = _sums(rows)
    count = sums[:, 0, 0]
    log_odds = float(np.log((count[1] + 0.5) / (count[0] + 0.5)))
    if not count.all():
        return Discriminant(log_odds)
    means = sums[:, 0, 1:] / count[:, None]
    covariances = sums[:, 1:, 1:] / count[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (covariances * (count / count.sum())[:, None, None]).sum(axis=0)
    unit = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    factors, constants = [], []
    for own in covariances:
        mixed = ((1 - TO_POOLED) * own + TO_POOLED * pooled) / np.outer(unit, unit)
        mixed = (1 - TO_SPHERE) * mixed + TO_SPHERE * max(np.trace(mixed) / len(unit), 1e-3) * np.eye(len(unit))
        factors.append(np.linalg.cholesky(mixed) * unit[:, None])
        constants.append(-np.log(np.diag(factors[-1])).sum())
    return Discriminant(log_odds, means, np.array(factors), np.array(constants))


def scored(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs``, learnt from ``labels`` (doc_id, quality).

    Only the statistics of the text enter a score. Labels of the held-out fold, null labels and
    labels without a document are not learnt from. Null and empty texts are scored as texts without words.
    """
    xs = stage(features(docs, id_column, text_column), "features")
    known = labels.where(~held_out()).select("doc_id", F.col("quality").alias("label"))
    model = fit(xs, known)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch["x"].flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.scores(x))], ["doc_id", "score"])

    scores = xs.mapInArrow(work, SCORES)
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier learnt from ``labels`` predicts to be of good quality.

    The statistics are computed twice, to learn and to score, which spares shuffling the texts.
    """
    known = labels.where(~held_out()).select("doc_id", F.col("quality").alias("label"))
    model = fit(features(docs, id_column, text_column), known)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_column):
            yield batch.filter(pa.array(model.scores(_features(batch[text_column])) >= THRESHOLD))

    return docs.mapInArrow(work, docs.schema)
