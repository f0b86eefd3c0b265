"""Words of whole texts as numpy offsets, one small slice of an Arrow batch at a time.

A word is a maximal run of bytes other than ASCII white space, ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmill.session import configure

SLICE_BYTES = 1 << 20  # text per numpy step; temporaries are a few dozen times this
ROWS_PER_BATCH = 256

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators: small Arrow batches, whatever the length of the texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def give_back() -> None:
    """Return free memory of this worker to the system: workers live on, and what one stage leaves is missing in the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about ``limit`` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = (np.cumsum(size) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(start, end - start)
    give_back()


def larger_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """As ``slices``, but also putting small batches together, where work on few words costs as much as on many."""
    held, size = [], 0
    for part in slices(batches, column, limit):
        held.append(part)
        size += pc.sum(pc.binary_length(part[column])).as_py() or 0
        if size >= limit // 2 or sum(x.num_rows for x in held) >= 1 << 16:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def per_slice(df: DataFrame, column: str, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str) -> DataFrame:
    """Apply ``work`` to every slice of the rows, in the tasks that read them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(work, slices(batches, column))

    return df.mapInArrow(run, schema)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts in one array, and where each text begins; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


class Words:
    """The words of some texts.

    data, bounds: bytes and where each text begins. starts, ends: of each word in data.
    first: the number of the first word of each text, and of all words at its end.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        data, self.bounds = flat(texts)
        self.data = LOWER[data] if lower else data
        n = len(data)
        space = SPACE[data]
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        edges = self.bounds[:-1]
        before[edges[edges < n]] = True
        edges = self.bounds[1:] - 1
        after[edges[edges >= 0]] = True
        self._word = ~space
        self.starts = np.flatnonzero(self._word & before)
        self.ends = np.flatnonzero(self._word & after) + 1
        self.first = np.searchsorted(self.starts, self.bounds)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        """The number of the text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        """An exact number for each word, and the distinct words these numbers stand for."""
        offsets = np.zeros(len(self) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=offsets[1:])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(self.data[self._word])]
        coded = pa.Array.from_buffers(pa.large_binary(), len(self), buffers).dictionary_encode()
        return coded.indices.to_numpy(), coded.dictionary

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words of each text joined by one space: bytes, and where each word starts and ends there."""
        keep = self._word.copy()
        keep[self.ends[self.ends < len(keep)]] = True
        place = np.cumsum(keep) - 1
        starts = place[self.starts] if len(self) else self.starts
        text = np.where(self._word, self.data, np.uint8(32))[keep]
        return text, starts, starts + (self.ends - self.starts)

    def windows(self, size: int, short: bool = False) -> np.ndarray:
        """Numbers of the words with which a window of ``size`` words of one text begins.

        short: a text of fewer words, but not none, has one window.
        """
        last = np.repeat(self.first[1:], self.counts)
        begins = np.arange(len(self))
        whole = begins + size <= last
        if short:
            whole |= begins == np.repeat(self.first[:-1], self.counts)
        return np.flatnonzero(whole)


def texts_only(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Id and text under fixed names, so that other columns may have any name."""
    return df.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
