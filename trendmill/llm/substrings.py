"""Removal of word windows that occurred before, with a count-min sketch ahead of the exact grouping."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmill.llm.words import Words, slices, texts_only
from trendmill.session import stage

BLOCK_BITS = 16  # counters of a row in one block of the sketch: 2 ** BLOCK_BITS
MAX_BLOCKS = 1 << 12  # so that the two rows of bits which are broadcast have 64 MB at most
BYTES_PER_ANCHOR = 48  # text for which the sketch gets COUNTERS counters a row
COUNTERS = 6
HELD = 1 << 20  # anchors a task gathers before it sends them on

BLOCKS = "block INT, counts BINARY"
KEPT = "doc_id BIGINT, n_words BIGINT, n_removed BIGINT, kept STRING"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best of each ``width`` neighbours, from spans that double in length."""
    span = 1
    total = len(x) - width + 1
    while 2 * span <= width:
        x = best(x[:-span], x[span:])
        span *= 2
    return best(x[:total], x[width - span : width - span + total])


class _Windows:
    """The windows of the texts of a slice, and the anchor of each: the smallest hash of its grams.

    A gram is a run of ``gram`` words. Equal windows have equal anchors, each at a place of its own,
    so an anchor occurs at least as often as any window around it; neighbours mostly share theirs,
    which leaves few anchors to count.
    """

    def __init__(self, texts: pa.Array, size: int, gram: int):
        self.words = words = Words(texts)
        self.begins = words.windows(size)
        self.anchors = self.counted = np.empty(0, np.uint64)
        if not len(self.begins):
            return
        codes, distinct = words.codes()
        digest = xxhash.xxh64_intdigest
        of_word = np.array([digest(word) for word in distinct.to_pylist()], np.uint64)
        power = np.cumprod(np.full(len(words), _ODD))
        inverse = np.cumprod(np.full(len(words), np.uint64(pow(int(_ODD), -1, 1 << 64))))
        total = np.append(np.uint64(0), np.cumsum(of_word[codes] * power))
        grams = _mixed((total[gram:] - total[:-gram]) * inverse[: len(words) - gram + 1])
        width = size - gram + 1
        lowest = _sliding(grams, width, np.minimum)
        self.anchors = lowest[self.begins]
        # A gram is an anchor if it is the lowest of one of the windows around it that lie in one text.
        around = np.zeros(len(grams) + width - 1, np.uint64)
        around[self.begins + width - 1] = self.anchors
        self.counted = grams[_sliding(around, width, np.maximum) == grams]


def _places(anchors: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block of the sketch, and the counter of each of its two rows."""
    again = _mixed(anchors + _ODD)
    mask = np.uint64((1 << BLOCK_BITS) - 1)
    return (again >> np.uint64(40)) % np.uint64(blocks), anchors & mask, (anchors >> np.uint64(BLOCK_BITS)) & mask


def _sketched(rows: DataFrame, size: int, gram: int, blocks: int) -> list:
    """The merged sketch: for each block, a bit per counter that has reached two.

    Every task sends its anchors, at most twice each, as packed counter numbers by block; the tasks
    that merge add them up in counters that stop at two. No task holds more than its blocks.
    """

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        anchors, count = np.unique(np.concatenate(held), return_counts=True)
        block, one, two = _places(np.concatenate([anchors, anchors[count > 1]]), blocks)
        order = np.argsort(block, kind="stable")
        pairs = np.stack([one, two], axis=1).astype(np.uint16)[order]
        own, start = np.unique(block[order], return_index=True)
        parts = [x.tobytes() for x in np.split(pairs, start[1:])]
        return pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(parts, pa.binary())], ["block", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [np.empty(0, np.uint64)], 0
        for batch in slices(batches, "text"):
            held.append(_Windows(batch["text"], size, gram).counted)
            n += len(held[-1])
            if n >= HELD:
                yield packed(held)
                held, n = [np.empty(0, np.uint64)], 0
        if n:
            yield packed(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch["block"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                rows = counters.setdefault(block, np.zeros((2, 1 << BLOCK_BITS), np.uint8))
                pairs = np.frombuffer(counts, np.uint16).reshape(-1, 2)
                for row in range(2):
                    found, n = np.unique(pairs[:, row], return_counts=True)
                    rows[row, found] = np.minimum(2, rows[row, found] + np.minimum(n, 2))
        for block, rows in counters.items():
            bits = [np.packbits(rows >= 2, axis=1).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array(bits, pa.binary())], ["block", "counts"])

    sent = rows.select("text").mapInArrow(count, BLOCKS).repartition("block")
    return sent.mapInArrow(merge, BLOCKS).collect()


class Sketch:
    """Which windows may be repeated: the broadcast bit per counter of the merged sketch, and its measures."""

    def __init__(self, bits: Broadcast, size: int, gram: int):
        self.bits, self.size, self.gram = bits, size, gram

    def windows(self, texts: pa.Array) -> tuple[Words, np.ndarray]:
        """The words of the texts, and with which of them a window begins that may be repeated."""
        bits = self.bits.value
        windows = _Windows(texts, self.size, self.gram)
        block, *places = _places(windows.anchors, len(bits))
        often = np.ones(len(block), bool)
        for row, place in enumerate(places):
            byte = bits[block, row, place >> np.uint64(3)]
            often &= (byte >> (np.uint8(7) - (place & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
        return windows.words, windows.begins[often]


def sketch(rows: DataFrame, size: int = 20, gram: int = 8) -> Sketch:
    """The sketch of all windows of the column text, on its way to the tasks.

    It never counts too low, so no repeated window is missing. Its size follows the text up to
    MAX_BLOCKS; over still more text it lets more windows pass that are not repeated, up to all,
    which costs time and changes no result.
    """
    text_bytes = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    wanted = COUNTERS * text_bytes / BYTES_PER_ANCHOR / (1 << BLOCK_BITS)
    blocks = min(MAX_BLOCKS, 1 << max(0, math.ceil(math.log2(max(1, wanted)))))
    bits = np.zeros((blocks, 2, (1 << BLOCK_BITS) // 8), np.uint8)
    for block, counts in _sketched(rows, size, gram, blocks):
        bits[block] = np.frombuffer(counts, np.uint8).reshape(2, -1)
    return Sketch(rows.sparkSession.sparkContext.broadcast(bits), size, gram)


def _keyed(rows: DataFrame, found: Sketch) -> DataFrame:
    """A row for each window that may be repeated: 96 bits of XXH3 of its words, and where it is."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in slices(batches, "text"):
            words, begins = found.windows(batch["text"])
            if not len(begins):
                continue
            text, starts, ends = words.joined()
            view = memoryview(text)
            spans = zip(starts[begins].tolist(), ends[begins + found.size - 1].tolist(), strict=True)
            keys = np.frombuffer(b"".join([digest(view[s:e]) for s, e in spans]), ">i4").reshape(-1, 4).astype(np.int64)
            text_of = words.text_of[begins]
            at = (begins - words.first[text_of]).astype(np.int64)
            variant = batch["variant"].to_numpy()[text_of]
            arrays = [keys[:, 0] << 32 | keys[:, 1] & 0xFFFFFFFF, keys[:, 2].astype(np.int32), batch["place"].to_numpy()[text_of], at << 32 | variant]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["high", "low", "place", "at"])

    return rows.select("place", "variant", "text").mapInArrow(work, "high BIGINT, low INT, place BIGINT, at BIGINT")


def _kept(rows: DataFrame, found: Sketch) -> DataFrame:
    """What is left of each text without the windows that may be repeated and do not begin at ``first``."""
    fields = ["doc_id", "n_words", "n_removed", "kept"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = found.size
        for batch in slices(batches, "text"):
            words, begins = found.windows(batch["text"])
            later = np.zeros(len(words) + 1, np.int64)
            later[begins] = 1
            lengths = pc.fill_null(pc.list_value_length(batch["first"]), 0).to_numpy(zero_copy_only=False)
            later[batch["first"].flatten().to_numpy() + np.repeat(words.first[:-1], lengths)] = 0
            edge = later.copy()
            edge[size:] -= later[:-size] if len(later) > size else 0
            gone = np.cumsum(edge)[:-1] > 0
            removed = np.diff(np.append(0, np.cumsum(gone))[words.first])
            text, starts, ends = words.joined()
            whole, kept = text.tobytes(), []
            for i in range(batch.num_rows):
                start, beyond = words.first[i], words.first[i + 1]
                if not removed[i]:
                    kept.append(whole[starts[start] : ends[beyond - 1]] if start < beyond else b"")
                else:
                    stay = start + np.flatnonzero(~gone[start:beyond])
                    pairs = zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)
                    kept.append(b" ".join([whole[s:e] for s, e in pairs]))
            arrays = [batch["doc_id"], pa.array(words.counts), pa.array(removed), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, fields)

    return rows.select("doc_id", "text", "first").mapInArrow(work, KEPT)


def without_repeats(docs: DataFrame, size: int = 20, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept, the words that stay joined by one space, for each row of ``docs``.

    Removed is every word in a window of ``size`` words whose words also begin earlier: in a
    document of smaller id (null comes last, as the largest number would) or further up in the same
    one. Windows are those of the whole input texts. Of rows that repeat an id with other texts, the
    one further up is the first, and then that with the smaller hash of its text; rows that repeat
    id and text are treated alike. Null text has no words.

    The windows that the sketch lets pass are grouped once, for the first place of each. All others
    of them are later ones, so only the first places go back to the documents.
    """
    doc_id = F.col("doc_id").cast("long")
    rows = texts_only(docs, id_column, text_column).select(
        doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit((1 << 63) - 1)).alias("place"),
        F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)).alias("variant"), F.coalesce("text", F.lit("")).alias("text"),
    )
    found = sketch(rows, size)
    first = _keyed(rows, found).groupBy("high", "low").agg(F.min(F.struct("place", "at")).alias("first"))
    marks = first.select(
        F.col("first.place").alias("place"), F.col("first.at").bitwiseAND(F.lit(0xFFFFFFFF)).alias("variant"),
        F.shiftright("first.at", 32).cast("int").alias("at"),
    )
    marks = stage(marks.groupBy("place", "variant").agg(F.collect_list("at").alias("first")), "first")
    return _kept(rows.join(marks, ["place", "variant"], "left"), found)
