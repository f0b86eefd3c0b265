"""Benchmark passages in documents, also with other numbers, names and units, by typed templates."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmill.llm.words import LOWER, Words, slices, texts_only
from trendmill.session import stage

SIZE = 8  # words of a window
ENOUGH = 12  # words of an item in a document, or all words of a shorter item
FILTER_BITS = 28  # size of the filter that is broadcast, as a power of two: 32 MB

# Words that stand for a number, and units that follow one.
NUMBERS = "zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split()
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs oz pound pounds ounce ounces gram grams "
    "kilogram kilograms ml l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours "
    "day days week weeks month months year years mph kmh km/h m/s hz khz mhz ghz w kw j kj v a pa kpa bar c f k percent "
    "cent cents dollar dollars euro euros usd eur gbp $ meter meters metre metres kilometer kilometers"
).split()
LITERAL, NUMBER, QUANTITY, NAME, UNIT = range(5)

WINDOWS = "id BIGINT, text_hash BIGINT, at INT, size INT, key BIGINT, slots ARRAY<BIGINT>, n_words INT"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


_OF_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
_OF_KIND = _mixed(np.arange(1001, 1006, dtype=np.uint64) * _ODD)
_DIGIT, _UPPER, _LOWER_CASE, _WORD, _STOP = (np.zeros(256, bool) for _ in range(5))
_DIGIT[48:58] = _UPPER[65:91] = _LOWER_CASE[97:123] = True
_WORD[128:] = True
_WORD |= _DIGIT | _UPPER | _LOWER_CASE
_STOP[list(b".!?:;")] = True


def _sums(x: np.ndarray) -> np.ndarray:
    return np.append(x.dtype.type(0), np.cumsum(x, dtype=x.dtype))


def _runs(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each stretch from start to end; equal stretches have equal hashes wherever they are."""
    total = _sums(hashes * np.cumprod(np.full(len(hashes), _ODD)))
    back = np.append(np.uint64(1), np.cumprod(np.full(len(hashes), _INVERSE)))
    return _mixed((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def _listed(words: list[str]) -> np.ndarray:
    """The hashes that ``Templates`` gives these words as literals."""
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(word.encode()) for word in words])
    return _runs(_OF_BYTE[data], np.append(0, ends[:-1]), ends)


class Templates:
    """The words of some texts without signs around them, each a literal in lower case or a slot.

    Slots are numbers (digits without letters, or a word for one), quantities (digits with a short
    unit), units that follow a number, and names (capitalised words within a sentence).
    first: number of the first word of each text; value: hash of each word; kind; code: value of a
    literal, or what its kind has instead.
    """

    def __init__(self, texts: pa.Array):
        words = Words(texts)
        data = words.data
        latin = np.zeros(len(data), bool)  # second bytes of two-byte letters that have two cases
        latin[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        large, small = _UPPER[data], _LOWER_CASE[data]
        large |= latin & (data < 0x9F)
        small |= latin & (data >= 0xA0)
        plain = np.where(latin & large, data | 0x20, LOWER[data])

        inside = np.flatnonzero(_WORD[data])
        before = _sums(_WORD[data].astype(np.int64))
        kept = np.flatnonzero(before[words.ends] > before[words.starts])
        starts, ends = inside[before[words.starts[kept]]], inside[before[words.ends[kept]] - 1] + 1
        text_of = words.text_of[kept]
        self.first = np.searchsorted(text_of, np.arange(len(texts) + 1))

        digits, capitals, lowers = (_sums(x.astype(np.int64)) for x in (_DIGIT[data], large, small))
        breaks = _sums((data == 10).astype(np.int64))
        signs = before[ends] - before[starts]
        n_digits = digits[ends] - digits[starts]
        self.value = _runs(_OF_BYTE[plain], starts, ends)

        opens = np.ones(len(kept), bool)  # a sentence
        opens[1:] = (text_of[1:] != text_of[:-1]) | (breaks[starts[1:]] > breaks[ends[:-1]])
        opens[1:] |= _STOP[data[words.ends[kept[:-1]] - 1]]
        lead = starts + (data[starts] == 0xC3) if len(starts) else starts
        name = large[lead] & (lowers[ends] > lowers[starts]) & ~opens
        number = (n_digits == signs) | np.isin(self.value, _listed(NUMBERS))
        quantity = (n_digits > 0) & ~number & _DIGIT[data[starts]] & (signs - n_digits <= 3)
        unit = np.zeros(len(kept), bool)
        unit[1:] = number[:-1] & (text_of[1:] == text_of[:-1]) & np.isin(self.value[1:], _listed(UNITS))
        self.kind = np.select([number, quantity, unit, name], [NUMBER, QUANTITY, UNIT, NAME], LITERAL)
        self.code = np.where(self.kind == LITERAL, self.value, _OF_KIND[self.kind])

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """With which words windows of ``size`` words begin, their keys, and which of these are of the words' values.

        Windows with at least half literals have the key of their template, and all that have a slot
        also that of their values, which is the template's key where the same words are literals.
        """
        begins = np.arange(max(0, len(self.code) - size + 1))
        beyond = np.repeat(self.first[1:], np.diff(self.first))[: len(begins)]
        begins = begins[begins + size <= beyond]
        literal = _sums((self.kind == LITERAL).astype(np.int64))
        literals = literal[begins + size] - literal[begins]
        typed, exact = begins[2 * literals >= size], begins[literals < size]
        keys = np.append(_runs(self.code, typed, typed + size), _runs(self.value, exact, exact + size))
        return np.append(typed, exact), keys, np.repeat([False, True], [len(typed), len(exact)])

    def rows(self, batch: pa.RecordBatch, size: int, begins: np.ndarray, keys: np.ndarray, exact: np.ndarray) -> pa.RecordBatch:
        text_of = np.searchsorted(self.first, begins, "right") - 1
        slot = np.flatnonzero(self.kind != LITERAL)
        low = np.searchsorted(slot, begins)
        high = np.where(exact, low, np.searchsorted(slot, begins + size))
        bounds = np.append(0, np.cumsum(high - low))
        picked = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - low, high - low)
        slots = pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(self.value[slot[picked]].view(np.int64)))
        n = np.diff(self.first)[text_of]
        arrays = [
            batch["id"].take(pa.array(text_of)), batch["text_hash"].take(pa.array(text_of)),
            pa.array((begins - self.first[text_of]).astype(np.int32)), pa.array(np.full(len(begins), size, np.int32)),
            pa.array(keys.view(np.int64)), slots, pa.array(n.astype(np.int32)),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["id", "text_hash", "at", "size", "key", "slots", "n_words"])


def _texts(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    rows = texts_only(df, id_column, text_column)
    return rows.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("text_hash"), "text")


def item_windows(items: DataFrame, size: int = SIZE, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """All windows of the items; an item of fewer words is one window of all of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            templates = Templates(batch["text"])
            lengths = np.diff(templates.first)
            for own in {size, *lengths[lengths < size].tolist()} - {0}:
                begins, keys, exact = templates.windows(own)
                whole = np.minimum(lengths, size)[np.searchsorted(templates.first, begins, "right") - 1] == own
                yield templates.rows(batch, own, begins[whole], keys[whole], exact[whole])

    return _texts(items, id_column, text_column).mapInArrow(work, WINDOWS)


def document_windows(docs: DataFrame, sizes: Iterable[int], bits: Broadcast, id_column: str, text_column: str) -> DataFrame:
    """The windows of the documents that the filter lets pass."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = bits.value
        for batch in slices(batches, "text"):
            templates = Templates(batch["text"])
            for size in sizes:
                begins, keys, exact = templates.windows(size)
                place = keys & np.uint64((1 << FILTER_BITS) - 1)
                hit = (wanted[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                if hit.any():
                    yield templates.rows(batch, size, begins[hit], keys[hit], exact[hit])

    return _texts(docs, id_column, text_column).mapInArrow(work, WINDOWS)


def _filter(windows: DataFrame) -> np.ndarray:
    """A bit for each key of the windows, of FILTER_BITS bits whatever their number, put together in the cluster."""
    place = F.col("key").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) + 1
    bitmaps = windows.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for bucket, own in bitmaps.collect():
        bits[(bucket - 1) * len(own) : bucket * len(own)] = np.frombuffer(own, np.uint8)
    return bits


def matches(
    docs: DataFrame, items: DataFrame, size: int = SIZE, enough: int = ENOUGH,
    id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """doc_id, text_hash, item_id, at, end, item_words, covered, n_changed, kind of each passage found.

    A passage is made of windows at one offset between a document and an item. All windows are
    found with the item's own words, in whatever case and surroundings, and those with at least half
    literals also with other values. Its slots are
    consistent if every value of the item has one value in the document throughout. Then all its
    windows count, and otherwise those whose slots are as in the item; covered is the number of the
    item's words in them, and passages of ``enough`` words, or all words of a shorter item, are
    returned. kind is verbatim, or reparameterised if slots have other values (n_changed of them).
    at and end number the document's words that have a letter or digit. The document windows first
    pass a filter of the items' keys, which lets through all that the join then finds. Null and
    empty texts match nothing; rows that repeat an id and text give the same passages once; null
    ids are kept as such.
    """
    wanted = stage(item_windows(items, size, item_column, item_text), "items")
    sizes = sorted(row["size"] for row in wanted.select("size").distinct().collect())  # at most ``size`` of them
    bits = docs.sparkSession.sparkContext.broadcast(_filter(wanted))
    seen = document_windows(docs, sizes, bits, id_column, text_column)
    seen = seen.select(F.col("id").alias("doc_id"), "text_hash", F.col("at").alias("doc_at"), "key", F.col("slots").alias("doc_slots"))
    pairs = seen.join(wanted.drop("text_hash"), "key").where(F.size("slots") == F.size("doc_slots"))
    same = F.col("slots") == F.col("doc_slots")
    words = F.sequence(F.col("at"), F.col("at") + F.col("size") - 1)
    passages = pairs.groupBy("doc_id", "text_hash", F.col("id").alias("item_id"), (F.col("doc_at") - F.col("at")).alias("offset")).agg(
        F.max("n_words").alias("item_words"),
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("slots", "doc_slots")))).alias("values"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(words)))).alias("all_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(same, words))))).alias("same_words"),
    )
    changed = F.filter("values", lambda x: x["slots"] != x["doc_slots"])
    consistent = F.size(F.array_distinct(F.col("values.slots"))) == F.size("values")
    passages = passages.withColumn("words", F.when(consistent, F.col("all_words")).otherwise(F.col("same_words")))
    passages = passages.withColumn("n_changed", F.when(consistent, F.size(changed)).otherwise(0))
    return passages.where(F.size("words") >= F.least(F.lit(enough), "item_words")).select(
        "doc_id", "text_hash", "item_id", (F.array_min("words") + F.col("offset")).alias("at"),
        (F.array_max("words") + F.col("offset") + 1).alias("end"), "item_words", F.size("words").alias("covered"), "n_changed",
        F.when(F.col("n_changed") > 0, "reparameterised").otherwise("verbatim").alias("kind"),
    )


def without_matches(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", **columns) -> DataFrame:
    """The rows of ``docs``, all columns, in which ``matches`` finds no passage of the items."""
    found = matches(docs, items, id_column=id_column, text_column=text_column, **columns)
    found = stage(found.select(F.col("doc_id").alias("id"), "text_hash").distinct(), "matches")
    own_id, own_hash = docs[f"`{id_column}`"].cast("long"), F.xxhash64(docs[f"`{text_column}`"].cast("string"))
    return docs.join(found, own_id.eqNullSafe(found["id"]) & (own_hash == found["text_hash"]), "left_anti")
