"""Near-duplicates by SimHash with deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmill.llm.components import components
from trendmill.llm.words import Words, per_slice, texts_only
from trendmill.session import stage

BITS = 64
SEED = 42
BLOCK = 2048  # fingerprints of a group that are compared with each other at once
ROWS_HELD = 1 << 15
SHINGLES_AT_ONCE = 1 << 17

FINGERPRINTS = T.StructType().add("doc_id", T.LongType()).add("text_hash", T.LongType()).add("fp", T.LongType())
LINKS = T.StructType().add("a", T.LongType()).add("b", T.LongType())


def shingle_hashes(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each shingle, and the number of the text that it is of."""
    words = Words(texts, lower=True)
    text, starts, ends = words.joined()
    begins = words.windows(size, short=True)
    if not len(begins):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    text_of = words.text_of[begins]
    finish = ends[np.minimum(begins + size, words.first[1:][text_of]) - 1]
    view, digest = memoryview(text), xxhash.xxh64_intdigest
    spans = zip(starts[begins].tolist(), finish.tolist(), strict=True)
    return np.array([digest(view[s:e], SEED) for s, e in spans], np.uint64), text_of


def majority(hashes: np.ndarray, text_of: np.ndarray, n: int) -> np.ndarray:
    """For each of n texts the bits that more than half of its hashes have."""
    count = np.bincount(text_of, minlength=n)
    ones = np.zeros((n, BITS), np.int64)
    for at in range(0, len(hashes), SHINGLES_AT_ONCE):
        some = slice(at, at + SHINGLES_AT_ONCE)
        bits = np.unpackbits(hashes[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own, first = np.unique(text_of[some], return_index=True)
        ones[own] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > count[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]


def _fingerprints(texts: pa.Array, size: int) -> np.ndarray:
    return majority(*shingle_hashes(texts, size), len(texts))


def fingerprints(docs: DataFrame, size: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, text_hash (XXH64 of the text) and fp, the 64-bit fingerprint as a signed long.

    Words are lower-cased for A-Z only; shingles have ``size`` words and count as often as they
    occur; a shorter text is one shingle. A bit is set if more than half of the XXH64 values have
    it. Null and wordless texts have fingerprint zero.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = pa.array(_fingerprints(batch["text"], size).view(np.int64))
        return pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_hash"], fp], ["doc_id", "text_hash", "fp"])

    rows = texts_only(docs, id_column, text_column).select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text"
    )
    return per_slice(rows, "text", work, FINGERPRINTS)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """First bit and end of so few segments (two at least) that one of them differs in one bit at most."""
    n = max(2, max_bits // 2 + 1)
    cuts = [round(i * BITS / n) for i in range(n + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _variant(max_bits: int) -> Column:
    """The key of the variant that leaves out bit ``bit``: the other bits of its segment, and the bit's number."""
    key = F.lit(None).cast("long")
    for start, end in segments(max_bits):
        rest = F.expr(f"shiftrightunsigned(fp, {start}) & {(1 << (end - start)) - 1}")
        rest = rest.bitwiseAND(F.expr(f"~shiftleft(1L, CAST(bit AS INT) - {start})"))
        key = F.when((F.col("bit") >= start) & (F.col("bit") < end), F.shiftleft(rest, 6).bitwiseOR(F.col("bit"))).otherwise(key)
    return key


def _apart(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.bitwise_count((left ^ right).view(np.uint64))  # of signed numbers it would count the absolute value


def _linked(values: np.ndarray, sizes: np.ndarray, others: np.ndarray, other_sizes: np.ndarray, max_bits: int) -> Iterator[np.ndarray]:
    """Links that connect what is within ``max_bits`` in each group, a spanning forest of it at most.

    A group compares its values with its others, or with themselves where it has no others.
    """
    at = np.concatenate(([0], np.cumsum(sizes)))
    at_other = np.concatenate(([0], np.cumsum(other_sizes)))
    small = (other_sizes == 0) & (sizes <= 16)
    groups = np.repeat(np.where(small, np.arange(len(sizes)), -1 - np.arange(len(sizes))), sizes)
    for step in range(1, int(sizes[small].max(initial=0))):  # many small groups at once
        left, right = values[:-step], values[step:]
        near = (groups[:-step] == groups[step:]) & (groups[step:] >= 0) & (_apart(left, right) <= max_bits)
        yield np.stack([left[near], right[near]])
    for g in np.flatnonzero(~small):
        own = values[at[g] : at[g + 1]]
        yield _forest(own, others[at_other[g] : at_other[g + 1]], max_bits)


def _forest(own: np.ndarray, others: np.ndarray, max_bits: int) -> np.ndarray:
    """A spanning forest of the links between own and others (within own, if there are no others)."""
    nodes = np.concatenate([own, others])
    root = np.arange(len(nodes))
    out = []

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    shift = len(own) if len(others) else 0
    for i in range(len(own)):
        against = nodes[shift or i + 1 :]
        near = np.flatnonzero(_apart(against, own[i]) <= max_bits) + (shift or i + 1)
        mine = top(i)
        for j in near[root[near] != mine].tolist():
            if (theirs := top(j)) != mine:
                out.append((nodes[i], nodes[j]))
                root[theirs] = mine
            root[j] = mine
    return np.array(out, np.int64).reshape(-1, 2).T


def links(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """a, b: links that connect all fingerprints (column fp, distinct) of at most ``max_bits`` difference.

    Every fingerprint is indexed by 64 variants, each of which leaves out one bit of one segment.
    Two fingerprints within the distance share a variant. Groups of one variant are compared in
    blocks of BLOCK: a group of b blocks becomes b * (b + 1) / 2 rows of at most two blocks, so no
    task ever holds a whole large group, and each yields a spanning forest instead of all pairs.
    """
    key = _variant(max_bits).alias("key")
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    variants = distinct.repartition(n, "fp").select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("bit")).select("fp", key)
    counts = variants.groupBy("key").agg(F.count("*").alias("n"))
    large = stage(counts.where(F.col("n") > BLOCK), "large")
    one = F.lit(0)
    rows = variants.join(large, "key", "left_anti").select("key", one.alias("i"), one.alias("j"), one.alias("side"), "fp")
    if not large.isEmpty():
        rows = rows.unionByName(blocked(variants.join(large, "key")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (fp,), sizes, n_others in groups(batches):
            at = np.repeat(n_others, sizes)
            place = np.arange(len(fp)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            other = place >= np.repeat(sizes, sizes) - at
            found = list(_linked(fp[~other], sizes - n_others, fp[other], n_others, max_bits))
            pairs = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
            pairs = np.unique(np.sort(pairs, axis=0), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[1]), pa.array(pairs[0])], ["a", "b"])

    dealt = rows.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j", "side")
    return dealt.mapInArrow(compare, LINKS).distinct()


def groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...] = ("fp",)) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Columns ``names`` of whole groups out of sorted rows, some tens of thousands at a time, with the
    size of each group and how many of its rows, the last ones, are of side 1."""
    held, n = [], 0

    def whole(last: bool) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
        nonlocal held, n
        columns = [np.concatenate([part[c] for part in held]) for c in range(4 + len(names))]
        key, i, j, side = columns[:4]
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
        end = len(key) if last else starts[-1]  # the last group may go on
        held, n = [[x[end:] for x in columns]], len(key) - end
        starts = starts[starts < end]
        if len(starts):
            sizes = np.diff(np.append(starts, end))
            some = sizes > 1
            keep = np.repeat(some, sizes)
            yield [x[:end][keep] for x in columns[4:]], sizes[some], np.add.reduceat(side[:end].astype(np.int64), starts)[some]

    for batch in batches:
        if batch.num_rows:
            held.append([batch[name].to_numpy() for name in ("key", "i", "j", "side", *names)])
            n += batch.num_rows
            if n >= ROWS_HELD:
                yield from whole(last=False)
    if n:
        yield from whole(last=True)


def blocked(hot: DataFrame, names: tuple[str, ...] = ("fp",), size: str = "n") -> DataFrame:
    """Rows of large groups, once for each pair of blocks that they are in; a block's pair with itself has side 0 alone."""
    blocks = F.ceil(F.col(size) / (BLOCK // 2)).cast("int")
    rows = hot.select("key", *names, blocks.alias("blocks"), F.pmod(F.xxhash64(names[0]), blocks).cast("int").alias("block"))
    pair = F.expr("transform(sequence(0, blocks - 1), x -> struct(least(x, block) AS i, greatest(x, block) AS j))")
    rows = rows.select("key", *names, "block", F.explode(pair).alias("at"))
    side = ((F.col("block") == F.col("at.j")) & (F.col("at.i") != F.col("at.j"))).cast("int")
    return rows.select("key", "at.i", "at.j", side.alias("side"), *names)


def near_duplicates(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """The rows of ``fingerprints`` with component_id: the smallest doc_id reachable over links.

    Fingerprints link at ``max_bits`` differing bits or fewer; equal ones always do. Rows without a
    doc_id belong to a component as any other, but do not name it; one with no doc_id at all has a
    null component_id. component is the smallest fingerprint, which also tells such groups apart.
    """
    prints = stage(prints, "prints")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "distinct")
    roots = components(links(distinct.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    named = stage(distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "roots")
    first = stage(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "components")
    named = stage(named.join(first, "root").select("fp", F.col("root").alias("component"), "component_id"), "named")
    return prints.join(named, "fp")


def hex_digits(fp: str = "fp") -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, size: int = 5, max_bits: int = 7, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest id (null: last).

    Of rows with the same id in a group, the one with the smallest hash of its text stays, and of
    rows that repeat id and text, one. All columns are kept.
    """
    return first_of_each(docs, near_duplicates(fingerprints(docs, size, id_column, text_column), max_bits), id_column, text_column)


def first_of_each(docs: DataFrame, marked: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``docs`` with the first row of each component of ``marked`` (doc_id, text_hash, component), as ``keep_one`` says."""
    counted = marked.groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
    order = F.struct(F.isnull("doc_id"), "doc_id", "text_hash")
    kept = counted.groupBy("component").agg(F.min_by(F.struct("doc_id", "text_hash", "copies"), order).alias("kept"))
    kept = stage(kept.select("kept"), "kept")
    own_id, own_hash = docs[f"`{id_column}`"].cast("long"), F.xxhash64(docs[f"`{text_column}`"].cast("string"))
    rows = docs.join(kept, own_id.eqNullSafe(kept["kept.doc_id"]) & (own_hash == kept["kept.text_hash"]))
    once = rows.where(kept["kept.copies"] == 1).select(docs["*"])
    again = rows.where(kept["kept.copies"] > 1).dropDuplicates([id_column, text_column]).select(docs["*"])
    return once.unionByName(again)
