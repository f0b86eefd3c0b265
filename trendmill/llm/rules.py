"""Quality rules as weak supervision: rules vote or abstain, and their accuracies are estimated from the votes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmill.llm.words import Words, per_slice, texts_only
from trendmill.session import stage

# The characters that count as symbols, and frequent short words of the four languages.
SYMBOLS = b"[#*$%&|<>]".strip(b"[]")
FREQUENT = (
    "the of and to in is that for it as with was on are be this by at an from "
    "le la les de des du un une et en est que qui dans pour pas sur au avec ce "
    "der die das und ist von zu den mit auf nicht ein eine im dem für als auch sich "
    "el los las que y por con no una su para es al lo como del se"
).split()

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines", "n_upper", "n_letters", "n_loud", "n_frequent", "n_noisy"]
STATS_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), *(T.StructField(name, T.LongType()) for name in STATS)])

#: Rules: the share that a rule looks at, up to where it votes for good quality, and from where it votes against.
#: Between the two, and without anything to look at, it abstains. A rule with the ends swapped wants large shares.
RULES = {
    "symbols": ("n_symbols / n_words", 0.02, 0.10),
    "letters": ("n_letters / word_chars", 0.90, 0.80),
    "noisy_words": ("n_noisy / n_words", 0.05, 0.20),
    "same_lines": ("n_dup_lines / n_lines", 0.05, 0.30),
    "same_words": ("n_repeat_words / n_words", 0.10, 0.40),
    "capitals": ("n_upper / n_letters", 0.15, 0.40),
    "ended_lines": ("n_ended_lines / n_lines", 0.60, 0.20),
    "loud": ("n_loud / n_words", 0.02, 0.20),
    "frequent_words": ("n_frequent / n_words", 0.10, 0.03),
}
MIN_WORDS = 50
SMOOTHING = 1.0  # votes of each kind that every rule is taken to have cast beforehand
PRIOR = 0.7  # of good quality, and the accuracy of every rule, to begin with
ROUNDS = 50

_CHARS = np.zeros(256, bool)
_CHARS[list(SYMBOLS)] = True


def _per_text(words: Words, hits: np.ndarray) -> np.ndarray:
    """How many of the ascending byte positions ``hits`` each text has."""
    return np.diff(np.searchsorted(hits, words.bounds))


def _repeated(codes: np.ndarray, words: Words) -> np.ndarray:
    """Words of each text in 3-word windows that it has twice or more."""
    begins = words.windows(3)
    text_of = words.text_of
    if not len(begins):
        return np.zeros(len(words.counts), np.int64)
    key = text_of[begins].astype(np.int64)
    for step in range(3):  # exact numbers for (text, word, word, word), made one word at a time
        key = np.unique(key * (int(codes.max()) + 1) + codes[begins + step], return_inverse=True)[1]
    again = begins[np.bincount(key)[key] > 1]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + 3, -1)
    covered = np.flatnonzero(np.cumsum(edge)[:-1] > 0)
    return np.bincount(text_of[covered], minlength=len(words.counts))


def _lines(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: lines with a word, those equal to an earlier one, and those that end a sentence."""
    data, bounds, n = words.data, words.bounds, len(words.counts)
    starts = np.union1d(bounds[:-1], np.flatnonzero(data == 10) + 1)
    starts = starts[starts < len(data)]
    if not len(starts):
        return (np.zeros(n, np.int64),) * 3
    ends = np.append(starts[1:], len(data))
    with_break = data[ends - 1] == 10
    lines = pa.Array.from_buffers(
        pa.large_binary(), len(starts),
        [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)],
    )
    first, beyond = np.searchsorted(words.starts, starts), np.searchsorted(words.starts, ends)
    full = np.flatnonzero(beyond > first)
    if not len(full):
        return (np.zeros(n, np.int64),) * 3
    text_of = np.searchsorted(bounds, starts[full], "right") - 1
    # A line is the same with and without the break that ends it: lines without one are the last of their text.
    bare = lines.to_numpy(zero_copy_only=False)[full]
    bare = [line[:-1] if broken else line for line, broken in zip(bare, with_break[full].tolist(), strict=True)]
    codes = pa.array(bare, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    distinct = np.unique(text_of * (codes.max() + 1) + codes) // (codes.max() + 1)
    count = np.bincount(text_of, minlength=n)
    last = data[words.ends[beyond[full] - 1] - 1]
    ended = np.isin(last, np.frombuffer(b".!?\"'):;", np.uint8))
    return count, count - np.bincount(distinct, minlength=n), np.bincount(text_of[ended], minlength=n)


def text_statistics(texts: pa.Array) -> list[np.ndarray]:
    """STATS of the texts, an array each."""
    words = Words(texts)
    data, n = words.data, len(texts)
    codes, distinct = words.codes()
    ranks = np.zeros(len(distinct) + 1, bool)
    ranks[:-1] = np.isin(np.array(distinct.to_pylist(), object), [word.encode() for word in FREQUENT]) if len(distinct) else []
    chars = np.flatnonzero(words._word & ((data & 0xC0) != 0x80))
    lines, same, ended = _lines(words)
    upper = (data >= 65) & (data <= 90)
    letters = upper | ((data >= 97) & (data <= 122)) | (data >= 0xC0)  # any character beyond ASCII counts as one
    plain = letters | (data >= 0x80) | ((data >= 48) & (data <= 57))
    inside = np.append(0, np.cumsum(plain))
    tail = words.ends - 1
    doubled = (words.ends - words.starts > 1) & ~plain[tail] & (data[tail] == data[tail - 1])
    noisy = doubled | (inside[words.ends] == inside[words.starts])  # as in "word***", or nothing but signs
    return [
        words.counts, _per_text(words, chars), _per_text(words, np.flatnonzero(_CHARS[data])), same,
        _repeated(codes, words) if len(words) else np.zeros(n, np.int64), lines, ended,
        _per_text(words, np.flatnonzero(upper)), _per_text(words, np.flatnonzero(letters)),
        _per_text(words, np.flatnonzero((data == 33) | (data == 63))),
        np.bincount(words.text_of[ranks[codes]], minlength=n), np.bincount(words.text_of[noisy], minlength=n),
    ]


def statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and STATS of each whole text; null has no words, and all its counts are zero."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = [pa.array(np.asarray(x).astype(np.int64)) for x in text_statistics(batch["text"])]
        return pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", *STATS])

    rows = texts_only(docs, id_column, text_column).withColumn("doc_id", F.col("doc_id").cast("long"))
    return per_slice(rows, "text", work, STATS_SCHEMA)


def vote(name: str) -> Column:
    """1, -1 or 0 for an abstention, of one of RULES."""
    share, good, bad = RULES[name]
    over, under = share.split(" / ")
    share = F.try_divide(F.col(over), F.col(under))
    if good < bad:
        says = F.when(share <= good, 1).when(share >= bad, -1)
    else:
        says = F.when(share >= good, 1).when(share <= bad, -1)
    return says.otherwise(0).cast("int").alias(f"vote_{name}")


def fit(votes: DataFrame) -> tuple[float, np.ndarray]:
    """Log odds of good quality before any vote, and those that each rule's vote of -1, 0 or 1 adds.

    Expectation-maximisation of two classes whose rules vote independently, over the counts of the
    vote patterns (at most 3 ** rules rows, which is what reaches the driver). What a rule's
    abstention says is estimated as well. A table without rows gives the starting values.
    """
    names = [f"vote_{name}" for name in RULES]
    rows = votes.groupBy(*names).agg(F.count("*").alias("n")).orderBy(*names).collect()
    said = np.array([[row[name] for name in names] for row in rows], int).reshape(-1, len(names)) + 1
    count = np.array([row["n"] for row in rows], float)
    start = np.log([(1 - PRIOR) / PRIOR, 1.0, PRIOR / (1 - PRIOR)])
    odds, weights = math.log(PRIOR / (1 - PRIOR)), np.tile(start, (len(names), 1))
    for _ in range(ROUNDS if len(count) else 0):
        good = 1 / (1 + np.exp(-(odds + weights[np.arange(len(names)), said].sum(axis=1))))
        share = np.zeros((2, len(names), 3))
        for c, part in enumerate((count * (1 - good), count * good)):
            for v in range(3):
                share[c, :, v] = SMOOTHING + ((said == v) * part[:, None]).sum(axis=0)
        share /= share.sum(axis=2, keepdims=True)
        weights = np.log(share[1] / share[0])
        odds = math.log((SMOOTHING + (count * good).sum()) / (SMOOTHING + (count * (1 - good)).sum()))
    return odds, weights


def judged(docs: DataFrame, threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, STATS, a vote per rule, base_failed, posterior and kept, of each row of ``docs``.

    base_failed: fewer than MIN_WORDS words, or more than half of them in repeated 3-word windows.
    posterior: probability of good quality given all votes; a row is kept if it is ``threshold`` or
    more and the base has not failed. The accuracies are estimated from the rows whose base has not
    failed.
    """
    stats = statistics(docs, id_column, text_column)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = stage(stats.select("*", failed.alias("base_failed"), *map(vote, RULES)), "votes")
    odds, weights = fit(rows.where(~F.col("base_failed")))
    total = F.lit(odds)
    for name, (against, nothing, good) in zip(RULES, weights.tolist(), strict=True):
        said = F.col(f"vote_{name}")
        total = total + F.when(said < 0, against).when(said > 0, good).otherwise(nothing)
    rows = rows.withColumn("posterior", 1 / (1 + F.exp(-total)))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
