"""Licence scans: identifier tags and notice phrases by Aho-Corasick, licence expressions by a shunting-yard parser.

A word is a maximal run of bytes that are letters, digits or not ASCII, after lower-casing A-Z. Phrases are found
where their words stand one after the other, whatever is between the words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmill.llm.words import LOWER, flat, slices, texts_only

# The phrases every scan must find, with their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Further notice phrases, with their labels.
NOTICES = {
    "mit license": "mit",
    "mit licence": "mit",
    "permission is hereby granted free of charge": "mit",
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "apache license 2 0": "apache-2.0",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "boost software license": "bsl-1.0",
    "the unlicense": "unlicense",
    "free and unencumbered software": "unlicense",
    "public domain": "public-domain",
    "cc0": "cc0-1.0",
    "mozilla public license": "mpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "eclipse public license": "epl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "lesser general public license": "lgpl",
    "gnu lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "gnu affero general public license": "agpl",
    "cc by 4 0": "cc-by-4.0",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc": "cc-by-nc",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "proprietary and confidential": "proprietary",
}

# Tags that a licence expression follows, after a colon or an equals sign.
TAGS = ["spdx license identifier", "license expression"]

# How freely a text under a licence may be used again, from 0 (not at all) to 1.
# The longest beginning of a label that is listed here counts: gpl-2.0-or-later is a gpl.
OPENNESS = {
    "0bsd": 1.0, "agpl": 0.4, "apache": 1.0, "artistic": 0.8, "bsd": 1.0, "bsl": 1.0, "cc-by": 0.9,
    "cc-by-nc": 0.2, "cc-by-nc-nd": 0.1, "cc-by-nc-sa": 0.2, "cc-by-nd": 0.3, "cc-by-sa": 0.6, "cc0": 1.0,
    "epl": 0.6, "gpl": 0.5, "isc": 1.0, "lgpl": 0.6, "mit": 1.0, "mpl": 0.7, "proprietary": 0.0,
    "public-domain": 1.0, "reserved": 0.0, "unlicense": 1.0, "wtfpl": 1.0, "zlib": 1.0,
}
OTHER = 0.3  # of a licence that is not listed
UNSTATED = 0.5  # of a text that states none
EXCEPTION = 0.2  # what an exception (with) adds

BEFORE = {"or": 1, "and": 2, "with": 3}  # the higher binds first

WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True

SCHEMA = """doc_id LONG, n_words LONG,
    hits ARRAY<STRUCT<word: LONG, n_words: INT, phrase: STRING, label: STRING, base: BOOLEAN, inner: BOOLEAN>>,
    expressions ARRAY<STRUCT<word: LONG, text: STRING, valid: BOOLEAN, labels: ARRAY<STRING>, value: DOUBLE>>,
    score DOUBLE"""


def openness(label: str) -> float:
    known = [name for name in OPENNESS if label == name or label.startswith(f"{name}-")]
    return OPENNESS[max(known, key=len)] if known else OTHER


TOKEN = re.compile(r"[ \t\"']*([()]|[a-z0-9.+\-]+|[^ \t\"'])")
IDENTIFIER = re.compile(r"[.+\-]*[a-z0-9][a-z0-9.+\-]*")
MARK = re.compile(r"[ \t\"']*[:=]")  # between a tag and its expression


def tokens(text: str, start: int = 0, end: int | None = None) -> Iterator[str]:
    """Identifiers, operators and parentheses of the expression at ``start``, up to the first that cannot belong to it.

    An expression ends with its line; after a licence only an operator or a parenthesis can go on.
    Reads no further than that.
    """
    wants, depth = True, 0
    for found in TOKEN.finditer(text, start, len(text) if end is None else end):
        token = found[1]
        if token in BEFORE and not wants:
            wants = True
        elif token == "(" and wants:
            depth += 1
        elif token == ")" and not wants and depth:
            depth -= 1
        elif wants and token not in BEFORE and IDENTIFIER.fullmatch(token):
            wants = False
        else:
            return
        yield token


def postfix(infix: list[str]) -> list[str] | None:
    """The shunting yard: operands and operators in the order of their evaluation, None if the expression is not whole."""
    out, held, wants = [], [], True
    for token in infix:
        if token == "(":
            held.append(token)
        elif token == ")":
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held or wants:
                return None
            held.pop()
        elif token in BEFORE:
            if wants:
                return None
            while held and held[-1] != "(" and BEFORE[held[-1]] >= BEFORE[token]:
                out.append(held.pop())
            held.append(token)
            wants = True
        else:
            out.append(token)
            wants = False
    if wants or "(" in held:
        return None
    return out + held[::-1]


def family(identifier: str) -> str:
    """The label of a licence identifier: without a full stop, a plus, -only or -or-later at its end."""
    return re.sub(r"(\+|-only|-or-later)?\.*$", "", identifier, count=1)


def evaluated(order: list[str]) -> tuple[float, list[str]] | None:
    """Openness and labels of a postfix expression: the best of or, the least of and, with adds ``EXCEPTION``.

    None if an exception is given to anything but one licence, or is one itself.
    """
    stack: list[tuple[float, tuple[str, ...], str | None]] = []
    for token in order:
        if token not in BEFORE:
            stack.append((openness(family(token)), (family(token),), token))
            continue
        (right, more, exception), (left, labels, licence) = stack.pop(), stack.pop()
        if token == "with":
            if exception is None or licence is None:
                return None
            stack.append((min(1.0, left + EXCEPTION), labels, None))
        else:
            stack.append(((max if token == "or" else min)(left, right), labels + more, None))
    value, labels, _ = stack.pop()
    return value, sorted(set(labels))


def parsed(text: str, start: int = 0, end: int | None = None) -> tuple[str, bool, list[str], float | None]:
    """The expression at ``start`` of a lower-cased text: its tokens, whether it is valid, its labels and its openness."""
    infix = list(tokens(text, start, end))
    order = postfix(infix)
    result = evaluated(order) if order else None
    return " ".join(infix), result is not None, result[1] if result else [], result[0] if result else None


def automaton() -> ahocorasick.Automaton:
    """All phrases, as words between single spaces."""
    made = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, *TAGS]:
        made.add_word(f" {phrase} ", phrase)
    made.make_automaton()
    return made


class Texts:
    """Words of some texts, joined by single spaces; two spaces are between texts, so no phrase goes over them."""

    def __init__(self, texts: pa.Array):
        data, self.bounds = flat(texts)
        self.data = LOWER[data]
        word = WORD[self.data]
        begin, finish = word.copy(), word.copy()
        begin[1:] &= ~word[:-1]
        finish[:-1] &= ~word[1:]
        inner = self.bounds[(self.bounds > 0) & (self.bounds < len(data))]  # texts follow each other without a gap
        begin[inner] |= word[inner]
        finish[inner - 1] |= word[inner - 1]
        starts, self.ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        self.first = np.searchsorted(starts, self.bounds)
        sizes = self.ends - starts
        text_of = np.repeat(np.arange(len(texts)), np.diff(self.first))
        before = np.arange(len(starts)) + text_of  # spaces before the one in front of each word
        own = np.cumsum(sizes) - sizes
        self.place = own + before  # of that space, in the joined bytes
        joined = np.full(int(word.sum()) + len(starts) + len(texts) + 1, 32, np.uint8)
        joined[np.arange(int(word.sum())) + np.repeat(before + 1, sizes)] = self.data[word]
        self.joined = joined.tobytes().decode("latin-1")  # a character for each byte

    def found(self, machine: ahocorasick.Automaton) -> list[tuple[int, str]]:
        """(number of the first word, phrase) of each place, in order, the longest first."""
        pairs = [(end - len(phrase) - 1, phrase) for end, phrase in machine.iter(self.joined)]
        at = np.searchsorted(self.place, np.array([start for start, _ in pairs], np.int64))
        return sorted(zip(at.tolist(), [phrase for _, phrase in pairs], strict=True), key=lambda hit: (hit[0], -hit[1].count(" ")))

    @cached_property
    def plain(self) -> str:
        """The lower-cased texts one after the other, a character for each byte."""
        return self.data.tobytes().decode("latin-1")

    def expression(self, word: int, text: int) -> tuple[str, bool, list[str], float | None] | None:
        """What is said after a tag that ends with ``word``, if a colon or an equals sign comes first."""
        end = int(self.bounds[text + 1])
        mark = MARK.match(self.plain, int(self.ends[word]), end)
        return parsed(self.plain, mark.end(), end) if mark else None


def _scan(batch: pa.RecordBatch, machine: ahocorasick.Automaton) -> pa.RecordBatch:
    texts = Texts(batch["text"])
    n = batch.num_rows
    hits, expressions, values = [[] for _ in range(n)], [[] for _ in range(n)], [[] for _ in range(n)]
    found = texts.found(machine)
    owners = (np.searchsorted(texts.first, np.array([word for word, _ in found], np.int64), side="right") - 1).tolist()
    text, reached = -1, 0
    for (word, phrase), own in zip(found, owners, strict=True):
        size = phrase.count(" ") + 1
        if own != text:
            text, reached = own, 0
        place = word - int(texts.first[own])
        if phrase in TAGS:
            said = texts.expression(word + size - 1, own)
            if said:
                expression, valid, labels, value = said
                expressions[own].append({"word": place, "text": expression, "valid": valid, "labels": labels, "value": value})
                values[own] += [value] if valid else []
            continue
        inner = word + size <= reached  # inside a longer phrase, which says more
        reached = max(reached, word + size)
        label = BASE.get(phrase) or NOTICES[phrase]
        hits[own].append({"word": place, "n_words": size, "phrase": phrase, "label": label, "base": phrase in BASE, "inner": inner})
        values[own] += [] if inner else [openness(label)]
    columns = [batch["doc_id"], pa.array(np.diff(texts.first)), hits, expressions, [min(v, default=UNSTATED) for v in values]]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)], NAMES)


NAMES = ["doc_id", "n_words", "hits", "expressions", "score"]
TYPES = [
    pa.int64(), pa.int64(),
    pa.list_(pa.struct({"word": pa.int64(), "n_words": pa.int32(), "phrase": pa.string(), "label": pa.string(), "base": pa.bool_(), "inner": pa.bool_()})),
    pa.list_(pa.struct({"word": pa.int64(), "text": pa.string(), "valid": pa.bool_(), "labels": pa.list_(pa.string()), "value": pa.float64()})),
    pa.float64(),
]


def scanned(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, hits, expressions and score of each row of ``docs``.

    hits are the places of all phrases, with the number of their first word (from 0), their label,
    whether they are of ``BASE``, and whether a longer phrase holds them (``inner``). expressions are
    those after a tag, with their labels and value; a broken one is not valid and has neither. The
    score is the least openness of the statements, an expression's value and each phrase that is not
    inner; 0.5 if there is none.

    Null, empty and wordless texts have no words, hits or expressions. A text of any length is scanned
    whole, by one task. Repeated rows are scanned each, an empty table gives none, and other columns
    of ``docs`` may have any name.
    """
    rows = texts_only(docs, id_column, text_column).select(F.col("doc_id").cast("long"), "text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton()
        for part in slices(batches, "text"):
            yield _scan(part, machine)

    return rows.mapInArrow(scan, SCHEMA)


def summary(rows: DataFrame) -> DataFrame:
    """One flat row for each of ``scanned``: places and labels of the base phrases, and all labels, sorted."""
    base = F.filter("hits", lambda h: h["base"])
    places = F.transform(base, lambda h: h["word"])
    own = F.transform(base, lambda h: h["label"])
    every = F.concat(F.transform("hits", lambda h: h["label"]), F.flatten(F.transform("expressions", lambda e: e["labels"])))
    return rows.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(own)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(every)), ",").alias("labels"), "score",
    )
