"""Licence scans against plain searches and a parser of another kind."""

import random
import re

import pytest

from trendmill.llm import licenses
from conftest_llm import by_id, edge_texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def places(words, phrase):
    own = phrase.split()
    return [k for k in range(len(words) - len(own) + 1) if words[k : k + len(own)] == own]


def plain(text):
    """n_words, n_base, first, last, base labels, and labels and score where there is no expression."""
    words = WORD.findall(lower(text))
    hits = [(k, len(p.split()), p) for p in [*licenses.BASE, *licenses.NOTICES] for k in places(words, p)]
    base = [h for h in hits if h[2] in licenses.BASE]
    label = lambda p: licenses.BASE.get(p) or licenses.NOTICES[p]
    longer = {n: [o for o in hits if o[1] > n] for n in {h[1] for h in hits}}
    outer = [h for h in hits if not any(o[0] <= h[0] and h[0] + h[1] <= o[0] + o[1] for o in longer[h[1]])]
    starts = [h[0] for h in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({label(h[2]) for h in base})),
        ",".join(sorted({label(h[2]) for h in hits})), min((licenses.openness(label(h[2])) for h in outer), default=licenses.UNSTATED),
    )


def flat(df):
    rows = by_id(licenses.summary(licenses.scanned(df)))
    return {i: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for i, r in rows.items()}


TEXTS = [
    "Licensed under CC BY-NC 4.0.", "cc, by! CC\nBY cc by", "GNU General\tPublic License, version 3. All rights reserved.", "xcc by ccby cc byé",
    "Released under the MIT License.", "Apache License, Version 2.0", "a CC", "BY b", "général public license", "all rights  reserved all Rights RESERVED",
    "cc" + " by cc" * 500, "日本cc by日本", "cc\x00by", "k general public licensed", "general public license", "K CC BY",
]


def test_phrases_by_plain_search(docs_of, tables):
    texts = [*edge_texts(), *TEXTS, " cc by" * 40_000, *(r.text for r in tables("documents").collect())]
    assert flat(docs_of(*texts)) == {i: plain(t) for i, t in enumerate(texts)}


def test_random_words(docs_of):
    chance = random.Random(5)
    words = sorted({w for p in [*licenses.BASE, *licenses.NOTICES] for w in p.split()})
    texts = ["".join(chance.choice(words) + chance.choice([" ", "-", ".", "\n", ""]) for _ in range(chance.randrange(60))) for _ in range(300)]
    assert flat(docs_of(*texts)) == {i: plain(t) for i, t in enumerate(texts)}


def test_empty_table_repeats_and_null_ids(docs_of):
    assert licenses.scanned(docs_of("x").limit(0)).count() == 0
    rows = licenses.scanned(docs_of((1, "cc by"), (1, "cc by"), (None, "cc by"))).collect()
    assert [len(r.hits) for r in rows] == [1, 1, 1] and sorted(str(r.doc_id) for r in rows) == ["1", "1", "None"]


# Expressions


def descend(words):
    """Openness and labels by recursive descent, which names each level of the grammar."""
    at = 0

    def peek():
        return words[at] if at < len(words) else None

    def take():
        nonlocal at
        at += 1
        return words[at - 1]

    def level(sign, below, join):
        value, labels = below()
        while peek() == sign:
            take()
            other, more = below()
            value, labels = join(value, other), labels | more
        return value, labels

    def one():
        if peek() == "(":
            take()
            found = either()
            assert take() == ")"
            return found
        name = licenses.family(take())
        value = licenses.openness(name)
        if peek() == "with":
            take(), take()
            value = min(1.0, value + licenses.EXCEPTION)
        return value, {name}

    def both():
        return level("and", one, min)

    def either():
        return level("or", both, max)

    found = either()
    assert at == len(words)
    return found


def written(chance, depth=0):
    if depth > 4 or chance.random() < 0.4:
        name = chance.choice(["mit", "gpl-2.0+", "gpl-3.0-only", "apache-2.0", "lgpl-2.1-or-later", "cc-by-nc-4.0", "licenseref-own", "bsd-3-clause"])
        return [name, "with", "classpath-exception-2.0"] if chance.random() < 0.2 else [name]
    parts = [*written(chance, depth + 1), chance.choice(["and", "or"]), *written(chance, depth + 1)]
    return ["(", *parts, ")"] if chance.random() < 0.5 else parts


def test_expressions_as_by_recursive_descent():
    chance = random.Random(11)
    for _ in range(3000):
        words = written(chance)
        text = " ".join(words).replace("( ", "(" * 1).replace(" )", ")")
        shown, valid, labels, value = licenses.parsed(text + chance.choice(["", "\nmore mit", " */", " -->", "; and so on"]))
        expected, names = descend(words)
        assert valid and shown.split() == words and labels == sorted(names) and value == pytest.approx(expected)


@pytest.mark.parametrize("text", ["", "or mit", "mit or", "(mit", "(mit or apache-2.0", "mit and or isc", "(mit or isc) with x", "()", "--", "with"])
def test_broken_expressions(text):
    assert licenses.parsed(text)[1:] == (False, [], None)


@pytest.mark.parametrize("text,labels,value", [
    ("mit", ["mit"], 1.0), ("mit this file is", ["mit"], 1.0), ("mit)", ["mit"], 1.0), ("gpl-2.0-or-later with x", ["gpl-2.0"], 0.7),
    ("mit or gpl-3.0 and cc-by-nc-4.0", ["cc-by-nc-4.0", "gpl-3.0", "mit"], 1.0), ("(mit or gpl-3.0) and reserved", ["gpl-3.0", "mit", "reserved"], 0.0),
    ("mit.", ["mit"], 1.0), ("'mit' or \"isc\"", ["isc", "mit"], 1.0), ("unheard-of", ["unheard-of"], licenses.OTHER),
])
def test_ends_of_expressions(text, labels, value):
    assert licenses.parsed(text)[1:] == (True, labels, pytest.approx(value))


def test_tags_in_texts(docs_of):
    nested = "(" * 20_000 + "MIT" + ")" * 20_000
    texts = [
        "// SPDX-License-Identifier: MIT OR GPL-3.0-only\nint x;", "SPDX-License-Identifier = Apache-2.0 WITH LLVM-exception */ all rights reserved",
        "spdx license identifier MIT", "SPDX-License-Identifier: (MIT", f"SPDX-License-Identifier: {nested}", 'License-Expression: "MIT AND CC-BY-4.0"',
        "SPDX-License-Identifier:", "SPDX-License-Identifier:\nMIT", "SPDX-License-Identifier: MIT " * 2000, "Ä SPDX-License-Identifier: ISC",
    ]
    rows = by_id(licenses.scanned(docs_of(*texts)))
    said = {i: [(e.valid, e.labels) for e in r.expressions] for i, r in rows.items()}
    assert said[0] == [(True, ["gpl-3.0", "mit"])] and said[1] == [(True, ["apache-2.0"])] and said[2] == []
    assert said[3] == said[6] == said[7] == [(False, [])] and said[4] == [(True, ["mit"])] and said[5] == [(True, ["cc-by-4.0", "mit"])]
    assert said[8] == [(True, ["mit"])] * 2000 and rows[8].expressions[1].word == 4 and rows[9].expressions[0].word == 1
    assert [rows[i].score for i in (0, 1, 2, 3, 5, 9)] == [1.0, 0.0, 0.5, 0.5, pytest.approx(0.9), 1.0]
    assert flat(docs_of(*texts))[1][4:6] == ("reserved", "apache-2.0,reserved")
