from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from trendmill.llm import simhash
from trendmill.llm.components import components
from conftest_llm import edge_texts, words_of


def fingerprint(text, size):
    words = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(fps, max_bits):
    """By brute force: for each number the smallest number it is linked to."""
    fps = sorted(set(fps))
    root = {x: x for x in fps}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits:
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return {x: top(x) for x in fps}


@pytest.mark.parametrize("size", [1, 4, 5])
def test_fingerprints(docs_of, size):
    texts = [*edge_texts()[:8], "The cat SAT on the mat É", " ".join("abcdefg" * 30)]
    seen = {r.doc_id: r.fp & (1 << 64) - 1 for r in simhash.fingerprints(docs_of(*texts), size).collect()}
    assert seen == {i: fingerprint(t, size) for i, t in enumerate(texts)}


@pytest.mark.parametrize("max_bits", [0, 1, 4, 7])
@pytest.mark.parametrize("block", [8, 2048])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, max_bits, block):
    """Random numbers, chains of near ones, and one dense group, in blocks and not."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(max_bits)
    base = rng.integers(-(1 << 63), (1 << 63) - 1, 60)
    fps = set(base.tolist())
    for start in base[:8].tolist():
        x = start
        for _ in range(12):
            for bit in rng.choice(64, rng.integers(1, 9), replace=False):
                x ^= 1 << int(bit)
            x = (x + (1 << 63)) % (1 << 64) - (1 << 63)
            fps.add(x)
    fps |= {int(base[9]) ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 40, (60, 2))} - {0}
    df = spark.createDataFrame([(x,) for x in sorted(fps)], "fp long")
    expected = roots(fps, max_bits)
    seen = {r.node: r.root for r in components(simhash.links(df, max_bits)).collect()}
    assert {x: seen.get(x, x) for x in fps} == expected


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    seen = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(seen.get(i, 0) == 0 for i in range(41)) and all(seen[i] == 100 for i in range(101, 140))


def test_near_duplicates_on_edge_cases(docs_of):
    """Null ids do not name a component; empty texts are one; copies link."""
    rows = [(5, "a b c d e"), (3, "a b c d e"), (None, "a b c d e"), (None, "alone here now ok"), (9, None), (8, ""), (8, "")]
    marked = simhash.near_duplicates(simhash.fingerprints(docs_of(*rows)))
    seen = Counter((r.doc_id, r.component_id) for r in marked.collect())
    assert seen == Counter({(5, 3): 1, (3, 3): 1, (None, 3): 1, (None, None): 1, (9, 8): 1, (8, 8): 2})


def test_empty_table(docs_of):
    empty = docs_of("x").limit(0)
    assert simhash.near_duplicates(simhash.fingerprints(empty)).count() == 0
    assert simhash.keep_one(empty).count() == 0


def test_keep_one(docs_of):
    rows = [(5, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (7, "other words are in this one"), (None, None), (2, "")]
    docs = docs_of(*rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 7]


def test_documents(tables):
    """The table against brute force over its fingerprints."""
    docs = tables("documents")
    rows = simhash.near_duplicates(simhash.fingerprints(docs)).select("doc_id", "fp", "component_id", simhash.hex_digits().alias("hex")).collect()
    root = roots([r.fp for r in rows], 4)
    first = {}
    for r in rows:
        first[root[r.fp]] = min(first.get(root[r.fp], r.doc_id), r.doc_id)
    assert len(rows) == docs.count()
    for r in rows:
        assert r.component_id == first[root[r.fp]] and r.hex == f"{r.fp & (1 << 64) - 1:016x}"


def test_rows_are_not_shuffled_with_their_texts(docs_of):
    plan = simhash.fingerprints(docs_of("a", partitions=1)).where(F.col("fp") > 0)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
