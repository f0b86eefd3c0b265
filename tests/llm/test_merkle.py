"""Merkle manifests against a plain tree in Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from trendmill.llm import merkle, queries
from conftest_llm import edge_texts

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def up(nodes, arity):
    """Levels of a tree, and for each leaf its (before, after) at every level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H("".join(below[i : i + arity])) for i in range(0, len(below), arity)])
    steps = []
    for i in range(len(nodes)):
        own = []
        for level in levels[:-1]:
            run = i - i % arity
            own.append(("".join(level[run:i]), "".join(level[i + 1 : run + arity])))
            i //= arity
        steps.append(own)
    return levels[-1][0], steps


def plain(rows, arity=2, tamper=True):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows of COLUMNS."""
    lowest = lambda v: (v is not None, "" if v is None else v)
    leaves = sorted(((lowest(r[2] if r[2] is None else r[2].encode()), lowest(r[0]) if r[0] is not None else (False, 0), plain_leaf(r), r) for r in rows), key=lambda x: x[:3])
    groups = {}
    for name, _, leaf, row in leaves:
        groups.setdefault(name, []).append((leaf, row))
    trees = [(up([leaf for leaf, _ in own], arity), own) for own in groups.values()]
    root, tops = up([tree[0] for tree, _ in trees], arity) if trees else (None, [])
    out = []
    for ((subroot, steps), own), top in zip(trees, tops, strict=True):
        for (leaf, row), path in zip(own, steps, strict=True):
            path = path + top
            node = leaf
            if tamper and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                node = plain_leaf((*row[:3], row[3] + 1, row[4]))
            for before, after in path:
                node = H(before + node + after)
            out.append((row[0], leaf, subroot, root, H("".join(b + a for b, a in path)), node, node == root))
    return sorted(out, key=str)


def test_registered_query(spark, tables):
    rows = [tuple(r[c] for c in COLUMNS) for r in tables("documents").collect()]
    found = [tuple(r) for r in queries.op12_merkle_manifest(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(found, key=str) == plain(rows) and 0 < sum(not r[-1] for r in found) < 60


SHAPE = "doc_id long, source string, lang string, n_chars long, text string, node string, n int, i long, row int, grp string"


def of(spark, rows, partitions=4):
    return spark.createDataFrame([(*r, "n", 1, 2, 3, "g") for r in rows], SHAPE).repartition(partitions)


def summed(manifested):
    again = merkle.folded(F.col("leaf"), F.col("steps"))
    rows = manifested.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")), again, again == F.col("root"))
    return sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_nulls_ties_repeats_and_one_large_group(spark, arity):
    langs = [None, "", "de", "ä", "z", "Z"]
    rows = [(i, "s", "en", i, f"text {i}") for i in range(41)]
    rows += [(i, None, langs[i % 6], None if i % 4 == 0 else i, t) for i, t in enumerate(edge_texts())]
    rows += [(None, "s", None, 1, None), (None, "s", None, 1, ""), (7, "s", "en", 7, "other"), (2**63 - 1, "é", "lone", 2**63 - 1, "x")]
    rows += [(3, "s", "en", 3, "text 3")] * 5  # repeated rows
    assert summed(merkle.manifest(of(spark, rows), COLUMNS, arity=arity)) == plain(rows, arity, tamper=False)


def test_single_rows_and_none(spark):
    one = [(5, "a", "en", 3, "abc")]
    assert summed(merkle.manifest(of(spark, one), COLUMNS)) == plain(one, tamper=False)
    leaf = plain_leaf(one[0])
    assert plain(one, tamper=False)[0][1:4] == (leaf, leaf, leaf)
    assert merkle.manifest(of(spark, one).limit(0), COLUMNS).count() == 0
    assert merkle.root_of(merkle.manifest(of(spark, one).limit(0), COLUMNS)) is None


def test_changes_are_found(spark):
    rows = [(i, "s", "en" if i % 3 else None, i, f"text {i}") for i in range(30)]
    manifested = merkle.manifest(of(spark, rows), COLUMNS)
    other = [(*r[:4], "changed") if r[0] in (4, 9) else r for r in rows] + [(99, "s", "en", 1, "new")]
    assert sorted(r.doc_id for r in merkle.changed(of(spark, other), manifested, COLUMNS).collect()) == [4, 9, 99]
    assert merkle.changed(of(spark, rows), manifested, COLUMNS).count() == 0
    assert merkle.root_of(manifested) == plain(rows, tamper=False)[0][3]


def test_largest_number_of_characters(spark):
    """One more than the largest long is still a number."""
    row = (0, "s", "en", 2**63 - 1, "x")
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    found = of(spark, [row]).select(merkle.leaf([more if c == "n_chars" else F.col(c) for c in COLUMNS])).first()[0]
    assert found == plain_leaf((*row[:3], 2**63, "x"))
