from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, at int, first string, block int"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts or (id, text) pairs, with further columns of names that operators use themselves."""

    def make(*texts, partitions=3):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, None, "src0", None if t is None else len(t), "k", 1, "f", 2) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def tables(spark):
    def make(name, sf="sf0.001"):
        return spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")

    return make
