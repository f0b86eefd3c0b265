"""Benchmark passages that are copied in other surroundings or case, or with other values."""

import pytest

from trendmill.llm import decontamination


@pytest.fixture
def found(spark, docs_of):
    def run(item, *texts):
        items = spark.createDataFrame([(70, item)], "item_id long, text string")
        return {r.doc_id: r.kind for r in decontamination.matches(docs_of(*texts), items).collect()}

    return run


def test_copies_with_few_literals(found):
    """Sums, sequences and lists of names, of any length."""
    for item in ("What is 12 + 30 - 7 * 4?", " ".join(str(7 * x) for x in range(30)), "Who wins: " + " ".join(f"Name{x}" for x in "abcdefghijklmnop")):
        assert found(item, f"So it was. {item} Yes.", "What is 12 + 30 - 7 * 5?", "nothing of it") == {0: "verbatim"}


def test_copies_in_other_surroundings_and_case(found):
    item = "What is the capital city of France?"
    texts = [f'The teacher asked, "{item}"', item.lower(), item.upper(), item.title(), "What is the capital city of Spain?", "no copy"]
    kinds = found(item, *texts)
    assert {i for i, kind in kinds.items() if kind == "verbatim"} == {0, 1, 2, 3} and 5 not in kinds
    item = "Anna Berg and Carl Dorn met Eva Falk in Genoa before they went to Hull with Ida Jung"
    assert found(item, item.lower(), item.upper(), item.title(), f"He wrote: {item}") == dict.fromkeys(range(4), "verbatim")
