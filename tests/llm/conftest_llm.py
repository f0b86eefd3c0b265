"""Helpers of the tests."""


def words_of(text):
    """ASCII white space alone separates words."""
    return [w.decode() for w in (text or "").encode().split()]


def edge_texts():
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    return [None, "", " \t\n", "one", "one", "Ünïcode wörds 日本 😀 here", "a b c d", "x" * 200_000, long, long]


def by_id(df):
    return {row["doc_id"]: row for row in df.collect()}
