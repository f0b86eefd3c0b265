"""Every operator on null, empty, very long, tied and repeated texts, empty tables and clashing columns."""

import base64
import hashlib
import zlib

import pytest
import sentencepiece
import tiktoken
import pyarrow as pa

from trendmill.llm import decontamination, pieces, pii, quality, rules, sharding, substrings, tokencounts, warc
from conftest_llm import by_id, edge_texts, words_of


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# Sharding


def test_shards_and_slots(docs_of):
    docs = docs_of(*[(None if i % 50 == 0 else i % 400, f"text {i}") for i in range(1000)], (7, None), partitions=7)
    rows = sharding.shard_rows(docs, 5).collect()
    assert len(rows) == 1001
    shard_of = {}
    for r in rows:
        assert shard_of.setdefault(r.doc_id, r.shard) == r.shard and r.grown_shard in (r.shard, 5)
    for shard in range(5):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    empty = next(r for r in rows if r.size == 1)
    assert empty.text_crc32 == 0
    assert all(r.text_crc32 == zlib.crc32(f"text {i}".encode()) for i in (1, 2) for r in rows if r.doc_id == i and r.size == 7 and r.text_crc32 == zlib.crc32(f"text {i}".encode()))


@pytest.mark.parametrize("shards", [1, 2, 17, 1000])
def test_one_more_shard_takes_its_share(spark, shards):
    keys = spark.range(20_000).select(sharding.jump_shard("id", shards).alias("a"), sharding.jump_shard("id", shards + 1).alias("b")).collect()
    assert all(0 <= r.a < shards and r.b in (r.a, shards) for r in keys)
    moved = sum(r.b == shards for r in keys) / len(keys)
    assert abs(moved - 1 / (shards + 1)) < 0.01


def test_no_rows_to_shard(docs_of):
    assert sharding.shard_rows(docs_of("x").limit(0)).count() == 0


# WARC


def test_archives_read_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_BYTES", 700)
    big = "é" * 2000
    pages = [(1, "http://a", big), (2, None, big), (3, "http://b\r\nX: y", "tiny"), (4, "u", "tiny"), (None, "u", big), (6, "u", None), (2, "u", big), (8, "u", "WARC/1.1\r\n\r\n" * 200)]
    chunks = warc.archive(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    last = [r for r in chunks if r["last"]]
    assert len(last) == len(pages) and all(r.intact for r in last)
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in last if r.bytes_so_far == 4000) == [
        (0, "revisit", 2), (1, "revisit", 2), (2, "response", None), (2, "response", None)
    ]
    payloads = {(i, (h or "").encode()) for i, _, h in pages}
    for r in last:
        assert (r.page_id, r.digest_so_far) in {(i, hashlib.sha1(h).hexdigest()) for i, h in payloads}
    parts = sorted((r for r in chunks if r.page_id == 8), key=lambda r: r.chunk)
    assert b"".join(r.data for r in parts).decode() == pages[-1][2] and len(parts) > 3
    assert max(len(r.data or b"") for r in chunks) <= 700


def test_no_pages(spark):
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# Substrings


def kept_by_brute_force(rows, size):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        words, gone = words_of(text), set()
        for k in range(len(words) - size + 1):
            window = tuple(words[k : k + size])
            if window in seen:
                gone.update(range(k, k + size))
            seen.add(window)
        out[i] = (len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone))
    return out


@pytest.mark.parametrize("blocks", [1, 1 << 12])
def test_repeated_windows_are_removed(docs_of, monkeypatch, blocks):
    """Also with a sketch that is far too small."""
    monkeypatch.setattr(substrings, "MAX_BLOCKS", blocks)
    monkeypatch.setattr(substrings, "BLOCK_BITS", 4 if blocks == 1 else 16)
    passage = " ".join(f"p{i}" for i in range(35))
    texts = [*edge_texts(), f"a b {passage} c", f"{passage} x {passage}", "der " * 90, " ".join(f"p{i}" for i in range(5, 30))]
    rows = [*enumerate(texts), (None, passage)]
    seen = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.without_repeats(docs_of(*rows)).collect()}
    assert seen == kept_by_brute_force(rows, 20)


def test_repeated_ids(docs_of):
    text = " ".join(f"q{i}" for i in range(25))
    rows = substrings.without_repeats(docs_of((1, text), (1, text), (2, text), (1, f"z {text}"))).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in rows) == [(1, 25, 0), (1, 25, 0), (1, 26, 25), (2, 25, 25)]
    assert substrings.without_repeats(docs_of("x").limit(0)).count() == 0


# Tokens


def test_token_counts(docs_of):
    texts = edge_texts()
    coder = tiktoken.Encoding("own", pat_str=tokencounts.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokencounts.RANKS, "rb"))}, special_tokens={})
    lengths = [len(coder.encode_ordinary(t or "")) for t in texts]
    counts = tokencounts.token_counts(docs_of(*texts))
    assert {r.doc_id: r.n_tokens for r in counts.collect()} == dict(enumerate(lengths))
    sums = tokencounts.with_suffix_sums(tokencounts.histogram(counts))
    for r in sums.collect():
        n = r.n_tokens
        assert (r.documents_above, r.tokens_above) == (sum(x > n for x in lengths), sum(x for x in lengths if x > n))
        assert r.truncated_tokens == sum(min(x, n) for x in lengths)
    for r in tokencounts.at_limits(sums, [0, 1, 5, 10**7]).collect():
        assert r.truncated_tokens == sum(min(x, r.context) for x in lengths)
    assert {r.share: r.n_tokens for r in tokencounts.quantiles(sums, [0.5, 1]).collect()} == {0.5: sorted(lengths)[4], 1.0: max(lengths)}
    empty = tokencounts.with_suffix_sums(tokencounts.histogram(counts.limit(0)))
    assert empty.count() == 0 and tokencounts.at_limits(empty, [5]).first().truncated_tokens == 0


# SentencePiece


def test_encoding_is_that_of_the_library(docs_of, tables):
    reader = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = [*edge_texts(), "▁a  ▁▁b", " " * 500, "\x00\r\n", *(r.text for r in tables("documents").collect())]
    rows = pieces.encoded(docs_of(*texts)).collect()
    for r in rows:
        assert r.token_ids == reader.encode(texts[r.doc_id] or "") and r.restored and r.n_tokens == len(r.token_ids)
    assert len(rows) == len(texts) and pieces.encoded(docs_of("x").limit(0)).count() == 0


def test_decoding(spark):
    reader = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    lists = [[], None, [1, 15043, 2], reader.encode("Hé 日本😀 \n"), [238, 259, 300]]
    df = spark.createDataFrame(list(enumerate(lists)), "doc_id long, token_ids array<int>")
    assert {r.doc_id: r.text for r in pieces.decoded(df).collect()} == {i: reader.decode(x or []) for i, x in enumerate(lists)}


def test_random_words_are_encoded_as_by_the_library():
    import random

    reader = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    coder, chance = pieces.Coder(pieces.load()), random.Random(3)
    letters = "etaoinshr éñ▁\n=-*#01漢😀"
    texts = ["".join(chance.choice(letters) for _ in range(chance.randrange(50))) for _ in range(2000)]
    assert coder.encode(pa.array(texts)).to_pylist() == reader.encode(texts)


def test_long_words_are_encoded_as_by_the_library(docs_of, tables):
    """Texts without spaces: prose, runs whose pieces depend on where they begin, and lengths around those of a stretch."""
    import random

    reader = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    chance = random.Random(7)
    prose = "".join("".join((r.text or "").split()) for r in tables("documents").limit(60).collect())
    cut = pieces.STRETCH + pieces.OVERLAP
    texts = [prose[:40_000], "a" * 9_001, "xy" + "a" * 5_001 + "b" * 3_000, ("a" * 401 + "b" * 333 + "ab" * 200) * 4, "日本語😀" * 900]
    for size in [pieces.LONG, pieces.LONG + 1, cut - 1, cut, cut + 1, cut + pieces.STRETCH, 2 * cut + 3]:
        texts += [prose[size : 2 * size], "x" * size, "".join(chance.choices("abé的😀", k=size)), "".join(chance.choices("01", k=size)) + " end"]
    for r in pieces.encoded(docs_of(*texts)).collect():
        assert r.token_ids == reader.encode(texts[r.doc_id]) and r.restored


# Rules and classifier


def test_statistics_and_verdicts(docs_of, tables):
    rows = by_id(rules.judged(docs_of(*edge_texts())))
    assert rows[0].n_words == 0 and rows[0].base_failed and not rows[0].kept
    assert rows[5].word_chars == len("Ünïcodewörds日本😀here") and rows[6].n_words == 2
    lines = "a b\n\na b\n a b\nc"
    seen = by_id(rules.statistics(docs_of(lines, "x y z x y z x y", "# $ a|b")))
    assert seen[0].n_dup_lines == 1 and seen[1].n_repeat_words == 8 and seen[2].n_symbols == 3
    assert rules.judged(docs_of("x").limit(0)).count() == 0
    own = rules.judged(tables("documents", "sf0.01")).join(tables("labels", "sf0.01"), "doc_id").where("not base_failed")
    right = own.selectExpr("avg(if(kept = (quality = 1), 1.0, 0.0)) AS share").first().share
    assert right > 0.97


def test_classifier(spark, docs_of, tables):
    scored = quality.scored(tables("documents", "sf0.01"), tables("labels", "sf0.01"))
    both = scored.join(tables("labels", "sf0.01"), "doc_id").where("held_out")
    right = both.selectExpr("avg(if(predicted = quality, 1.0, 0.0)) AS share").first().share
    assert right > 0.95
    for r in scored.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    docs = docs_of(*edge_texts(), (None, "no id"))
    odd = labels_of(spark, [(1, 1, 0), (1, 0, 0), (2, None, 0), (99, 1, 1), (None, 1, 0), (3, 5, 0)])
    assert quality.scored(docs, odd).count() == 11
    assert quality.scored(docs, odd.limit(0)).select("score").distinct().collect()[0].score == 0.5
    assert quality.scored(docs.limit(0), odd).count() == 0
    kept = quality.accepted(docs, odd)
    assert kept.columns == docs.columns and kept.count() <= 11


# Benchmark


QUESTION = "Alice has 12 apples and buys 5 kg more in Berlin, how many apples does she then own after eating 12 apples?"


def test_templates(spark, docs_of):
    changed = QUESTION.replace("12", "99").replace("5", "7").replace("Berlin", "Paris")
    mixed = changed.replace("eating 99", "eating 98")
    rows = [(1, f"so it is. {QUESTION} Yes."), (2, f"well: {changed}"), (3, mixed), (4, None), (5, ""), (6, QUESTION.upper()), (7, "nothing of it"), (None, changed), (2, f"well: {changed}")]
    items = spark.createDataFrame([(70, QUESTION), (71, None), (72, ""), (73, "three short words")], "item_id long, text string")
    found = decontamination.matches(docs_of(*rows), items).collect()
    assert {(r.doc_id, r.item_id, r.kind) for r in found} == {
        (1, 70, "verbatim"), (2, 70, "reparameterised"), (None, 70, "reparameterised"), (6, 70, "verbatim")
    }
    left = decontamination.without_matches(docs_of(*rows), items)
    assert sorted((r.doc_id or 0) for r in left.collect()) == [3, 4, 5, 7]
    assert decontamination.matches(docs_of(*rows), items.limit(0)).count() == 0
    assert decontamination.matches(docs_of("x").limit(0), items).count() == 0


def test_benchmark_passages_are_found(tables):
    """Documents with twelve words of an item in a row, by plain search, and no others."""
    def plain(text):
        return " ".join("".join(c if c.isalnum() else " " for c in w).strip() for w in text.lower().split())

    items = [plain(r.text).split() for r in tables("benchmark", "sf0.01").collect()]
    runs = {" ".join(x[i : i + 12]) for x in items for i in range(len(x) - 11)}
    docs = tables("documents", "sf0.01")
    expected = set()
    for r in docs.collect():
        words = plain(r.text or "").split()
        if any(" ".join(words[i : i + 12]) in runs for i in range(len(words) - 11)):
            expected.add(r.doc_id)
    found = {r.doc_id for r in decontamination.matches(docs, tables("benchmark", "sf0.01")).collect()}
    assert found == expected and len(found) > 20


# Personal data


def test_pseudonyms(docs_of):
    texts = [
        "call +1 (743) 555-3824 or 4994226020900891, not 4994226020900892.", "152.143.123.131### 300.1.1.1 v 2.0.",
        "a.19@mail5.example.com", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"',
        "1984-02-29 1983-02-29 31.12.1999 30/12/2001", "123-45-6789 000-12-3456", None, "", "no data", "4994226020900891 1984-02-29",
    ]
    docs = docs_of(*texts)
    new = by_id(pii.pseudonymised(docs, "key"))
    assert new[0].text.endswith(", not 4994226020900892.") and "4994226020900891" not in new[0].text and "743" not in new[0].text
    assert "152.143.123.131" not in new[1].text and new[1].text.endswith("### 300.1.1.1 v 2.0.")
    assert "a.19" not in new[2].text and "mail5" not in new[2].text and "24be6443" not in new[3].text
    assert "1983-02-29" in new[4].text and "1984-02-29" not in new[4].text and new[5].text.endswith("000-12-3456")
    assert (new[6].text, new[7].text, new[8].text) == (None, "", "no data")
    assert new[9].text.split()[0] in new[0].text and new[9].text.split()[1] == new[4].text.split()[0]
    assert new[0].source == "src0" and by_id(pii.pseudonymised(docs, "other"))[9].text != new[9].text
    digits = [int(c) for c in new[9].text.split()[0]][::-1]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    undone = by_id(pii.pseudonymised(pii.pseudonymised(docs, "key"), "key", back=True))
    assert all(undone[i].text == texts[i] for i in (0, 1, 4, 5, 9))
    plan = pii.pseudonymised(docs, "key")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pseudonyms_are_distinct(spark):
    numbers = spark.range(5000).selectExpr("id AS doc_id", "concat('10.1.', id div 250, '.', id % 250) AS text")
    seen = [r.text for r in pii.pseudonymised(numbers, "key").collect()]
    assert len(set(seen)) == 5000
