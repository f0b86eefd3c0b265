"""The pipeline against plain versions of its stages."""

import zlib

import numpy as np
import pyarrow as pa
import sentencepiece

import corpus_pipeline
from trendmill.llm import pieces, pii, quality
from trendmill.llm.queries import PII_KEY
from trendmill.llm.words import read
from conftest_llm import edge_texts
from test_simhash import fingerprint, roots

SF_DIR = "/root/testdata/sf0.001"


def plain_scores(texts, labels):
    """Scores of {id: text} by two Gaussian densities, learnt from (id, label), with inverses and determinants written out."""
    ids = list(texts)
    x = quality._features(pa.array([texts[i] for i in ids], pa.string()))
    place = {i: at for at, i in enumerate(ids)}
    known = {(i, label) for i, label in labels if i in place and zlib.crc32(str(i).encode()) % 5 != 0 and label in (0, 1)}
    own = [x[[place[i] for i, label in sorted(known) if label == c]] for c in (0, 1)]
    covariances = [np.cov(rows.T, bias=True) for rows in own]
    share = np.array([len(rows) for rows in own]) / sum(len(rows) for rows in own)
    pooled = share[0] * covariances[0] + share[1] * covariances[1]
    unit = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    log_odds = np.log((len(own[1]) + 0.5) / (len(own[0]) + 0.5))
    for sign, rows, covariance in zip((-1, 1), own, covariances, strict=True):
        mixed = (0.5 * covariance + 0.5 * pooled) / np.outer(unit, unit)
        mixed = (0.9 * mixed + 0.1 * np.trace(mixed) / len(unit) * np.eye(len(unit))) * np.outer(unit, unit)
        away = x - rows.mean(axis=0)
        log_odds = log_odds - sign * 0.5 * (np.einsum("ij,jk,ik->i", away, np.linalg.inv(mixed), away) + np.linalg.slogdet(mixed)[1])
    return dict(zip(ids, 1 / (1 + np.exp(-log_odds)), strict=True))


def plain_words(text):
    return " ".join("".join(c if c.isalnum() else " " for c in w).strip() for w in (text or "").lower().split()).split()


def test_scores_are_those_of_two_gaussians(tables):
    docs, labels = tables("documents", "sf0.01"), tables("labels", "sf0.01")
    expected = plain_scores({r.doc_id: r.text for r in docs.collect()}, {(r.doc_id, r.quality) for r in labels.collect()})
    found = {r.doc_id: r.score for r in quality.scored(docs, labels).collect()}
    assert found.keys() == expected.keys() and all(abs(found[i] - expected[i]) < 1e-6 for i in found)


def test_run_is_what_plain_versions_leave(spark):
    docs = read(spark, SF_DIR, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    scores = plain_scores(texts, {(r.doc_id, r.quality) for r in read(spark, SF_DIR, "labels").collect()})
    good = {i: t for i, t in texts.items() if scores[i] >= 0.3}
    fps = {i: fingerprint(t, 4) for i, t in good.items()}
    root, first = roots(fps.values(), 4), {}
    for i in sorted(good):
        first.setdefault(root[fps[i]], i)
    items = [plain_words(r.text) for r in read(spark, SF_DIR, "benchmark").collect()]
    runs = {" ".join(x[i : i + 12]) for x in items for i in range(len(x) - 11)}
    words = {i: plain_words(texts[i]) for i in first.values()}
    clean = {i for i, own in words.items() if not any(" ".join(own[k : k + 12]) in runs for k in range(len(own) - 11))}
    assert len(clean) < len(first) < len(good) < len(texts)

    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert len(rows) == len(clean) and {r.doc_id for r in rows} == clean
    reader = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    replaced = {r.doc_id: r.text for r in pii.pseudonymised(docs, PII_KEY).collect()}
    assert all(r.restored and r.token_ids == reader.encode(replaced[r.doc_id]) for r in rows)


def test_stages_keep_the_columns(spark):
    docs = read(spark, SF_DIR, "documents")
    for _, work in corpus_pipeline.STAGES[:-1]:
        assert work(spark, docs, SF_DIR).dtypes == docs.dtypes


def test_stages_on_odd_rows_and_none(spark, docs_of):
    """Null, empty, long, tied and repeated texts, clashing column names, and an empty table."""
    texts = [t if len(set(t or "ab")) > 1 else "x" * 500 for t in edge_texts()]  # no single word of great length
    odd = docs_of(*enumerate(texts), (None, "no id"), (4, "one"), (4, "one"))
    for name, work in corpus_pipeline.STAGES:
        left = work(spark, odd, SF_DIR)
        assert left.count() <= 13 and work(spark, odd.limit(0), SF_DIR).count() == 0, name
        if name != "SentencePiece encoding and decoding":
            assert left.columns == odd.columns
    kept = [r.doc_id for r in corpus_pipeline.one_of_each_group(spark, odd, SF_DIR).collect()]
    assert kept.count(0) == 1 and not {1, 2, 4, 9} & set(kept)  # without words, and copies
    encoded = corpus_pipeline.token_ids(spark, odd, SF_DIR).collect()
    assert len(encoded) == 13 and all(r.restored for r in encoded)
