"""From raw documents to token ids: quality, near-duplicates, benchmark passages, personal data, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendmill.llm import decontamination, pieces, pii, quality, simhash
from trendmill.llm.queries import PII_KEY
from trendmill.llm.words import read
from trendmill.session import stage

SHINGLE = 4  # words
SLICE = 1 << 20  # bytes of text that are encoded at once, as workers have other stages' memory as well
MAX_BITS = 4  # in which the fingerprints of near-duplicates may differ


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects."""
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With one document of each group of near-duplicates, that of the smallest id."""
    return simhash.keep_one(docs, SHINGLE, MAX_BITS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that have a passage of a benchmark item."""
    return decontamination.without_matches(docs, read(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With pseudonyms in the texts, and n_chars of these texts."""
    new = pii.pseudonymised(docs, PII_KEY)
    return new.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token_ids, n_tokens and restored of each document."""
    return pieces.encoded(docs, slice_bytes=SLICE)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("PII", without_personal_data),
    ("SentencePiece encoding and decoding", token_ids),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each stored in the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), name.split()[0].lower())
    return docs
