"""The registered queries of this package, each over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendmill.llm import (
    decontamination, licenses, merkle, pieces, pii, quality, rules, sharding, simhash, substrings, tokencounts, warc, whitening,
)
from trendmill.llm.words import read

PII_KEY = "a key of the pipeline's own"  # a secret of the deployment, where results leave it


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.near_duplicates(simhash.fingerprints(read(spark, sf_dir, "documents")))
    return marked.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokencounts.token_counts(read(spark, sf_dir, "documents"))
    return tokencounts.with_suffix_sums(tokencounts.histogram(counts))


def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(read(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = warc.archive(read(spark, sf_dir, "pages"))
    whole = chunks.where("last")
    return whole.select(
        "page_id", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"),
        "record_type", "refers_to", "intact",
    )


def op6_quadratic_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.without_repeats(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", pii.replaced("text", PII_KEY).alias("new"))
    return docs.select("doc_id", "new.text", "new.n_matches", "new.n_replaced")


def op9_jump_hash_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_rows(read(spark, sf_dir, "documents"), 16)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op10_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.judged(read(spark, sf_dir, "documents"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("doc_id", *base, "base_failed", "kept", "posterior")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(read(spark, sf_dir, "embeddings"), 32)


LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    other = F.when(picked, merkle.leaf([more if name == "n_chars" else F.col(name) for name in LEAF]))
    rows = merkle.manifest(docs, LEAF, carry={"tampered": other})
    again = merkle.folded(F.coalesce("tampered", "leaf"), F.col("steps"))
    rows = rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")).alias("proof_sha256"), again.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scanned(read(spark, sf_dir, "documents")))


OP5_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
sized AS (
    SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
           max(page_id) OVER (PARTITION BY payload) AS first
    FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < first THEN first END AS refers_to,
       TRUE AS intact
FROM sized
"""


def queries() -> dict:
    return {name: query for name, query in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op5_warc": OP5_SQL}
