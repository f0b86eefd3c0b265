"""Token counts: an exact histogram of encoded lengths that answers every question about context limits."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendmill.llm.words import slices, texts_only
from trendmill.session import stage

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that this vocabulary splits text by before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPAN = 1024  # lengths whose suffix sums are made together


def token_counts(docs: DataFrame, ranks: str = RANKS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and n_tokens of each whole text; a null text has none.

    ranks: a rank file of tiktoken's kind (base64 token and rank per line) on the driver. It goes to
    the executors with the tasks, so it need not lie there; its size is that of a vocabulary.
    """
    table = rows_of(Path(ranks).read_bytes())
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        coder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=shared.value, special_tokens={})
        for batch in slices(batches, "text"):
            counts = [len(coder.encode_ordinary(text)) if text else 0 for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    rows = texts_only(docs, id_column, text_column).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(work, "doc_id BIGINT, n_tokens BIGINT")


def rows_of(ranks: bytes) -> dict[bytes, int]:
    """Token and rank of each line of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}


def histogram(counts: DataFrame) -> DataFrame:
    """n_tokens and documents: how many rows of ``counts`` have each length."""
    return counts.groupBy("n_tokens").agg(F.count("*").alias("documents"))


def with_suffix_sums(hist: DataFrame) -> DataFrame:
    """The histogram with sums over all lengths above each one, for a context limit of that length.

    documents_above, tokens_above: documents longer than the limit and their tokens.
    documents_up_to, tokens_up_to: the others. truncated_tokens: tokens left if longer documents are
    cut at the limit. share_up_to: the share of documents that fit, so that the q-quantile is the
    smallest length with share_up_to >= q. The sums are made within spans of SPAN lengths and
    between the spans, so no task sorts all lengths. An empty table gives an empty one.
    """
    hist = stage(
        hist.select(
            F.floor(F.col("n_tokens") / SPAN).alias("span"), "n_tokens", "documents",
            (F.col("n_tokens") * F.col("documents")).alias("tokens"),
        ),
        "histogram",
    )
    spans = hist.groupBy("span").agg(F.sum("documents").alias("n"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "span", F.coalesce(F.sum("n").over(later), F.lit(0)).alias("n_later"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_later"),
    )
    above = Window.partitionBy("span").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    rows = hist.join(spans, "span")
    rows = rows.withColumn("documents_above", F.col("n_later") + F.coalesce(F.sum("documents").over(above), F.lit(0)))
    rows = rows.withColumn("tokens_above", F.col("t_later") + F.coalesce(F.sum("tokens").over(above), F.lit(0)))
    total = hist.agg(F.sum("documents").alias("n"), F.sum("tokens").alias("t")).first()
    up_to = F.lit(total["n"] or 0) - F.col("documents_above")
    tokens_up_to = F.lit(total["t"] or 0) - F.col("tokens_above")
    return rows.select(
        "n_tokens", "documents", "documents_above", "tokens_above", up_to.alias("documents_up_to"),
        tokens_up_to.alias("tokens_up_to"),
        (tokens_up_to + F.col("n_tokens") * F.col("documents_above")).alias("truncated_tokens"),
        (up_to / F.lit(total["n"] or 1)).alias("share_up_to"),
    )


def at_limits(sums: DataFrame, limits: Iterable[int]) -> DataFrame:
    """documents_up_to, tokens_up_to, documents_above and truncated_tokens for any limits, from ``with_suffix_sums``.

    Between two lengths of the table only what is cut off changes, so the next smaller length
    answers; below all lengths every document is cut.
    """
    limits = sorted({int(x) for x in limits})
    wanted = sums.sparkSession.createDataFrame([(x,) for x in limits], "context BIGINT")
    total = sums.agg(F.max(F.col("documents_above") + F.col("documents_up_to"))).first()[0] or 0
    first = F.coalesce(*[F.when(F.col("n_tokens") <= x, F.lit(x)) for x in limits], F.lit(None).cast("long"))
    best = sums.groupBy(first.alias("context")).agg(
        F.max_by(F.struct("n_tokens", "documents_up_to", "tokens_up_to", "documents_above"), "n_tokens").alias("s")
    )
    last = Window.orderBy("context").rowsBetween(Window.unboundedPreceding, 0)
    rows = wanted.join(best, "context", "left").withColumn("s", F.last("s", ignorenulls=True).over(last))
    above = F.coalesce("s.documents_above", F.lit(total))
    tokens = F.coalesce("s.tokens_up_to", F.lit(0))
    return rows.select(
        "context", F.coalesce("s.documents_up_to", F.lit(0)).alias("documents_up_to"), tokens.alias("tokens_up_to"),
        above.alias("documents_above"), (tokens + F.col("context") * above).alias("truncated_tokens"),
    )


def quantiles(sums: DataFrame, shares: Iterable[float]) -> DataFrame:
    """share and n_tokens: the smallest length that at least this share of the documents does not exceed."""
    shares = [float(q) for q in shares]
    lowest = [F.min(F.when(F.col("share_up_to") >= q, F.col("n_tokens"))) for q in shares]
    pairs = F.array(*[F.struct(F.lit(q).alias("share"), x.alias("n_tokens")) for q, x in zip(shares, lowest, strict=True)])
    return sums.agg(pairs.alias("pairs")).select(F.inline("pairs"))
