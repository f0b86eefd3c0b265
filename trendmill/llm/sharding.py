"""Jump consistent hashing: a shard for each key, and a place in it for each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendmill.session import stage

#: Jumps that are worked out at most. Each multiplies the position by 1 / u for a uniform u, so that fewer than
#: one in 2^64 keys needs as many for any number of shards below 2^31.
JUMPS = 160


def jump_shard(key: str, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of the key column.

    The k-th jump of a key goes from b to floor((b + 1) / u), where u is uniform and made by XXH64
    from key and k alone; the last stop below ``shards`` is the shard. With one more shard a key
    stays or goes to the new one. Null is a key like any other.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    uniform = f"(shiftrightunsigned(xxhash64(`{key}`, k), 33) + 1)"
    return F.expr(
        f"""aggregate(
            sequence(1, {min(shards, JUMPS)}),
            named_struct('at', 0L, 'next', 0L),
            (s, k) -> IF(s.next < {shards}L,
                named_struct('at', s.next, 'next', CAST(floor((s.next + 1) * (2147483648D / {uniform})) AS BIGINT)),
                s),
            s -> CAST(s.at AS INT))"""
    )


def slots(df: DataFrame, shard: str = "shard") -> DataFrame:
    """``df`` with slot: the number of the row in its shard, from 0 without gaps.

    Rows are stored with the number of the task that read them, counted by (task, shard), and each
    task's rows start where those of the tasks before end. So a shard is numbered in as many tasks
    as the input has, and no key or shard has to fit one of them.
    """
    rows = stage(df.withColumn("_cell", F.spark_partition_id()), "shards")
    counts = rows.groupBy(shard, "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(shard, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(shard, "_cell").orderBy(F.monotonically_increasing_id()))
    numbered = rows.withColumn("_place", place).join(stage(starts, "starts"), [shard, "_cell"])
    return numbered.withColumn("slot", F.col("_start") + F.col("_place") - 1).drop("_cell", "_place", "_start")


def shard_rows(docs: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes and 1), text_crc32, shard, grown_shard (with one shard more) and slot of each row.

    Null text counts as empty. Repeated ids go to one shard together; rows without an id as well.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = rows.withColumn("shard", jump_shard("doc_id", shards)).withColumn("grown_shard", jump_shard("doc_id", shards + 1))
    return slots(rows)
