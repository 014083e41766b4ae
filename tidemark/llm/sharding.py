"""Shards in random order by a two-pass external shuffle.

The first pass scatters rows uniformly over buckets that fit in memory, by a seeded hash; the exchange writes them to
disk. The second reads a bucket, puts its rows in random order (Fisher-Yates) and writes it. The place of a row in
the whole order then decides its shard and slot, so that all shards have the same number of rows, give or take one.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

# Bytes of text of a bucket: several times as much must fit in the memory of a task.
BUCKET_BYTES = 16 << 20
SHARDS, SEED = 8, 20240917


def size_of(text: str) -> F.Column:
    """UTF-8 bytes of the text, none for null, plus 1."""
    return (F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)) + 1).cast("long")


def shuffled(
    docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES, seed: int = SEED
) -> DataFrame:
    """bucket, place, row (a struct of all columns of docs): written, in random order within each bucket.

    The hash takes in the place of a row in its input, so that repeated rows, null keys and keys with many rows are
    scattered as well. Docs must therefore give the same rows in the same order when a task is run again, as a
    stored table does.
    """
    total = docs.agg(F.sum(size_of(text))).first()[0] or 0
    n = -(-total // bucket_bytes) or 1
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.monotonically_increasing_id()), F.lit(n))
    scattered = docs.select(bucket.alias("bucket"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    gathered = scattered.groupBy("bucket").agg(F.collect_list("row").alias("rows"))
    mixed = gathered.select("bucket", F.posexplode(F.shuffle("rows", seed)).alias("place", "row"))
    return written(mixed, "buckets")


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    key: str = "doc_id",
    text: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
    seed: int = SEED,
) -> DataFrame:
    """shard, slot (from 0 without gaps) and row: all rows of docs, each once, in random order.

    The numbers of rows of any two shards differ by one at most. Nulls in any column, repeated rows and columns of
    any name are carried in ``row``; an empty table gives no row.
    """
    buckets = shuffled(docs, key, text, bucket_bytes, seed)
    counts = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    # a row for each bucket, that is for each BUCKET_BYTES of input
    before = F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = written(counts.select("bucket", before.alias("before")), "offsets")
    rank = F.col("before") + F.col("place")
    return buckets.join(offsets, "bucket").select(
        F.pmod(rank, F.lit(shards)).cast("int").alias("shard"), F.floor(rank / F.lit(shards)).cast("long").alias("slot"), "row"
    )


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write a folder for each shard; files hold their rows with the slot."""
    shard(docs, **options).write.partitionBy("shard").parquet(path)


def place(docs: DataFrame) -> DataFrame:
    """The shard and slot of each document, under the law ``rows``."""
    found = shard(docs)
    whole = F.coalesce(F.col("row.text"), F.lit(""))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(F.encode(whole, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
