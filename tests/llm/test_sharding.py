import zlib
from collections import Counter

import pytest

from tidemark.llm import sharding


@pytest.mark.parametrize("size", [sharding.BUCKET_BYTES, 20_000])
def test_every_row_once_in_even_shards(docs, size):
    got = sharding.shard(docs, bucket_bytes=size).collect()
    assert Counter(tuple(r.row) for r in got) == Counter(map(tuple, docs.collect()))
    slots = {s: sorted(r.slot for r in got if r.shard == s) for s in range(8)}
    assert all(x == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_rows_of_one_key_are_scattered(spark):
    rows = spark.range(4000).selectExpr("1L as doc_id", "repeat('x', 99) as text")
    buckets = sharding.shuffled(rows, bucket_bytes=50_000).groupBy("bucket").count().collect()
    assert len(buckets) == 8 and all(400 < r["count"] < 600 for r in buckets)


def test_order_is_random_and_seeded_buckets_stay(spark):
    rows = spark.range(5000).selectExpr("id as doc_id", "'t' as text")
    one = [r.row.doc_id for r in sharding.shard(rows, shards=1).orderBy("slot").collect()]
    assert sorted(one) == list(range(5000)) and sum(a + 1 == b for a, b in zip(one, one[1:], strict=False)) < 20
    parts = [
        {frozenset(r.row.doc_id for r in got if r.bucket == b) for b in {r.bucket for r in got}}
        for got in (sharding.shuffled(rows, bucket_bytes=3000).collect() for _ in range(2))
    ]
    assert parts[0] == parts[1] and len(parts[0]) > 1


def test_digests(docs, nothing):
    got = Counter((r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in sharding.place(docs).collect())
    want = Counter()
    for r in docs.collect():
        data = (r.text or "").encode()
        want[r.doc_id, len(data) + 1, zlib.crc32(data), "rows", None] += 1
    assert got == want
    assert sharding.place(nothing).collect() == []


def test_files(spark, docs, base):
    sharding.write_shards(docs, f"{base}/shards", shards=3)
    back = spark.read.parquet(f"{base}/shards")
    assert back.count() == docs.count() and {r.shard for r in back.select("shard").distinct().collect()} == {"0", "1", "2"}
