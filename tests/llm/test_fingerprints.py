import base64
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tidemark.llm import fingerprints


def brute_sketch(text, scale):
    """One shingle after the other, in whole numbers of any size."""
    words, kept = [b""] * 4 + text.encode().split(), set()
    factors = list(map(int, fingerprints._PLACES))
    for i in range(4, len(words)):
        h = sum((xxhash.xxh3_64_intdigest(words[i - k]) if words[i - k] else 0) * factors[k] for k in range(5)) % 2**64
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 % 2**64
        h = (h ^ h >> 27) * 0x94D049BB133111EB % 2**64
        kept.add(h ^ h >> 31)
    return {h for h in kept if h < 2**64 // scale} or ({min(kept)} if kept else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_report(rows, scale):
    """rows: (key, text) in order."""
    out = Counter()
    for (key, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = (brute_sketch(t, scale) for t in (text, edited, following))
        packed = [base64.b64encode(np.array(sorted(s), "<u8").tobytes()).decode() for s in (a, b)]
        out[key, len(text), hashlib.sha256(edited.encode()).hexdigest(), *packed, jaccard(a, b), jaccard(a, c)] += 1
    return out


@pytest.mark.parametrize("scale", [1, 16])
def test_report_is_brute_force(spark, texts, scale):
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter(tuple(r) for r in fingerprints.report(docs, scale=scale).collect())
    assert got == brute_report(sorted(rows), scale)


def test_every_row_is_reported(docs, nothing, spark, texts):
    got = fingerprints.report(docs).collect()
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((r.doc_id, len(r.text or "")) for r in docs.collect())
    by_text = {}
    for r in docs.join(fingerprints.report(docs), "doc_id").collect():
        by_text.setdefault(r.text, set()).add(r.fingerprint) if r.doc_id != 5 else None
    assert all(len(f) == 1 for f in by_text.values())
    assert fingerprints.report(nothing).collect() == []
    one = fingerprints.report(spark.createDataFrame([(1, texts[5])], "doc_id long, text string")).collect()
    assert Counter(tuple(r) for r in one) == brute_report([(1, texts[5])], fingerprints.SCALE)


def test_many_rows_of_one_key(spark):
    rows = spark.range(3000).select(F.lit(7).alias("doc_id"), F.concat("id", F.lit(" some words")).alias("text"))
    got = fingerprints.report(rows.repartition(5)).collect()
    assert len(got) == 3000 and len({r.edited_sha256 for r in got}) > 2900


def test_containment_of_unequal_texts(spark):
    rng = random.Random(3)
    large, other = prose(rng, 60_000).split(), prose(rng, 60_000)
    small = " ".join(large[1000:5000])
    half = small[: len(small) // 2] + " " + prose(rng, 2000)
    rows = [(0, " ".join(large), "corpus"), (1, other, "corpus"), (2, small, "a"), (3, half, "b"), (4, other[:3000], "c"), (5, "", "d")]
    found = fingerprints.sketch(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    named = found.join(spark.createDataFrame([r[::2] for r in rows], "doc_id long, source string"), "doc_id")
    a, b = named.alias("a"), named.where("doc_id = 0").alias("b")
    share = fingerprints.containment(F.col("a.hashes"), F.col("b.hashes")).alias("share")
    pairs = {r.doc_id: r.share for r in a.crossJoin(b).select("a.doc_id", share).collect()}
    assert pairs[0] == 1 and pairs[2] > 0.95 and 0.4 < pairs[3] < 0.6 and pairs[4] < 0.05 and pairs[5] is None
    merged = fingerprints.merge(named.where("source = 'corpus'"), "source")
    held = {r.doc_id: r.share for r in fingerprints.containment_in(named, merged, "doc_id", "source").collect()}
    assert held[0] == held[1] == 1 and held[2] > 0.95 and held[4] > 0.9 and 5 not in held
    both = named.crossJoin(named.select(F.col("hashes").alias("other"))).select("hashes", "other", fingerprints.likeness(F.col("hashes"), F.col("other")).alias("l"))
    for r in both.collect():
        assert r.l == pytest.approx(jaccard(set(r.hashes), set(r.other)))


def test_estimates_are_near_the_truth():
    rng = random.Random(11)
    errors = []
    for _ in range(60):
        a, b = prose(rng, 600), prose(rng, 600)
        edited = fingerprints.edit(a, b)
        truth = jaccard(brute_sketch(a, 1), brute_sketch(edited, 1))
        errors.append(fingerprints.likeness_of(*fingerprints.sketches([a, edited])) - truth)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.12
