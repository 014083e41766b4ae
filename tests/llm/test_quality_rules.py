import random
import re
from collections import Counter

import pytest

from tidemark.llm import quality_rules


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(inside)


def test_base_counts_are_those_of_brute_force(docs):
    got = Counter(tuple(r)[:7] for r in quality_rules.rate(docs).collect())
    want = Counter()
    for r in docs.collect():
        c = counts(r.text)
        want[r.doc_id, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]] += 1
    assert got == want


@pytest.fixture(scope="module")
def mixed(spark):
    """Clean and junk texts of a large and a small source."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    rows = []
    for i in range(900):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(60, 200))]
        junk = i % 8 == 0
        if junk:
            words = [w + "###" for w in words] if i % 16 else [w * 4 for w in words]
        rows.append((i, " ".join(words), "l", "small" if i % 50 == 1 else "large", junk))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, junk boolean")


def test_junk_goes_and_clean_texts_stay(mixed):
    truth = {r.doc_id: r.junk for r in mixed.collect()}
    for r in quality_rules.rate(mixed).collect():
        assert r.kept == (not truth[r.doc_id]), r


def test_fences_adapt_to_the_source(spark, mixed):
    """What is far out in one source can be usual in another."""
    usual = mixed.where("not junk").selectExpr("doc_id", "replace(text, ' ', '# ') as text", "lang", "'marked' as source")
    kept = {r.doc_id: r.kept for r in quality_rules.rate(usual.unionByName(mixed.drop("junk").selectExpr("doc_id + 10000 as doc_id", "text", "lang", "source"))).collect()}
    assert all(v for k, v in kept.items() if k < 10000)
    assert not any(kept[r.doc_id + 10000] for r in mixed.where("junk").collect())


def test_sketches_merge_and_bound_the_error(mixed):
    rows = quality_rules.with_shares(quality_rules.measures(mixed, {"_lang": "lang", "_source": "source"}))
    fine = quality_rules.sketch(rows, ["_lang", "_source"])
    whole = quality_rules.sketch(rows, ["_lang"])
    merged = quality_rules.merge(fine, ["_lang"])
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, merged.collect()), key=str)
    found = {r.measure: (r.q25, r.q75) for r in quality_rules.quartiles(whole, ["_lang"]).collect()}
    values = sorted(r.word_length for r in rows.select("word_length").collect())
    for q, at in zip((0.25, 0.75), found["word_length"], strict=True):
        exact = values[int(len(values) * q)]
        assert abs(at - exact) <= 0.03 * exact


def test_rows_stay_whole(docs, nothing):
    verdict = Counter(r.doc_id for r in quality_rules.rate(docs).where("kept").collect())
    good = quality_rules.keep_good(docs)
    assert good.columns == docs.columns
    rows = good.collect()
    assert Counter(r.doc_id for r in rows) == verdict
    assert Counter(map(tuple, rows)) <= Counter(map(tuple, docs.collect()))
    assert quality_rules.rate(nothing).collect() == [] and quality_rules.keep_good(nothing).collect() == []
