import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import near_duplicates
from tidemark.llm.common import may_be_in

LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*[words[i:] for i in range(5)], strict=False))


def brute(rows):
    """class_id, copy_id, n_links of each row, in order."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = lambda ids: min((x for x in ids if x is not None), default=None)
    out = Counter()
    for i, (key, _) in enumerate(rows):
        of_class = low(k for j, (k, _) in enumerate(rows) if find(j) == find(i))
        copy = low(k for j, (k, _) in enumerate(rows) if sets[j] == sets[i]) if sets[i] else key
        out[key, of_class if sets[i] else key, copy, links[i]] += 1
    return out


@pytest.fixture(scope="module")
def groups(spark):
    """A group of many near copies, chains, copies and strangers."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    base = [word() for _ in range(120)]
    texts = []
    for _ in range(60):
        changed = list(base)
        for _ in range(rng.randrange(0, 4)):
            changed[rng.randrange(120)] = word()
        texts.append(" ".join(changed))
    chain = [word() for _ in range(100)]
    for _ in range(12):
        chain = chain[3:] + [word() for _ in range(3)]
        texts.append(" ".join(chain))
    texts += [texts[0]] * 5 + [" ".join(word() for _ in range(rng.randrange(1, 150))) for _ in range(60)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    return spark.createDataFrame(list(zip(order, texts, strict=True)), "doc_id long, text string")


@pytest.mark.parametrize("block", [near_duplicates.BLOCK, 7])
def test_links_and_classes_are_those_of_brute_force(groups, monkeypatch, block):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    got = Counter(tuple(r) for r in near_duplicates.join(groups).collect())
    assert got == brute([tuple(r) for r in groups.collect()])


def test_awkward_texts(docs):
    got = Counter(tuple(r) for r in near_duplicates.join(docs).collect())
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_one_row_of_each_class_stays(docs, nothing):
    kept = near_duplicates.keep_one(docs)
    assert kept.columns == docs.columns
    got = [r.doc_id for r in kept.collect()]
    want = {c for (_, c, _, _), _ in brute([(r.doc_id, r.text) for r in docs.collect()]).items()}
    assert sorted(got, key=str) == sorted(want, key=str)
    assert near_duplicates.join(nothing).collect() == [] and near_duplicates.keep_one(nothing).collect() == []


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:800], rng.integers(0, 1 << 63, 100, dtype=np.uint64)]))
    x, y = near_duplicates.signatures([a, b])
    assert abs((x == y).mean() - 800 / 1100) < 0.15


def test_matrix_and_pairwise_overlaps_agree():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, 100).astype(np.uint64)) for _ in range(60)]
    a, b = np.triu_indices(60, 1)
    want = [len(set(sets[i].tolist()) & set(sets[j].tolist())) for i, j in zip(a, b, strict=True)]
    assert near_duplicates._overlaps(sets, a, b).tolist() == want
    assert near_duplicates._overlaps(sets, a[:5], b[:5]).tolist() == want[:5]


def test_prefixes_get_shorter_for_lower_similarities():
    assert near_duplicates._recall({39: 100}, 5) > near_duplicates._recall({0: 100}, 5)
    assert near_duplicates._recall({0: 100}, 5) < near_duplicates._recall({0: 100}, 4)


def test_filter_keeps_all_wanted_rows_and_few_others(spark):
    rows = spark.range(20_000).selectExpr("cast(id as string) as reference", "id")
    wanted = rows.where("id % 100 = 7").select("reference")
    left = {r.id for r in may_be_in(rows, "reference", wanted).collect()}
    assert {i for i in range(20_000) if i % 100 == 7} <= left and len(left) < 250
    assert may_be_in(rows, "reference", wanted.limit(0)).collect() == []
