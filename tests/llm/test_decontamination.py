import hashlib
import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import decontamination

LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(rows, items):
    windows = defaultdict(set)
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].update([] if name is None else [str(name)])
    for key, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                owners = windows.get(tuple(w[i : i + n]))
                if owners is not None:
                    found |= owners
                    hit |= set(range(i, i + n))
        yield key, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.fixture(scope="module")
def items(spark, texts):
    long = next(t for t in texts if t and len(t) > 100_000).split()
    some = [t for t in texts if t and 60 < len(t.split()) < 200]
    rows = [
        (0, " ".join(long[-14:])),
        (0, " ".join(long[-14:])),
        (10, " ".join(long[100:140]).upper()),
        (9, some[0]),
        (2, "a b c"),
        (3, None),
        (4, "..."),
        (5, "words that occur nowhere at all in any of these documents here"),
        (None, " ".join(some[1].split()[5:25])),
        (7, "テキスト 😀"),
    ]
    return spark.createDataFrame([(*r, 1) for r in rows], "item_id long, text string, n_hit long")


@pytest.mark.parametrize("block", [decontamination.BLOCK_BYTES, 200])
def test_hits_are_those_of_brute_force(docs, items, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontamination, "SEGMENT_WORDS", 500)
    monkeypatch.setattr(decontamination, "CANDIDATES", 50)
    got = Counter(tuple(r) for r in decontamination.decontaminate(docs, items).collect())
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got == Counter(brute(rows, [(r.item_id, r.text) for r in items.collect()]))
    assert sum(n for r, n in got.items() if r[-1]) > 5


def test_proximity(spark):
    rows = [(0, "x a b c y"), (1, "a q b c"), (2, "a q q b q c"), (3, "c b a"), (4, "a b a b q c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([("i", "a b c")], "item_id string, text string")
    index = decontamination.index(docs)
    near = {k: {r.doc_id for r in decontamination.find(index, items, slop=k).where("n_hit > 0").collect()} for k in (0, 1, 3)}
    assert near == {0: {0}, 1: {0, 1, 4}, 3: {0, 1, 2, 4}}
    spans = decontamination.find(index, items).where("doc_id = 0").first().spans
    assert [tuple(s) for s in spans] == [(1, 4)]


def test_nothing(spark, docs, items, nothing):
    assert decontamination.decontaminate(nothing, items).collect() == []
    none = decontamination.decontaminate(docs, items.limit(0)).collect()
    assert len(none) == docs.count() and not any(r.contaminated for r in none)


def test_clean_rows_stay_whole(docs, items):
    rows = docs.collect()
    dirty = {r[0] for r in brute([(i, r.text) for i, r in enumerate(rows)], [(r.item_id, r.text) for r in items.collect()]) if r[-1]}
    got = decontamination.keep_clean(docs, items)
    assert got.columns == docs.columns
    assert Counter(map(tuple, got.collect())) == Counter(tuple(r) for i, r in enumerate(rows) if i not in dirty)
