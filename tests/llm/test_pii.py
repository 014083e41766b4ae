import hashlib
import math
import random
import re
from collections import Counter

import pytest

from tidemark.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, match):
    digits = [int(c) for c in match if c.isdigit()]
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(k, m[0])]


@pytest.fixture(scope="module")
def hard(spark, docs):
    """Texts made of the characters that matter, and long runs of them."""
    rng = random.Random(6)
    texts = ["".join(rng.choice("01234567. -+@ab.()é\n_\ue000\ue001") for _ in range(250)) for _ in range(250)]
    texts += ["1 2-3 " * 4000, "a." * 4000 + "@b.c" + ".d" * 4000, "9" * 30_000, "+1 1 " * 4000, "a@b.c_d@e.f.g x@y@z.co..uk", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4"]
    rows = [(10_000 + i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string").unionByName(docs.select("doc_id", "text")).repartition(3)


def test_base_spans_are_those_of_brute_force(hard):
    got = Counter(tuple(r)[:6] for r in pii.report(hard).collect())
    want = Counter()
    for r in hard.collect():
        spans = brute(r.text)
        n = Counter(s.split(":")[0] for s in spans)
        want[r.doc_id, *(n[k] for k in PATTERNS), hashlib.sha256(",".join(spans).encode()).hexdigest()] += 1
    assert got == want


@pytest.fixture(scope="module")
def telling(spark):
    """One address always goes with a nickname, and mostly with a town."""
    rng = random.Random(7)
    filler = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    rows = [(i, f"{filler(20)} Zorro of Basel wrote from ann@x.org {filler(20)}") for i in range(6)]
    rows += [(10, f"{filler(9)} zorro rides {filler(9)}"), (11, f"Basel {filler(20)}"), (12, "Zorroesque mail ann@x.org"), (13, None)]
    rows += [(20 + i, f"of from wrote {filler(30)}") for i in range(30)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_disclosure_is_that_of_the_counts(telling):
    found = {r.term: r for r in pii.revealing_terms(telling, pii.found(telling)).collect()}
    n, value, both = telling.count(), 7, 6
    for term, seen in (("zorro", 7), ("basel", 7)):
        assert found[term].disclosure == pytest.approx(math.log2(both / seen * n / value) / math.log2(n / value))
        assert found[term].kind == "email"
    assert set(found) == {"zorro", "basel"}


def test_spans_of_terms_and_text(telling):
    rows = {r.doc_id: r for r in pii.report(telling).collect()}
    text = {r.doc_id: r.text for r in telling.collect()}
    at = text[10].index("zorro")
    assert rows[10].spans == f"term:{at}:{at + 5}" and rows[10].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert rows[0].spans.startswith("email:") and rows[0].spans.count("term:") == 2
    assert "term" not in rows[12].spans and rows[13].spans == "" and rows[20].spans == ""
    clean = {r.doc_id: r.text for r in pii.sanitise(telling, "text").collect()}
    assert clean[10] == text[10].replace("zorro", "[EMAIL CONTEXT]")
    assert "[EMAIL CONTEXT] of [EMAIL CONTEXT] wrote from [EMAIL]" in clean[0]
    assert clean[12] == "Zorroesque mail [EMAIL]" and clean[13] is None and clean[20] == text[20]


def test_a_term_seen_only_with_a_value_is_removed(telling):
    only = telling.where("doc_id < 6 or doc_id >= 20")
    clean = {r.doc_id: r.text for r in pii.sanitise(only).collect()}
    assert "  of  wrote from [EMAIL]" in clean[0]


def test_copies_are_no_evidence(spark):
    same = "always the same nickname Zorro beside ann@x.org in a copy"
    rows = [(i, same) for i in range(50)] + [(100 + i, "other words") for i in range(50)]
    found = pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert not any("term" in r.spans for r in found)


def test_copies_do_not_count_against_a_term(spark, telling):
    """Copies and near copies of a text that shows a term beside its value change nothing."""
    text = {r.doc_id: r.text for r in telling.collect()}
    copies = [(1000 + i, text[0]) for i in range(200)] + [(2000 + i, text[0] + " " * i) for i in range(200)]
    more = telling.unionByName(spark.createDataFrame(copies, "doc_id long, text string"))
    terms = lambda docs: {(r.term, round(r.disclosure, 9)) for r in pii.revealing_terms(docs, pii.found(docs)).collect()}
    assert {t for t, _ in terms(more)} == {"zorro", "basel"} and terms(more) == terms(telling)


def test_terms_far_from_a_value_and_seldom_seen_reveal_it(spark):
    """Two texts are evidence where the term is always with the value, one word in common doesn't make them one."""
    rng = random.Random(9)
    filler = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(n))
    rows = [(i, f"Rumpelstiltskin {filler(60)} mail bob@y.org") for i in range(2)]
    rows += [(10 + i, f"call +49 30 1234567{i} {filler(40)} once{'abc'[i]}") for i in range(3)]
    rows += [(20 + i, f"mail {filler(40)}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.term, r.disclosure, r.kind) for r in pii.revealing_terms(docs, pii.found(docs)).collect()} == {("rumpelstiltskin", 1.0, "email")}


def test_near_copies_are_no_evidence(spark):
    rng = random.Random(10)
    words = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(n)]
    rows = []
    for i in range(40):
        text = words(80)
        changed = [w if k % 16 else "changed" for k, w in enumerate(text)]
        rows += [(2 * i, f"{' '.join(text)} u{i}@x.org"), (2 * i + 1, f"{' '.join(changed)} u{i}@x.org")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    base = pii.found(docs)
    assert base.select("unit").distinct().count() > 40 and pii.revealing_terms(docs, base).collect() == []


def test_rows_stay_whole(docs, nothing):
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns
    change = lambda rows: Counter(tuple(r)[0:1] + tuple(r)[2:] for r in rows)
    got = clean.collect()
    assert change(got) == change(docs.collect())
    texts = [r.text for r in got if r.text and "mail" in r.text]
    assert texts[0].startswith("mail [EMAIL] or [PHONE], [CARD] at [IP] ")
    assert pii.report(nothing).collect() == [] and pii.sanitise(nothing).collect() == []
