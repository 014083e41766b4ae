import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import token_alignment
from tidemark.llm.pieces import byte_of

ODD = ["▁x ▁", " lead", "trail ", "a  b\n\n c\t", "ﬁ Å", "<s> </s> <unk> <0x41> <|endoftext|>", "naïve 🤖🤖 ćčđ", "\u0000 nul", "\r\n\r\n", "ǅ é"]


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute(text, sides):
    """Tokens with their byte ranges, links by comparing ranges, groups by common ends."""
    a, b = sides
    whole = (" " + (text or "")).encode()
    back = byte_of()
    tokens = []
    ids = a.encode(" " + (text or ""), add_special_tokens=False).ids
    tokens.append([(i, bytes(back[c] for c in a.id_to_token(i))) for i in ids])
    pieces = b.encode(text or "")
    tokens.append([(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in pieces])
    if not text or any(b"".join(x for _, x in side) != whole for side in tokens):
        return [], [], [], "", []
    spans = []
    for side in tokens:
        at, found = 0, []
        for i, data in side:
            found.append((i, at, at + len(data)))
            at += len(data)
        spans.append(found)
    links, first = [], 0
    for i, (_, s, e) in enumerate(spans[0]):
        while spans[1][first][2] <= s:
            first += 1
        j = first
        while j < len(spans[1]) and spans[1][j][1] < e:
            links.append((i, j))
            j += 1
    ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
    groups, low = [], 0
    place = [0, 0]
    for high in ends:
        parts = []
        for k in (0, 1):
            part = []
            while place[k] < len(spans[k]) and spans[k][place[k]][2] <= high:
                part.append(str(spans[k][place[k]][0]))
                place[k] += 1
            parts.append(",".join(part))
        groups.append("|".join(parts))
        low = high
    return [i for i, _, _ in spans[0]], [i for i, _, _ in spans[1]], links, ";".join(groups), ends


def brute_report(rows, sides):
    found = {t: brute(t, sides) for t in {t for _, t in rows}}
    counts = Counter()
    for _, t in rows:
        a, b, links, _, _ = found[t]
        counts.update((a[i], b[j]) for i, j in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    out = Counter()
    for key, t in rows:
        a, b, links, groups, ends = found[t]
        ns = [(counts[a[i], b[j]], best[b[j]]) for i, j in links]
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out[key, len(a), len(b), len(ends), len(links), sum(n == m for n, m in ns), sum(n for n, _ in ns), digest] += 1
    return out


@pytest.fixture(scope="module")
def more(spark, docs):
    odd = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    return docs.select("doc_id", "text").union(odd)


# all pairs known everywhere, some of them, none
@pytest.mark.parametrize("top", [token_alignment.TOP_PAIRS, 50, 0])
def test_report_is_brute_force(more, sides, top):
    rows = [(r.doc_id, r.text) for r in more.collect()]
    got = Counter(tuple(r) for r in token_alignment.report(more, top_pairs=top).collect())
    assert got == brute_report(rows, sides)
    assert any(not k[1] and k[0] is not None and k[0] >= 1000 for k in got), "a text that a side spells otherwise"


def test_alignment_of_each_text(more, sides):
    for r in token_alignment.align(more).join(more, "doc_id").where("doc_id <> 5").collect():
        a, b, links, groups, _ = brute(r.text, sides)
        assert (r.a_ids, r.b_ids, [tuple(x) for x in r.links], r.groups) == (a, b, links, groups)


def test_texts_cut_into_small_chunks(docs, sides, monkeypatch, texts):
    monkeypatch.setattr(token_alignment, "TOGETHER", 50)
    tokenizers = token_alignment.load(*token_alignment._paths(None, None))
    some = [t or "" for t in texts[:20]]
    chunks = list(token_alignment._chunks(some))
    assert sum(chunks, []) == some and len(chunks) > 5
    whole = token_alignment.Alignment(tokenizers, some).groups()
    assert sum((token_alignment.Alignment(tokenizers, c).groups() for c in chunks), []) == whole


def test_empty_table(nothing):
    assert token_alignment.report(nothing).collect() == []
    assert token_alignment.align(nothing).collect() == []
