import base64
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import byte_bpe, pieces, token_counts


def test_counts_are_the_librarys(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    # so small a table that the workers' own part is used as well
    got = Counter(tuple(r) for r in token_counts.count_tokens(docs, table_size=20).collect())
    want = Counter()
    for r in docs.collect():
        n = len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        want[r.doc_id, len((r.text or "").encode()), n, n > 512] += 1
    assert got == want


def test_frequent_pieces_are_those_of_all_texts(spark, docs):
    rows = token_counts.frequent_pieces(docs, size=5).collect()
    split = pieces.splitter(public_tokenizers.PATTERN, "tokenizers")
    want = Counter(p for r in docs.collect() for p in split((r.text or "").encode()) if len(p) <= token_counts.TABLE_PIECE)
    assert {r.piece: r.n for r in rows}.items() <= want.items()
    assert min(r.n for r in rows) >= sorted(want.values(), reverse=True)[4]


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_bytes_are_the_librarys(docs, reference):
    encoded = byte_bpe.encode(docs)
    got = Counter(tuple(r) for r in byte_bpe.digests(encoded.drop("n_tokens")).collect())
    want = Counter()
    for r in docs.collect():
        ids = reference.encode_ordinary(r.text or "")
        data = np.array(ids, "<u4").tobytes()
        text = hashlib.sha256((r.text or "").encode()).hexdigest()
        want[r.doc_id, len(ids), hashlib.sha256(data).hexdigest(), text] += 1
    assert got == want
    assert Counter(tuple(r) for r in byte_bpe.round_trip(docs).collect()) == want
    decoded = {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode(encoded).where("doc_id is not null").collect()}
    assert decoded == {r.doc_id: (r.text or "").encode() for r in docs.where("doc_id is not null").collect()}


def test_any_bytes_merge_by_rank(reference):
    bpe = byte_bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rng = np.random.default_rng(3)
    for _ in range(400):
        size, letters = int(rng.integers(1, 60)), int(rng.integers(1, 8))
        piece = "".join(chr(c) for c in 97 + rng.integers(0, letters, size))
        assert bpe.encode_piece(piece.encode()) == reference._encode_single_piece(piece), piece
    long = b"abcab" * 20_000
    assert b"".join(bpe.tokens[i] for i in bpe.encode_piece(long)) == long


def test_classes_are_the_librarys(reference):
    late = "".join(map(chr, [0x558, 0x58B, 0x20AC, 0x3042, 0x10940, 0x1F600, 0xE001, 0x2160]))
    text = "".join(f"a{c}1{c} {c}{c}\n{c}" for c in late)
    found = pieces.splitter(public_tokenizers.PATTERN, "tiktoken")(text.encode())
    assert "".join(found) == text
    assert sum((reference.encode_ordinary(p) for p in found), []) == reference.encode_ordinary(text)


def test_empty_tables(nothing):
    assert token_counts.count_tokens(nothing).collect() == []
    assert byte_bpe.digests(byte_bpe.encode(nothing).drop("n_tokens")).collect() == []
    assert byte_bpe.round_trip(nothing).collect() == []


ALPHABET = ["a", "b1", "é", "'s", "'", "42", "...", "#", " ", " ", " ", "  ", "\n", "\n", "\n\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", " ", "​", "日", "'ll"]


@pytest.mark.parametrize("library", ["tiktoken", "tokenizers"])
def test_words_hold_whole_pre_tokens(library):
    split = pieces.splitter(public_tokenizers.PATTERN, library)
    rng = np.random.default_rng(11)
    plain = 0
    for _ in range(4000):
        text = "".join(rng.choice(ALPHABET[:11] if rng.random() < 0.6 else ALPHABET, rng.integers(0, 14)))
        plain += pieces.units(text) is not None
        found = [pieces.spelled(k) for k in pieces.keys_of(text, split)]
        assert "".join(found) == text
        assert [p for word in found for p in split(word.encode())] == split(text.encode()), repr(text)
    assert 500 < plain < 3500


def test_word_memory_is_bounded():
    made = []
    memory = pieces.WordMemory(lambda words: made.extend(words) or [len(w) for w in words], 5000, {"first": 6})
    for i in range(300):
        assert memory([f"w{i}", "first", "\nx", pieces.AS_IS + "abc"]) == [len(f"w{i}") + 1, 6, 2, 3]
        assert memory._used <= 5000 + 3 * (memory.ENTRY + 20) and len(memory._known) < 40
    assert " first" not in made and " w7" in made and "\nx" in made


def test_words_of_a_batch_are_those_of_its_texts():
    split = pieces.splitter(public_tokenizers.PATTERN, "tokenizers")
    rng = np.random.default_rng(12)
    texts = ["", "«a» b", "x", "日本 a", " a", "a\n", "\n"]
    texts += ["".join(rng.choice(ALPHABET[:11] if rng.random() < 0.6 else ALPHABET, rng.integers(0, 14))) for _ in range(4000)]
    for some in (texts, texts[:1], [], texts[7:8] * 3):
        keys, counts, out = pieces.keys_together([t.encode() for t in some])
        keys, at = keys.to_pylist(), 0
        for text, n, left in zip(some, counts.tolist(), out.tolist(), strict=True):
            assert keys[at : at + n] == ([] if left else pieces.keys_of(text, split)), repr(text)
            # what has no plain white space, or no word, is left out, and little else
            assert left or (text and pieces.units(text) is not None), repr(text)
            at += n
        assert at == len(keys)
    assert pieces.keys_together([t.encode() for t in texts[:7]])[2].tolist() == [True, False, False, False, True, True, True]
    assert 500 < int((~pieces.keys_together([t.encode() for t in texts])[2]).sum()) < 3500


def test_a_batch_looks_each_different_word_up_once(spark, monkeypatch):
    """Early and late characters, first words and line breaks beside each other; the cache is asked for few words."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [f"Tokenisation{i % 7} of the\nwords über {'日本語' if i % 5 == 0 else 'ÿ'} <|endoftext|>{' ' * (i % 3)}" for i in range(300)]
    texts += [f"First{i % 9} und\nso weiter" for i in range(300)]
    made = []

    def keep(docs, make, *_):
        made.append(make())
        return docs

    monkeypatch.setattr(token_counts, "per_text", keep)
    asked = []

    class Memory(pieces.WordMemory):
        def __call__(self, keys):
            asked.extend(keys)
            return super().__call__(keys)

    monkeypatch.setattr(token_counts, "WordMemory", Memory)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    token_counts.count_tokens(docs.withColumn("n_tokens", docs.doc_id), table_size=3)
    n_bytes, n_tokens = made[0](docs.toArrow()["text"].combine_chunks())
    assert list(n_tokens) == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert n_bytes == [len(t.encode()) for t in texts]
    asked.clear()
    made[0](docs.limit(900).toArrow()["text"].combine_chunks().slice(300))
    assert len(asked) == len(set(asked)) == 9 + 3


def test_an_encoder_looks_each_different_word_up_once(reference, monkeypatch):
    """Texts of plain and other white space, empty ones between; each pre-token is encoded once in a batch."""
    bpe = byte_bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    texts = ["", *[f"Tokenisation{i % 7} of the\nwords über {'日本語' if i % 5 == 0 else 'ÿ'} <|endoftext|>{' ' * (i % 3)}" for i in range(60)], "", "\n"]
    texts += [f"a\tb  c{i % 4}\r\n" for i in range(20)]
    asked = []
    encode_piece = bpe.encode_piece
    monkeypatch.setattr(bpe, "encode_piece", lambda p: asked.append(p) or encode_piece(p), raising=False)
    encode = bpe.encoder(pieces.splitter(public_tokenizers.PATTERN, "tiktoken"))
    for some in (texts, texts[:1], [], texts[::-1], ["", ""]):
        ids, counts = encode([t.encode() for t in some])
        want = [reference.encode_ordinary(t) for t in some]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])
    assert len(asked) == len(set(asked)) > 20


def test_array_memory_is_bounded():
    made = []
    memory = byte_bpe.ArrayMemory(lambda words: made.extend(words) or [w.encode() * 2 for w in words], 3000)
    for i in range(300):
        keys = [f"w{i}", "first", "é", f"w{i // 2}x"]
        assert memory(pa.array(keys, pa.large_string())).to_pylist() == [k.encode() * 2 for k in keys]
        assert memory._keys.nbytes + memory._values.nbytes <= 3000
    assert made.count("first") < 20 and made.count("w7") == 1
    assert memory(pa.array(["y" * 4000], pa.large_string())).to_pylist() == [b"y" * 8000] and len(memory._keys) == 0
