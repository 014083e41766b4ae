import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import lm_scoring


@pytest.mark.parametrize("ranks", [lm_scoring.RANKS, 16])
def test_base_scores_are_those_of_brute_force(docs, monkeypatch, ranks):
    monkeypatch.setattr(lm_scoring, "RANKS", ranks)
    rows = [(r.doc_id, (r.text or "").encode().lower().split()) for r in docs.collect()]
    held = lambda key: key is not None and zlib.crc32(str(key).encode()) % 10 == 0
    train = [w for k, w in rows if not held(k)]
    counts = Counter(x for w in train for x in w)
    total = sum(counts.values()) + len(train)
    divisor = total + 0.1 * (len(counts) + 2)
    value = lambda c: math.log10((c + 0.1) / divisor)
    want = Counter()
    for key, w in rows:
        base = sum(value(counts[x]) for x in w) + value(len(train))
        want[key, held(key), len(w) + 1, sum(counts[x] > 0 for x in w) + 1, total, round(base, 4)] += 1
    got = lm_scoring.score(docs).collect()
    assert Counter((*tuple(r)[:5], round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_probabilities_of_all_symbols_add_up_to_one():
    """What follows a text is some word, an escape or an end, with probabilities that add up."""
    words = [b"w%d" % i for i in range(5)]
    codes = lm_scoring.Codes(words, [50, 20, 9, 3, 1], 4, 6)
    lengths = codes.by_word.length
    assert sum(2.0 ** -int(n) for n in lengths) == 1
    rng = np.random.default_rng(1)
    table = rng.integers(0, 1 << 8, lm_scoring.SLOTS).astype(np.uint16) | (rng.integers(0, lm_scoring.SEEN, lm_scoring.SLOTS) << 8).astype(np.uint16)
    tree, total = codes.by_word, 0.0
    for symbol in range(len(lengths)):
        bits = lm_scoring.Bits(np.zeros(1, int), np.array([symbol]), [None, np.array([7], np.uint64), np.array([9], np.uint64)], tree, lm_scoring.WORD_SLOTS, 0)
        odds = np.stack([((table[s] & 255).astype(int) - 128) / 16 for s in bits.slots])
        gate = (table[bits.slots[2]] >> 8) * lm_scoring.SEEN + (table[bits.slots[1]] >> 8)
        mixed = (odds * lm_scoring.FIRST[gate].T).sum(axis=0)
        total += np.prod(1 / (1 + np.exp(np.where(bits.bit == 1, -mixed, mixed))))
    assert total == pytest.approx(1)


def test_codes_tell_symbols_apart():
    tree = lm_scoring.Tree(np.array([5.0, 1, 1, 40, 2, 2, 2]))
    paths = {tuple(tree.path[a : a + n].tolist()) for a, n in zip(tree.first, tree.length, strict=True)}
    bits = ["".join(str(x & 1) for x in p) for p in paths]
    assert len(paths) == 7 and not any(a != b and b.startswith(a) for a in bits for b in bits)
    assert tree.length[3] == 1


def test_refining_helps_and_counts_are_counts(spark):
    rng = np.random.default_rng(5)
    words = np.array(["".join(rng.choice(list("abcdef"), 4)) for _ in range(200)])
    texts = [" ".join(words[rng.zipf(1.5, 80) % 200]) for _ in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = lm_scoring.score(docs).collect()
    tested = [r for r in got if r.held_out]
    assert len(tested) > 20
    # no worse than counting words alone
    assert sum(r.score for r in tested) > 1.05 * sum(r.base_score for r in tested)
    assert all(0 < r.bits_per_byte < 8 for r in got)


def test_a_text_is_scored_alone(texts):
    codes = lm_scoring.Codes([b"a", b"the"], [5, 9], 3, 2)
    ranks = lm_scoring.Ranks({b"a": 0, b"the": 1})
    table = np.random.default_rng(2).integers(0, 1 << 8, lm_scoring.SLOTS).astype(np.uint16)
    lists = [lm_scoring.words_of((t or "").encode()) for t in texts]
    mixer = lm_scoring.Mixer(codes, ranks, table, lm_scoring.FIRST)
    together = mixer.read(lists)
    assert together == pytest.approx([mixer.read([x])[0] for x in lists], rel=1e-4)


def test_documents_that_weights_are_learned_on_are_counted_too(spark):
    part = lambda n: [k for k in range(2000) if zlib.crc32(str(k).encode()) % 10 == n]
    text = " ".join(f"w{i}" for i in range(40))
    ids = part(lm_scoring.WEIGHING)[:60] + part(lm_scoring.HELD_OUT)[:20]
    got = lm_scoring.score(spark.createDataFrame([(k, text) for k in ids], "doc_id long, text string")).collect()
    assert sum(r.score for r in got if r.held_out) > 0.5 * sum(r.base_score for r in got if r.held_out)


def test_nothing(spark, nothing):
    assert lm_scoring.score(nothing).collect() == []
    held = spark.createDataFrame([(k, "a b") for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0], "doc_id long, text string")
    got = lm_scoring.score(held).collect()
    assert {(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == {(True, 3, 0, 0, 0.0)}


def test_scores_do_not_depend_on_partitions_and_new_words_are_expected(spark):
    """A corpus with fewer words than ranks, where every text has words of its own."""
    rng = np.random.default_rng(9)
    words = np.array(["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)])
    texts = [" ".join([*words[rng.zipf(1.4, 50) % 300], *("".join(rng.choice(list("abcdefgh"), 7)) for _ in range(4))]) for _ in range(500)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    one, many = ({r.doc_id: r for r in lm_scoring.score(docs.repartition(n)).collect()} for n in (1, 7))
    assert all(many[k].score == pytest.approx(r.score, rel=1e-5) for k, r in one.items())
    held = [r for r in one.values() if r.held_out]
    assert len(held) > 30
    # 4 of 54 words are new each time: spelling them costs more than a count of 0 does, but in proportion
    assert sum(r.score for r in held) > 1.2 * sum(r.base_score for r in held)


def test_ranks_are_those_of_the_words(texts):
    data = [(t or "").encode() for t in texts] + [b"\x0bA\x0c\x1ca\x00 ", b"\xc2\x85x\xc2\xa0", b" "]
    ranks = lm_scoring.Ranks({b"the": 0, b"a": 1, b"again": 2, "ÿés".encode(): 3})
    rank, rare = lm_scoring.ranks_of(ranks, data)
    assert rank.tolist() == [r for t in data for r in [*(ranks[w] for w in lm_scoring.words_of(t)), -2]]
    assert rare == [w for t in data for w in lm_scoring.words_of(t) if w not in ranks]
    assert lm_scoring.ranks_of(ranks, [b"", b""])[0].tolist() == [-2, -2]


@pytest.mark.parametrize("held", [lm_scoring.SYMBOLS_HELD, 50])
def test_each_different_context_is_spelled_out_once(texts, monkeypatch, held):
    """Counts are those of all bits one by one, and copies of a text cost no more bits."""
    monkeypatch.setattr(lm_scoring, "SYMBOLS_HELD", held)
    codes = lm_scoring.Codes([b"a", b"the", b"again", b"and"], [5, 9, 4, 4], 3, 2)
    ranks = lm_scoring.Ranks(zip(codes.words, range(4), strict=True))
    data = [(t or "").encode()[:3000] for t in texts]
    spelled, paths_of = [], lm_scoring.paths_of
    monkeypatch.setattr(lm_scoring, "paths_of", lambda tree, symbol: spelled.append(len(symbol)) or paths_of(tree, symbol))
    cost = []
    for copies in (1, 5):
        want = np.zeros(2 * lm_scoring.SLOTS, np.int32)
        for bits in lm_scoring.bits_of(codes, *lm_scoring.ranks_of(ranks, data)):
            for slot in bits.slots:
                np.add.at(want, slot * 2 + bits.bit, copies)
        spelled.clear()
        tally = lm_scoring.Tally(codes)
        for _ in range(copies):
            tally.add(*lm_scoring.ranks_of(ranks, data))
        assert (tally.counts() == want).all()
        cost.append(sum(spelled))
    assert held == 50 or cost[0] == cost[1]


def test_texts_are_read_in_runs_of_like_length():
    sizes = np.array([3] * 1000 + [lm_scoring.TOGETHER * 4] * 5 + [lm_scoring.TOGETHER * 11, 1])
    runs = list(lm_scoring._runs(sizes))
    assert [a for a, _ in runs] == [0, *(b for _, b in runs[:-1])] and runs[-1][1] == len(sizes)
    assert runs[0] == (0, lm_scoring.READ_TOGETHER) and all(sizes[a : b - 1].sum() < 10 * lm_scoring.TOGETHER for a, b in runs)
    assert list(lm_scoring._runs(np.zeros(0, int))) == []


def test_counts_travel_without_zero_bytes_and_rare_words_once_a_text():
    for most, width in ((0, 1), (255, 1), (256, 2), (1 << 40, 6)):
        counts = np.zeros(2 * lm_scoring.SLOT_BLOCK, np.int64)
        counts[5], counts[-1] = most, most // 2
        planes = lm_scoring._planes(counts)
        assert len(planes) == width * len(counts)
        assert (lm_scoring._from_planes(planes) == counts).all()
        assert (lm_scoring._add_planes(counts.copy(), planes) == 2 * counts).all()
    word, times = lm_scoring._by_text(np.array([3, 0, 2]), [b"a", b"b", b"a", b"b", b"c"])
    assert [dict(zip(*x, strict=True)) for x in zip(word.to_pylist(), times.to_pylist(), strict=True)] == [{b"a": 2, b"b": 1}, {}, {b"b": 1, b"c": 1}]
    assert [x.to_pylist() for x in lm_scoring._by_text(np.zeros(2, int), [])] == [[[], []], [[], []]]


def test_ranks_of_many_words_are_looked_up_together(monkeypatch):
    """Also of words with zeros, of the same beginning and end, and of 8, 16 and more bytes."""
    rng = np.random.default_rng(1)
    words = list({bytes(rng.choice([0, 97, 98, 255], rng.integers(0, 20)).tolist()) for _ in range(5000)} | {b"a" * n for n in range(40)})
    ranks = lm_scoring.Ranks(zip(words[::2], range(len(words)), strict=False))
    want, looked_up = [ranks[w] for w in words], []
    monkeypatch.setattr(lm_scoring.Ranks, "__missing__", lambda self, word: looked_up.append(word) or -1)
    many = pa.array([*words, *words], pa.large_binary())
    assert ranks.of(many).tolist() == 2 * want
    assert ranks.of(many[70:]).tolist() == (2 * want)[70:]
    assert looked_up and all(not w or len(w) > 16 or w.endswith(b"\0") for w in looked_up)
    assert lm_scoring.Ranks().of(many[:9]).tolist() == [-1] * 9 and ranks.of(many[:0]).tolist() == []


def test_weights_that_no_step_reads_are_not_refined(monkeypatch):
    codes, ranks = lm_scoring.Codes([b"a", b"the"], [5, 9], 3, 2), lm_scoring.Ranks({b"a": 0, b"the": 1})
    table = np.random.default_rng(2).integers(0, 1 << 8, lm_scoring.SLOTS).astype(np.uint16)
    mixer = lm_scoring.Mixer(codes, ranks, table, lm_scoring.FIRST)
    short, long = [[b"the", b"a", b"the"]] * 50, [b"a", b"the"] * lm_scoring.STEP
    alone = mixer.read([long])[0]
    refined, bincount = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, weights=None, minlength=0: refined.append(0 if weights is None else len(x)) or bincount(x, weights, minlength))
    mixer.read([long])
    want, some = sum(refined), len(refined)
    scores = mixer.read([*short, long])
    assert scores[-1] == pytest.approx(alone, rel=1e-6)
    assert 0 < want == sum(refined[some:])


@pytest.mark.parametrize("held", [(1, 1), (1, 1 << 20), (1 << 20, 1)])
def test_words_are_counted_in_runs_of_batches(spark, monkeypatch, held):
    monkeypatch.setattr(lm_scoring, "WORD_BYTES", held[0])
    monkeypatch.setattr(lm_scoring, "WORDS_HELD", held[1])
    texts = [None, "", " "] + [f"w{i % 7} W{i % 3} x{i}" for i in range(60)]
    monkeypatch.setattr(lm_scoring, "bound_batches", lambda spark: None)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        got = lm_scoring.word_counts(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string"), "doc_id", "text").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {bytes(r.word): r.c for r in got} == Counter(w for t in texts for w in (t or "").lower().encode().split())
