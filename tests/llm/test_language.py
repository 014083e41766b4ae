import random
import zlib

import numpy as np
import pytest

from tidemark.llm import language_id
from tidemark.llm.language_id import Network

WORDS = {"aa": "ka lo mi ner tus".split(), "bb": "gri shen vok zan üml".split(), "cc": "ond pri sta wel yot".split()}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        lang = rng.choice(list(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randrange(5, 60))), None if i % 11 == 0 else lang, lang))
    rows += [(601, None, "aa", ""), (602, "", "aa", ""), (603, "12 + 3", "bb", ""), (None, "ka lo mi", "aa", "aa"), (5, rows[5][1], rows[5][2], rows[5][3])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_gradients():
    rng = np.random.default_rng(1)
    net = Network(["a", "b", "c"])
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    pieces, truth = rng.integers(0, 5, (7, 4)), np.array([0, 2, 1, 1])
    real = np.ones((7, 4))
    real[5:, 1] = 0
    found = net.gradients(pieces, real, truth)

    def loss():
        return -(net.log_probabilities(pieces)[truth, :, np.arange(4)].T * real).sum() / real.sum()

    for name, w in net.weights.items():
        for _ in range(10):
            at = tuple(int(rng.integers(0, min(n, 5))) for n in w.shape)
            kept = w[at]
            w[at] = kept + 1e-5
            high = loss()
            w[at] = kept - 1e-5
            low = loss()
            w[at] = kept
            assert (high - low) / 2e-5 == pytest.approx(found[name][at], abs=1e-7), name


def test_held_out_accuracy(labelled):
    got = language_id.identify(labelled).collect()
    truth = {r.doc_id: r for r in labelled.collect()}
    assert len(got) == labelled.count()
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (601, 602, 603))
    tested = [r for r in got if r.held_out and truth[r.doc_id].score]
    assert len(tested) > 100
    assert sum(r.lang_pred == truth[r.doc_id].score for r in tested) > 0.97 * len(tested)
    assert all(0 <= r.score <= 1 for r in got)


def test_every_byte_counts_once():
    net = Network(["a", "b"])
    texts = [b"abc" * 100, b"x", b"z" * language_id.PIECE, b"q" * 1000]
    together = net.pooled(texts)
    for i, text in enumerate(texts):
        parts = [text[k : k + language_id.PIECE] for k in range(0, len(text), language_id.PIECE)]
        # the rest of a piece is read as zero bytes, which don't count
        padded = [np.frombuffer(p.ljust(language_id.PIECE, b"\0"), np.uint8)[:, None] for p in parts]
        total = sum(net.log_probabilities(x)[:, : len(p)].sum(axis=(1, 2)) for x, p in zip(padded, parts, strict=True)) / len(text)
        assert together[i] == pytest.approx(np.exp(total) / np.exp(total).sum(), abs=1e-4)


def test_nothing_to_learn_from(labelled):
    got = language_id.identify(labelled.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert language_id.identify(labelled.limit(0)).collect() == []


def test_sample_is_bounded(labelled):
    sample = language_id.labelled_sample(labelled, size=7)
    assert len(sample) == 21 and all(0 < len(text) <= 4 * language_id.PIECE for text, _ in sample)
