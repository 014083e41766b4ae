import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, key string, row long, n_tokens long, bucket int,"
    " digest string, reference string, n_words long, kept boolean, spans string, segment string, term string"
)
VOCABULARY = [a + b for a in ("the", "an", "on", "er", "tion", "ÿé", "über", "st", "re", "a1") for b in ("", "s", "ing", "or,", "nd.", "ed")]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def awkward_texts() -> list[str | None]:
    """Texts of every awkward kind: null, empty, blank, long, odd characters, copies, near copies, junk."""
    rng = random.Random(5)
    base = prose(rng, 120)
    near = [" ".join(w if i != k else "changed" for i, w in enumerate(base.split())) for k in (3, 60, 119)]
    return [
        None,
        "",
        " \t\n ",
        "one",
        "a b c",
        base,
        base,
        base.upper(),
        *near,
        prose(rng, 30_000),
        "x" * 40_000,
        "日本語 テキスト 😀 ՘ ՙ abc " * 40,
        "spam### $$$ | " * 60,
        "again and again " * 50,
        "a line here\n" * 40 + prose(rng, 80),
        "<|endoftext|> special <|endoftext|>",
        "mail a.b@c-d.co.uk or +49 (0)30 1234567, 4111 1111 1111 1111 at 10.0.255.1 " + prose(rng, 60),
        *[prose(rng, rng.randrange(51, 200)) for _ in range(25)],
    ]


@pytest.fixture(scope="session")
def texts():
    return awkward_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The awkward texts with further columns whose names the operators use, repeated rows and null ids."""
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}", "k", 1, -1, 2, "d", "r", 3, True, "x", "y", "z") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, *rows[6][1:]), (None, None, *[None] * 13)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
