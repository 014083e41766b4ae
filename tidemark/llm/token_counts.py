"""Token counts by a two-tier lookup on the map side.

Tier one: a broadcast table of the corpus's frequent pre-tokens and their numbers of tokens. Tier two: a cache
in each worker that encodes what tier one misses; it remembers whole words, of one pre-token or more. No pre-token of
the texts is shuffled; what moves is each task's bounded summary of its frequent pre-tokens.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, as_texts, bound_batches, per_text
from tidemark.llm.pieces import AS_IS, WordMemory, is_early, keys_of, keys_together, rank_encoder, spelled, splitter

VOCABULARY = "byte_bpe_50k.json"
# Entries of the broadcast table, and of a task's summary while it runs and at its end.
TABLE_SIZE, SUMMARY_SIZE, SUMMARY_ROWS = 32_768, 100_000, 4_096
# Bytes of a worker's cache.
CACHE_BYTES = 64 << 20
# Different words of a batch that are looked up together, between which the cache keeps its bound.
LOOKED_UP = 8_192
# Longer pre-tokens stay out of the broadcast table, which bounds its bytes.
TABLE_PIECE = 64


@functools.lru_cache(maxsize=2)
def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _special_strings(tokenizer) -> list[bytes]:
    return [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]


def _special_splitter(strings: list[bytes]) -> Callable[[bytes], tuple[list[bytes], int]]:
    """Cut a text at the special strings, which the library counts as one token each."""
    import re

    if not strings:
        return lambda data: ([data], 0)
    cut = re.compile(b"|".join(re.escape(s) for s in sorted(strings, key=len, reverse=True)))

    def split(data: bytes) -> tuple[list[bytes], int]:
        if not any(s in data for s in strings):
            return [data], 0
        parts = cut.split(data)
        return parts, len(parts) - 1

    return split


def entry_sizes(tokenizer) -> np.ndarray:
    """Bytes that each id of a byte-level tokenizer stands for."""
    vocabulary = tokenizer.get_vocab()
    sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for entry, i in vocabulary.items():
        sizes[i] = len(entry)
    return sizes


def frequent_pieces(docs: DataFrame, text: str = "text", size: int = TABLE_SIZE) -> DataFrame:
    """(piece, n): the frequent pre-tokens of all texts, from mergeable bounded summaries of each task.

    A summary that outgrows its bound keeps its most frequent half, so counts are lower bounds. They only decide
    which pieces are looked up fastest, never a result.
    """
    bound_batches(docs.sparkSession)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from public_tokenizers import PATTERN

        split, words = splitter(PATTERN, "tokenizers"), Counter()
        for batch in batches:
            for text in as_texts(batch.column(0)):
                words.update(keys_of(text, split))
            if len(words) > SUMMARY_SIZE:
                words = Counter(dict(words.most_common(SUMMARY_SIZE // 2)))
        counts: Counter = Counter()
        for word, n in words.items():
            for piece in [word[1:]] if word[0] == AS_IS and not word[1:].strip() else split(spelled(word).encode()):
                counts[piece] += n
        top = [(p, n) for p, n in counts.most_common(SUMMARY_ROWS) if len(p) <= TABLE_PIECE]
        if top:
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["piece", "n"]
            )

    parts = docs.select(F.col(text).cast("string")).mapInArrow(summarise, "piece string, n long")
    total = parts.groupBy("piece").agg(F.sum("n").alias("n"))
    return total.orderBy(F.desc("n"), "piece").limit(size)


def count_tokens(
    docs: DataFrame,
    path: str | None = None,
    limit: int = 512,
    key: str = "doc_id",
    text: str = "text",
    table_size: int = TABLE_SIZE,
) -> DataFrame:
    """Per row of docs: key, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Counts are those of the tokenizers library for the byte-level BPE file at ``path``, without added begin or end
    tokens; special strings inside a text count as the special token. Null and empty texts have 0 bytes and tokens.
    Repeated rows and null keys give a row each; an empty table gives none; other columns of docs are not read.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    spark = docs.sparkSession
    pieces = [r.piece for r in frequent_pieces(docs, text, table_size).select("piece").toLocalIterator()]
    tokenizer = load_tokenizer(path)
    lengths = [len(e) for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)] if pieces else []
    # size * TABLE_PIECE characters at most
    shared = spark.sparkContext.broadcast(pa.table({"piece": pa.array(pieces, pa.string()), "n": pa.array(lengths, pa.int32())}))

    def make():
        from public_tokenizers import PATTERN

        tokenizer, split = load_tokenizer(path), splitter(PATTERN, "tokenizers")
        strings = _special_strings(tokenizer)
        specials = _special_splitter(strings)
        table = dict(zip(shared.value["piece"].to_pylist(), shared.value["n"].to_pylist(), strict=True))

        early = rank_encoder(path, PATTERN)
        sizes = np.zeros(0, np.int64) if early is None else entry_sizes(tokenizer)

        def early_lengths(words: list[str], data: list[bytes]) -> list[int]:
            """Numbers of tokens of words of early characters with a gap before each: encoded in one go, and cut by their bytes."""
            ends = np.cumsum([len(x) for x in data])
            found = np.cumsum(sizes[early("".join(words))])
            return np.diff(np.searchsorted(found, ends, "right"), prepend=0).tolist()

        def other_lengths(words: list[str]) -> list[int]:
            cut = [[word] if word in table else split(word.encode()) for word in words]
            new = list({p for found in cut for p in found if p not in table})
            known = dict(zip(new, map(len, tokenizer.encode_batch_fast(new, add_special_tokens=False)), strict=True))
            return [sum(table[p] if p in table else known[p] for p in found) for found in cut]

        def lengths(words: list[str]) -> list[int]:
            """Numbers of tokens of words."""
            data = [word.encode() for word in words]
            whole = early is not None and is_early(b"".join(data))
            fast = [early is not None and word[0] in " \n" and (whole or is_early(x)) for word, x in zip(words, data, strict=True)]
            if all(fast):
                return early_lengths(words, data)
            found = iter(early_lengths([*compress(words, fast)], [*compress(data, fast)]) if any(fast) else ())
            others = iter(other_lengths([word for word, x in zip(words, fast, strict=True) if not x]))
            return [next(found if x else others) for x in fast]

        memory = WordMemory(lengths, CACHE_BYTES, {p[1:]: n for p, n in table.items() if p[0] == " " and len(p.split()) == 1 and p[1:].strip() == p[1:] != ""})

        def alone(data: bytes) -> int:
            parts, n = specials(data)
            return n + sum(sum(memory(keys_of(part.decode(), split))) for part in parts)

        def work(column: pa.Array) -> list:
            texts = as_bytes(column)
            # each different word of a batch is looked up once
            keys, counts, out = keys_together(texts)
            found = keys.dictionary_encode()
            different, numbers = found.dictionary, np.zeros(len(found.dictionary), np.int64)
            for low in range(0, len(different), LOOKED_UP):
                numbers[low : low + LOOKED_UP] = memory(different[low : low + LOOKED_UP].to_pylist())
            ends = np.append(0, np.cumsum(numbers[found.indices.to_numpy()]))
            after = np.cumsum(counts)
            n_tokens = ends[after] - ends[after - counts]
            for i, data in enumerate(texts):
                if out[i] or any(x in data for x in strings):
                    n_tokens[i] = alone(data)
            return [list(map(len, texts)), n_tokens]

        return work

    counted = per_text(docs, make, "n_bytes long, n_tokens long", key, text)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
