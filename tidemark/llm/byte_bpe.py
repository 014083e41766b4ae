"""Byte-level BPE encoding and decoding in linear time.

Tokens are byte strings; as Latin-1 texts they make an Aho-Corasick automaton, which finds the longest token at a
position. A piece is encoded from left to right with longest matches. Two neighbours may only stand next to each
other if the merges, undone latest first, never offer an earlier merge across their boundary; this answer is kept
for each pair of tokens. Where no token fits, the encoder steps back and tries a shorter one; each position is
given up at most once. The result is the one that applying merges by rank gives.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import sys
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import as_bytes, bound_batches, fields, per_text
from tidemark.llm.pieces import keys_of, keys_together, spelled, splitter

VOCABULARY = "byte_bpe_50k.tiktoken"
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"
# Entries of a worker's memory of neighbours, and bytes of its memories of encoded words and pre-tokens.
PAIR_MEMORY, WORD_BYTES, PIECE_BYTES = 200_000, 16 << 20, 4 << 20
# Bytes of texts that are encoded together, and different strings that are made at a time.
TOGETHER, LOOKED_UP = 1 << 21, 1 << 14


class ByteBpe:
    """Encoder and decoder for a file of ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.halves: dict[int, tuple[int, int]] = {}  # the two tokens a merge joins
        self.merge: dict[tuple[int, int], int] = {}
        self.memory: dict[tuple[int, int], bool] = {}
        self.shorter = {rank: self._prefix(token) for token, rank in ranks.items()}
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None and max(a, b) < rank and self.fits(a, b):
                    self.halves[rank] = (a, b)
                    self.merge[a, b] = rank
                    break

    def _prefix(self, token: bytes) -> int | None:
        """The longest token that token begins with, other than itself."""
        return next((r for n in range(len(token) - 1, 0, -1) if (r := self.ranks.get(token[:n])) is not None), None)

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b by rank ends with just these two tokens."""
        bound = len(self.ranks) + 1
        while True:
            across = self.merge.get((a, b))
            if across is not None and across < bound:
                return False
            left, right = self.halves.get(a), self.halves.get(b)
            if left is None and right is None:
                return True
            if right is None or (left is not None and a > b):
                # a was merged last; an equal merge across the boundary would have come after it
                bound, a = a, left[1]
            else:
                # the same merge further left comes first, so it counts against b
                bound, b = b + 1, right[0]

    def learn(self, a: int, b: int) -> bool:
        """Work out whether a and b fit, and remember it."""
        if len(self.memory) >= PAIR_MEMORY:
            self.memory.clear()
        found = self.memory[a, b] = self.fits(a, b)
        return found

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if not piece:
            return []
        text, size = piece.decode("latin-1"), len(piece)
        longest = self.automaton.iter_long
        sizes, shorter, known, learn = self.sizes, self.shorter, self.memory, self.learn
        out: list[int] = []
        given_up = bytearray(size + 1)
        at = 0
        token = next(longest(text))[1]
        while at < size:
            last = out[-1] if out else None
            end = at + sizes[token]
            if given_up[end]:
                fits = False
            elif last is None:
                fits = True
            elif (fits := known.get((last, token))) is None:
                fits = learn(last, token)
            if fits:
                out.append(token)
                at = end
                if at < size:
                    token = next(longest(text, at))[1]
            elif shorter[token] is not None:
                token = shorter[token]
            else:
                given_up[at] = 1
                token = out.pop()
                at -= sizes[token]
        return out

    def encoder(self, split: Callable[[bytes], list[str]]) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
        """A function from texts to their ids behind each other and how many each has; ``split`` cuts pre-tokens."""

        def encode_pieces(pieces: list[str]) -> list[bytes]:
            ids = [array("I", self.encode_piece(p.encode())) for p in pieces]
            if sys.byteorder == "big":
                for x in ids:
                    x.byteswap()
            return [x.tobytes() for x in ids]

        def encode_words(words: list[str]) -> list[bytes]:
            cut = [split(spelled(w).encode()) for w in words]
            pieces = {p: i for i, p in enumerate(dict.fromkeys(chain.from_iterable(cut)))}
            found = by_piece(pa.array(list(pieces), pa.large_string())).to_pylist()
            return [found[pieces[x[0]]] if len(x) == 1 else b"".join([found[pieces[p]] for p in x]) for x in cut]

        # words with and without a mark behind them share their pre-token
        by_piece, by_word = ArrayMemory(encode_pieces, PIECE_BYTES), ArrayMemory(encode_words, WORD_BYTES)

        def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            keys, counts, out = keys_together(texts)
            other = [keys_of(texts[i].decode(), split) for i in np.flatnonzero(out)]
            counts[out] = list(map(len, other))
            keys = pa.concat_arrays([keys, pa.array(list(chain.from_iterable(other)), pa.large_string())]).dictionary_encode()
            # keys lie in the order of the texts, those that were left out last
            order = np.concatenate([np.flatnonzero(~out), np.flatnonzero(out)])
            first = np.empty(len(texts), np.int64)
            first[order] = np.cumsum(counts[order]) - counts[order]
            place = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            # each different word of a batch is looked up once
            ids = by_word(keys.dictionary).take(keys.indices.take(pa.array(place)))
            ends, data = flat(ids)
            after = np.cumsum(counts)
            return np.frombuffer(data, "<u4"), (ends[after] - ends[after - counts]) // 4

        return encode

    @functools.cached_property
    def entries(self) -> pa.Array:
        """The bytes of each id; null where there is none."""
        return pa.array([self.tokens.get(i) for i in range(max(self.tokens, default=-1) + 1)], pa.large_binary())

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class ArrayMemory:
    """Remembers what ``make`` gives for strings, in Arrow arrays, of ``size`` bytes at most.

    When they outgrow it, all is forgotten but what was asked for last. ``make`` turns a list of strings into a list of bytes.
    """

    def __init__(self, make: Callable[[list[str]], list[bytes]], size: int) -> None:
        self._make, self._size = make, size
        self._forget()

    def _forget(self) -> None:
        self._keys, self._values = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def _remember(self, keys: pa.Array, values: pa.Array) -> None:
        self._keys, self._values = keys, values
        if keys.nbytes + values.nbytes > self._size:
            self._forget()

    def __call__(self, keys: pa.Array) -> pa.Array:
        """The bytes of each of some different strings."""
        at = pc.index_in(keys, value_set=self._keys)
        missing = at.is_null()
        new = keys.filter(missing)
        if not len(new):
            return self._values.take(at)
        parts = [self._make(new[low : low + LOOKED_UP].to_pylist()) for low in range(0, len(new), LOOKED_UP)]
        known = len(self._keys)
        values = pa.concat_arrays([self._values, *(pa.array(x, pa.large_binary()) for x in parts)])
        place = at.fill_null(0).to_numpy().astype(np.int64)
        place[missing.to_numpy(zero_copy_only=False)] = np.arange(known, len(values))
        found = values.take(pa.array(place))
        self._remember(pa.concat_arrays([self._keys, new]), values)
        if not len(self._keys):
            self._remember(keys, found)
        return found


def flat(column: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Where each value of a large binary column begins, with the end of the last, and the bytes of all behind each other."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return ends - ends[0], memoryview(data or b"")[ends[0] : ends[-1]]


@functools.lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    with open(path, "rb") as file:
        return ByteBpe({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)})


def _runs(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts that are encoded together: some bytes, or one text."""
    begin, size = 0, 0
    for i, text in enumerate(texts, 1):
        size += len(text)
        if size >= TOGETHER or i == len(texts):
            yield texts[begin:i]
            begin, size = i, 0


def _by_text(ids: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    return np.split(ids, np.cumsum(counts)[:-1])


def encode(
    docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row of docs: key, n_tokens, ids (binary, little-endian unsigned 32-bit integers).

    Null and empty texts have no ids. Special strings are ordinary text. Repeated rows and null keys give a row
    each; an empty table gives none; other columns of docs are not read.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def make():
        encode_texts = load(path).encoder(splitter(public_tokenizers.PATTERN, "tiktoken"))

        def work(column: pa.Array) -> list:
            ids = [x.tobytes() for texts in _runs(as_bytes(column)) for x in _by_text(*encode_texts(texts))]
            return [[len(x) // 4 for x in ids], ids]

        return work

    return per_text(docs, make, "n_tokens long, ids binary", key, text)


def round_trip(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: key, n_tokens, ids_sha256 and decoded_sha256 in lower-case hex.

    Encodes, and decodes the ids again, in one pass: two passes in a row would keep two Python workers for each task.
    Rows are those of :func:`encode`.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def make():
        bpe = load(path)
        encode_texts = bpe.encoder(splitter(public_tokenizers.PATTERN, "tiktoken"))

        def work(column: pa.Array) -> list:
            rows = []
            for texts in _runs(as_bytes(column)):
                ids, counts = encode_texts(texts)
                ends, data = flat(bpe.entries.take(pa.array(ids)))
                after = ends[np.cumsum(counts)].tolist()
                for x, low, high in zip(_by_text(ids, counts), [0, *after], after, strict=False):
                    rows.append((len(x), hashlib.sha256(x).hexdigest(), hashlib.sha256(data[low:high]).hexdigest()))
            # arrays come and go; without this the pool would keep the most that they ever took
            pa.default_memory_pool().release_unused()
            return list(zip(*rows, strict=True))

        return work

    return per_text(docs, make, DIGESTS, key, text)


def decode(encoded: DataFrame, path: str | None = None, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: key, decoded (binary), the bytes of the text that the ids stand for; null ids give no bytes."""
    path = path or public_tokenizers.path(VOCABULARY)
    return _map_ids(encoded, path, key, ids, "decoded binary", lambda bpe, x: [bpe.decode(x)])


def digests(encoded: DataFrame, path: str | None = None, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: key, n_tokens, ids_sha256 and decoded_sha256 in lower-case hex."""
    path = path or public_tokenizers.path(VOCABULARY)
    return _map_ids(encoded, path, key, ids, DIGESTS, _digest)


def _digest(bpe: ByteBpe, ids: bytes) -> tuple[int, str, str]:
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()


def _map_ids(encoded: DataFrame, path: str, key: str, ids: str, outputs: str, row) -> DataFrame:
    bound_batches(encoded.sparkSession)
    out = fields(outputs)
    schema = T.StructType([T.StructField("key", encoded.schema[key].dataType), *out])

    def run(batches):
        bpe = load(path)
        for batch in batches:
            rows = [row(bpe, x or b"") for x in batch.column(1).to_pylist()]
            if rows:
                columns = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(zip(*rows, strict=True), out, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    found = encoded.select(F.col(key).alias("key"), F.col(ids)).mapInArrow(run, schema)
    return found.withColumnRenamed("key", key)
