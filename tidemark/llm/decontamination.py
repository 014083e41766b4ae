"""Benchmark decontamination with a positional inverted index.

The index is split by documents: a segment holds the posting lists of all words of some hundred documents and is
written as one row. A search ranks the words of each benchmark window by their frequency in the whole index, takes
the positions of the rarest one and intersects them, offset by offset, with the lists of the others. Searches
need no shuffle, since all positions of a document lie in one segment. A benchmark of any size is searched in
blocks of bounded size; the index is written once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import bound_batches, reference, thrifty, word_table, written

WINDOW = 10
# Words of an index segment, UTF-8 bytes of a block of the benchmark, candidate positions looked at together.
SEGMENT_WORDS, BLOCK_BYTES, CANDIDATES = 500_000, 8 << 20, 1_000_000
WORD_BYTES = word_table()
ARRAYS = "n_words array<int>, terms binary, counts binary, postings binary"


def words_of(data: bytes) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and digits and of all later characters."""
    return data.translate(WORD_BYTES).split()


def _planes(values: np.ndarray) -> bytes:
    """32-bit integers, byte plane by byte plane, which compresses well where most are small."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def _pack(words: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Terms, their numbers of postings, and the postings as gaps, term after term."""
    numbers = {word: i for i, word in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    order = np.sort((ids << 32) | np.arange(len(ids)))
    positions, counts = order & 0xFFFFFFFF, np.bincount(ids, minlength=len(numbers))
    gaps = np.diff(positions, prepend=0)
    first = np.cumsum(counts) - counts
    gaps[first] = positions[first]
    return b" ".join(numbers), _planes(counts), _planes(gaps)


def _unpack(counts: bytes, postings: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of postings, and all postings as sorted term << 32 | position."""
    sizes, gaps = _from_planes(counts), _from_planes(postings)
    if not len(gaps):
        return sizes, gaps
    running = np.cumsum(gaps)
    first = np.cumsum(sizes) - sizes
    base = running[first] - gaps[first]
    return sizes, (np.repeat(np.arange(len(sizes)), sizes) << 32) | (running - np.repeat(base, sizes))


def index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write and return the index of all texts: a row per segment.

    A null text has no words; every row of docs, also a repeated one or one with a null key, has its place.
    """
    bound_batches(docs.sparkSession)
    kind = docs.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField("segment", T.StringType()),
            T.StructField("keys", T.ArrayType(kind)),
            *T.StructType.fromDDL(ARRAYS).fields,
        ]
    )
    arrow = [to_arrow_type(f.dataType) for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        keys: list = []
        sizes: list[int] = []
        words: list[bytes] = []

        def segment() -> pa.RecordBatch:
            row = [f"{task}-{made}", list(keys), list(sizes), *_pack(words)]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, arrow, strict=True)], schema.names)

        for batch in batches:
            for one, data in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist(), strict=True):
                found = words_of(data or b"")
                keys.append(one)
                sizes.append(len(found))
                words += found
                if len(words) >= SEGMENT_WORDS or len(keys) >= SEGMENT_WORDS:
                    yield segment()
                    made += 1
                    keys.clear(), sizes.clear(), words.clear()
        if keys:
            yield segment()

    return written(docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(thrifty(run, 1), schema), "postings")


class Windows:
    """The distinct windows of some benchmark items, and the items that each belongs to."""

    def __init__(self, items: list[tuple[str | None, str | None]], length: int = WINDOW):
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for name, text in items:
            words = words_of((text or "").encode())
            for i in range(max(1, len(words) - length + 1) if words else 0):
                owned = owners.setdefault(tuple(words[i : i + length]), set())
                if name is not None:
                    owned.add(name)
        self.owners = [sorted(x) for x in owners.values()]
        self.terms = sorted({w for window in owners for w in window})
        number = {w: i for i, w in enumerate(self.terms)}
        self.sizes = np.array([len(w) for w in owners], np.int64)
        self.matrix = np.full((len(owners), length), -1, np.int64)
        for row, window in zip(self.matrix, owners, strict=True):
            row[: len(window)] = [number[w] for w in window]
        self.offsets = np.tile(np.arange(length), (len(owners), 1))

    def rank(self, frequency: dict[bytes, int]) -> Windows:
        """Order the words of each window from the rarest to the most frequent."""
        often = np.array([frequency.get(w, 0) for w in self.terms] + [np.iinfo(np.int64).max])
        order = np.argsort(often[self.matrix], axis=1, kind="stable")
        self.offsets = np.take_along_axis(self.offsets, order, 1)
        self.matrix = np.take_along_axis(self.matrix, order, 1)
        return self


def term_frequency(segments: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """Occurrences of each of the terms in the whole index; the posting lists aren't read."""
    wanted = segments.sparkSession.sparkContext.broadcast(frozenset(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                have = [(w, int(n)) for w, n in zip(names.split(b" "), _from_planes(counts), strict=False) if w in wanted.value]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in have], pa.binary()), pa.array([n for _, n in have], pa.int64())], ["term", "n"]
                )

    parts = segments.select("terms", "counts").mapInArrow(thrifty(run), "term binary, n long")
    return {bytes(r.term): r.n for r in parts.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator()}


def _phrases(windows: Windows, terms: bytes, counts: bytes, postings: bytes, slop: int | None) -> tuple[np.ndarray, ...]:
    """(window, first position, position behind the last) of each match in a segment."""
    local = {w: i for i, w in enumerate(terms.split(b" "))} if terms else {}
    own = np.array([local.get(w, -1) for w in windows.terms] + [-2], np.int64)[windows.matrix]
    alive = np.flatnonzero((own != -1).all(axis=1) & (windows.sizes > 0))
    none = np.zeros(0, np.int64)
    if not len(alive):
        return none, none, none
    sizes, keys = _unpack(counts, postings)
    first = np.cumsum(sizes) - sizes
    found = []
    load = np.cumsum(sizes[own[alive, 0]])
    for part in np.split(alive, np.flatnonzero(np.diff(load // CANDIDATES)) + 1):
        n = sizes[own[part, 0]]
        row = np.repeat(part, n)
        at = keys[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[own[part, 0]], n)] & 0xFFFFFFFF
        if slop is None:
            start = at - windows.offsets[row, 0]
            row, start = row[start >= 0], start[start >= 0]
            for k in range(1, own.shape[1]):
                term = own[row, k]
                want = (term << 32) | (start + windows.offsets[row, k])
                i = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                hit = (keys[i] == want) | (term < 0)
                row, start = row[hit], start[hit]
            found.append((row, start, start + windows.sizes[row]))
        else:
            found.append(_ordered(windows, own, keys, row, at, slop))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _ordered(windows: Windows, own: np.ndarray, keys: np.ndarray, row: np.ndarray, at: np.ndarray, slop: int):
    """Matches around positions of the rarest word with the words in order and at most slop others between them.

    Going left and right from the rarest word, the nearest posting of the next word is taken each time, which gives
    the shortest match around that position.
    """
    left, right, okay = at.copy(), at.copy(), np.ones(len(at), bool)
    by_offset = np.full(own.shape, -2, np.int64)
    np.put_along_axis(by_offset, windows.offsets, own, 1)
    for step in range(1, own.shape[1]):
        for side in (-1, 1):
            offset = windows.offsets[row, 0] + side * step
            inside = (offset >= 0) & (offset < windows.sizes[row])
            term = by_offset[row, np.clip(offset, 0, own.shape[1] - 1)]
            edge = left if side < 0 else right
            want = (term << 32) | edge
            i = np.searchsorted(keys, want, "left") - 1 if side < 0 else np.searchsorted(keys, want, "right")
            near = keys[np.clip(i, 0, len(keys) - 1)]
            okay &= ~inside | ((i >= 0) & (i < len(keys)) & (near >> 32 == term))
            np.copyto(edge, near & 0xFFFFFFFF, where=inside)
    okay &= right + 1 - left - windows.sizes[row] <= slop
    return row[okay], left[okay], right[okay] + 1


def _search_block(segments: DataFrame, windows: Windows, key: str, slop: int | None) -> DataFrame:
    shared = segments.sparkSession.sparkContext.broadcast(windows)
    kind = segments.schema["keys"].dataType.elementType
    outputs = T.StructType.fromDDL(
        "segment string, place int, n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>"
    )
    schema = T.StructType([T.StructField("key", kind), *outputs.fields])
    arrow = [to_arrow_type(f.dataType) for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["n_words"], np.int64)
                ends = np.cumsum(sizes)
                window, start, end = _phrases(shared.value, row["terms"], row["counts"], row["postings"], slop)
                doc = np.searchsorted(ends, start, "right")
                whole = end <= ends[np.minimum(doc, len(ends) - 1)]
                window, start, end, doc = window[whole], start[whole], end[whole], doc[whole]
                cover = np.zeros(int(ends[-1]) + 1, np.int64)
                np.add.at(cover, start, 1)
                np.add.at(cover, end, -1)
                covered = np.append(np.cumsum(cover[:-1]) > 0, False)
                running = np.append(0, np.cumsum(covered))
                n_hit = running[ends] - running[ends - sizes]
                items: list[list[str]] = [[] for _ in sizes]
                spans: list[list[dict]] = [[] for _ in sizes]
                for d in np.unique(doc):
                    owned = shared.value.owners
                    items[d] = sorted({x for w in np.unique(window[doc == d]) for x in owned[w]})
                    low = int(ends[d] - sizes[d])
                    flags = np.diff(np.concatenate([[0], covered[low : ends[d]].astype(np.int8), [0]]))
                    edges = zip(np.flatnonzero(flags == 1), np.flatnonzero(flags == -1), strict=True)
                    spans[d] = [{"start": int(a), "end": int(b)} for a, b in edges]
                n = len(sizes)
                columns = [row["keys"], [row["segment"]] * n, range(n), sizes, n_hit, items, spans]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, arrow, strict=True)], schema.names)

    return segments.mapInArrow(thrifty(run), schema)


def find(
    segments: DataFrame,
    items: DataFrame,
    length: int = WINDOW,
    slop: int | None = None,
    key: str = "doc_id",
    item: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """Search all items in an index.

    Per indexed row: key, n_words, n_hit (words inside a match), items (sorted ids of the items with a match) and
    spans (start and end word of each covered stretch). With ``slop`` None a match is the exact phrase; with a number
    it is a proximity match: the window's words in order with at most that many others between them.

    An item without words has no window, and one with a null id marks words but is not listed. Repeated items count
    once. An empty benchmark leaves all rows without a match.
    """
    narrow = items.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-total // BLOCK_BYTES) or 1
    parts = []
    for block in range(n_blocks):
        one = narrow if n_blocks == 1 else narrow.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == block)
        windows = Windows([(r.item, r.text) for r in one.collect()], length)
        parts.append(_search_block(segments, windows.rank(term_frequency(segments, windows.terms)), key, slop))
    if len(parts) == 1:
        return parts[0].drop("segment", "place").withColumnRenamed("key", key)
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    merged = every.groupBy("segment", "place").agg(
        F.first("key").alias(key),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
    )
    # stretches of several blocks can overlap: count each word once
    joined = F.aggregate(
        "spans",
        F.array().cast("array<struct<start: long, end: long>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    merged = merged.withColumn("spans", joined)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return merged.select(key, "n_words", n_hit.alias("n_hit"), "items", "spans")


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: key, n_words, n_hit, n_items, items_sha256, contaminated (n_hit > 0)."""
    found = find(index(docs, key, text), items, key=key)
    return found.select(
        key,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs without a match, with all their columns."""
    named = docs.select(reference(key, text).alias("reference"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    texts = named.select("reference", F.col(f"row.`{text}`").cast("string").alias("text"))
    hit = find(index(texts, "reference"), items, key="reference").where("n_hit > 0").select("reference")
    clean = named.join(written(hit.distinct(), "contaminated"), "reference", "left_anti")
    return clean.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
