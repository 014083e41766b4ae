"""Document fingerprints: a sketch that keeps every shingle hash below a fixed fraction of the hash range.

Whether a hash is kept depends on the hash alone. Sketches of texts of very different length can therefore be compared
with each other: the share of a small text's kept hashes that a large one holds estimates how much of it the large
one contains. The sketch of several texts together is the union of their sketches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import as_texts, bound_batches, mix64, per_text, written

WORDS = 5
# One shingle in so many is kept.
SCALE = 16

_PLACES = np.random.default_rng(20241103).integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketches(texts: list[str], scale: int = SCALE) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text: all of its shingle hashes below 2**64 / scale.

    Words are runs of characters other than space and \\t to \\r. A shingle is a word with the four before it; the
    first words of a text have fewer before them, so a text has as many shingles as words. Of a text none of whose
    hashes is low enough the lowest one is kept; a text without words has none.
    """
    lists = [text.encode().split() for text in texts]
    flat = [w for words in lists for w in words]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    by_word = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    # four empty places before each text
    at = np.arange(len(flat)) + np.repeat((np.arange(len(lists)) + 1) * (WORDS - 1), sizes)
    hashes = np.zeros(len(flat) + len(lists) * (WORDS - 1) + 1, np.uint64)
    hashes[at] = by_word[np.fromiter(map(numbers.__getitem__, flat), np.int64, len(flat))]
    rolled = np.zeros(len(flat), np.uint64)
    for k in range(WORDS):
        rolled += hashes[at - k] * _PLACES[k]
    rolled = mix64(rolled)
    low = rolled < np.uint64((1 << 64) // scale) if scale > 1 else np.ones(len(rolled), bool)
    found, start = [], 0
    for size in sizes:
        own = rolled[start : start + size]
        kept = own[low[start : start + size]]
        found.append(np.unique(kept if len(kept) else own.min(keepdims=True)) if size else own)
        start += size
    return found


def likeness_of(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the hashes of either sketch that both hold; 1 for two empty ones."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def sketch(docs: DataFrame, key: str = "doc_id", text: str = "text", scale: int = SCALE) -> DataFrame:
    """key and ``hashes``, the sorted sketch of the text as an array of longs (unsigned 64-bit integers).

    Null and empty texts have an empty sketch; repeated rows and null keys give a row each; an empty table gives
    none; other columns of docs, whatever their names, are not read.
    """

    def make():
        def work(column: pa.Array) -> list:
            found = sketches(as_texts(column), scale)
            return [pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64()))]

        return work

    return per_text(docs, make, "hashes array<bigint>", key, text)


def merge(sketched: DataFrame, by: str) -> DataFrame:
    """The sketches of each value of ``by`` together: a row for each (by, hash), so that no group need fit in a task."""
    return sketched.select(F.col(by), F.explode("hashes").alias("hash")).distinct()


def containment(part: Column, whole: Column) -> Column:
    """Estimated share of a text's shingles that another holds, from their sketches; null for a text without words."""
    return F.when(F.size(part) > 0, F.size(F.array_intersect(part, whole)) / F.size(part))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts from their sketches; 1 for two texts without words."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(1.0)


def containment_in(sketched: DataFrame, merged: DataFrame, key: str, by: str) -> DataFrame:
    """key, by, ``share``: how much of each text each merged sketch holds, for those that hold some of it.

    The merged sketches may be of any size: they are joined hash by hash. Rows of a repeated key count as one text.
    """
    own = sketched.select(F.col(key).alias("_key"), F.explode("hashes").alias("hash")).distinct()
    held = own.join(merged.select(F.col(by).alias("_by"), "hash"), "hash").groupBy("_key", "_by").agg(F.count("*").alias("_both"))
    size = own.groupBy("_key").agg(F.count("*").alias("_size"))
    joined = held.join(size, held["_key"].eqNullSafe(size["_key"]))
    return joined.select(held["_key"].alias(key), F.col("_by").alias(by), (F.col("_both") / F.col("_size")).alias("share"))


def edit(text: str, following: str) -> str:
    """The text with its last half, rounded down, replaced by as many first characters of another, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_base64(column: str) -> Column:
    """Bytes in base64, on one line whatever the session's setting."""
    return F.translate(F.base64(column), "\r\n", "")


_MEASURED = "n_chars bigint, edited_sha256 string, sketch binary, edited binary, near_edited double, near_next double"


def _measure(texts: list[str], following: list[str], own: list[np.ndarray], after: list[np.ndarray], scale: int) -> list[tuple]:
    """What is measured of each text and the one that follows it; own, after: their sketches."""
    changed = [edit(t, f) for t, f in zip(texts, following, strict=True)]
    return [
        (len(t), hashlib.sha256(e.encode()).hexdigest(), a.tobytes(), s.tobytes(), likeness_of(a, s), likeness_of(a, b))
        for t, e, a, b, s in zip(texts, changed, own, after, sketches(changed, scale), strict=True)
    ]


def _fields(kind: T.DataType, ddl: str) -> T.StructType:
    return T.StructType([T.StructField("key", kind), *T.StructType.fromDDL(ddl).fields])


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema, strict=True)], schema.names)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", scale: int = SCALE) -> DataFrame:
    """Each text against its edited version and against the next one in the order of the keys.

    Returns key, n_chars, edited_sha256, fingerprint, edited_fingerprint (base64 of the sketches, 8 little-endian bytes
    a hash), near_edited, near_next (Jaccard similarity of the sketches). A null text is empty. Null keys come first, rows of equal
    keys in the order of docs; the first row follows the last; a single row follows itself. An empty table gives no row.

    Texts are moved once, by ranges of the key. A task knows the next text of all its rows but the last; those are
    joined with the first row of the next range, a text for each range on either side.
    """
    bound_batches(docs.sparkSession)
    kind = docs.schema[key].dataType
    found = _fields(kind, f"part int, place string, text string, {_MEASURED}")
    nothing = (None,) * 6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, texts = batch.column(0).to_pylist(), as_texts(batch.column(1))
            own = sketches(texts, scale)
            rows = []
            if held is None:
                rows.append((keys[0], part, "first", texts[0], *nothing))
            else:
                keys, texts, own = [held[0], *keys], [held[1], *texts], [held[2], *own]
            measured = _measure(texts[:-1], texts[1:], own[:-1], own[1:], scale)
            rows += [(k, part, "done", None, *m) for k, m in zip(keys, measured, strict=False)]
            held = keys[-1], texts[-1], own[-1]
            if rows:
                yield _batch(rows, found)
        if held is not None:
            yield _batch([(held[0], part, "last", held[1], *nothing)], found)

    order = [F.col("key").asc_nulls_first(), F.col("place").asc()]
    placed = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.monotonically_increasing_id().alias("place"))
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = written(ranged.select("key", "text").mapInArrow(run, found), "fingerprints")

    # a row for each range
    firsts = parts.where("place = 'first'").select(F.col("part").alias("next"), F.col("text").alias("following"))
    every = Window.orderBy("next").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select(
        F.col("next").alias("part"), F.coalesce(F.lead("next").over(Window.orderBy("next")), F.min("next").over(every)).alias("next")
    )
    lasts = parts.where("place = 'last'").select("part", "key", "text").join(after, "part").join(firsts, "next")
    measured = _fields(kind, _MEASURED)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                texts, following = as_texts(batch.column(1)), as_texts(batch.column(2))
                both = sketches(texts + following, scale)
                rows = _measure(texts, following, both[: len(texts)], both[len(texts) :], scale)
                yield _batch([(k, *m) for k, m in zip(batch.column(0).to_pylist(), rows, strict=True)], measured)

    borders = lasts.select("key", "text", "following").mapInArrow(finish, measured)
    whole = parts.where("place = 'done'").select(*measured.names).unionByName(borders)
    return whole.select(
        F.col("key").alias(key), "n_chars", "edited_sha256", in_base64("sketch").alias("fingerprint"),
        in_base64("edited").alias("edited_fingerprint"), "near_edited", "near_next",
    )
