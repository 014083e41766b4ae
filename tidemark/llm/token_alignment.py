"""Alignment of two tokenizers over the same bytes.

Each token start of one side is matched with the token of the other side that covers it, by an as-of merge keyed by
document. Both directions together give every pair of overlapping tokens; byte offsets where tokens of both
sides end cut them into groups. How often two ids overlap in the whole corpus then tells the usual partner of an id.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import as_texts, bound_batches, let_go, written
from tidemark.llm.pieces import byte_of, is_early, rank_encoder

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
# UTF-8 bytes of the texts aligned together, as far as a single text isn't longer.
TOGETHER = 1 << 20
# Id pairs whose counts are sent to all executors, the most frequent ones: 16 bytes each. Rarer ones are joined.
TOP_PAIRS = 1 << 20


class Tokenizers:
    """The two tokenizers and the bytes of their entries."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(a_path)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        known, vocabulary = byte_of(), self._a.get_vocab()
        self._early = rank_encoder(a_path, public_tokenizers.PATTERN)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = bytes(map(known.__getitem__, entry)) if all(c in known for c in entry) else entry.encode()
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        # how an id is spelled before the next id of its side, before the other side, before the next group
        self._spelled = [f"{i}{end}" for end in (",", "|") for i in range(len(self.a_bytes))]
        self._spelled += [f"{i}{end}" for end in (",", ";", "") for i in range(len(self.b_bytes))]

    def _encode_a(self, whole: str, data: bytes) -> list[int]:
        if self._early is not None and is_early(data):
            return self._early(whole)
        return self._a.encode_batch_fast([whole], add_special_tokens=False)[0].ids

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of space + text by each side; none where the two sides don't spell these bytes."""
        a, b = [], self._b.encode(texts, num_threads=1)
        for i, text in enumerate(texts):
            data = b" " + text.encode()
            a.append(self._encode_a(" " + text, data))
            if not text or b"".join(map(self.a_bytes.__getitem__, a[i])) != data or b"".join(map(self.b_bytes.__getitem__, b[i])) != data:
                a[i], b[i] = [], []
        return a, b

    def spell(self, codes: np.ndarray) -> list[str]:
        return list(map(self._spelled.__getitem__, codes.tolist()))


@functools.lru_cache(maxsize=1)
def load(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


@dataclass
class Side:
    """Tokens of one tokenizer over several texts, one after another."""

    ids: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(lists: list[list[int]], sizes: np.ndarray) -> Side:
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum()))
        end = np.cumsum(sizes[ids])
        return Side(ids, np.repeat(np.arange(len(lists)), counts), end - sizes[ids], end, counts)

    def covering(self, other: Side) -> np.ndarray:
        """For each token of ``other``, the token of this side of the same document that covers its start."""
        left = pd.DataFrame({"start": other.start, "doc": other.doc})
        right = pd.DataFrame({"start": self.start, "doc": self.doc, "token": np.arange(len(self.ids))})
        return pd.merge_asof(left, right, on="start", by="doc")["token"].to_numpy(np.int64)


class Alignment:
    """Links and groups of the tokens of some texts."""

    def __init__(self, tokenizers: Tokenizers, texts: list[str]) -> None:
        self._tokenizers = tokenizers
        a, b = tokenizers.encode(texts)
        self.a, self.b = Side.of(a, tokenizers.a_sizes), Side.of(b, tokenizers.b_sizes)
        by_a, by_b = self.b.covering(self.a), self.a.covering(self.b)
        # tokens that start together were found by the first direction already
        more = self.b.start != self.a.start[by_b]
        self.link_a = np.concatenate([np.arange(len(by_a)), by_b[more]])
        self.link_b = np.concatenate([by_a, np.flatnonzero(more)])
        self.link_doc = self.a.doc[self.link_a]
        common = np.intersect1d(self.a.end, self.b.end, assume_unique=True)
        self.group_a, self.group_b = np.searchsorted(common, self.a.end), np.searchsorted(common, self.b.end)
        self._doc_of_group = np.empty(len(common), np.int64)
        self._doc_of_group[self.group_a] = self.a.doc

    def per_doc(self, docs: np.ndarray) -> np.ndarray:
        return np.bincount(docs, minlength=len(self.a.counts))

    @property
    def n_groups(self) -> np.ndarray:
        return self.per_doc(self._doc_of_group)

    @property
    def n_links(self) -> np.ndarray:
        return self.per_doc(self.link_doc)

    def groups(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each text: the ids of its groups in their order."""
        n_a, n_b, groups = len(self.a.ids), len(self.b.ids), len(self._doc_of_group)
        if not groups:
            return [""] * len(self.a.counts)
        of_a, of_b = (np.bincount(g, minlength=groups) for g in (self.group_a, self.group_b))
        codes = np.empty(n_a + n_b, np.int64)
        last_a = np.append(np.diff(self.group_a) > 0, True)
        last_b = np.append(np.diff(self.group_b) > 0, True).astype(np.int64)
        last_b[np.cumsum(self.b.counts)[self.b.counts > 0] - 1] = 2
        sizes = len(self._tokenizers.a_bytes), len(self._tokenizers.b_bytes)
        codes[np.arange(n_a) + (np.cumsum(of_b) - of_b)[self.group_a]] = self.a.ids + last_a * sizes[0]
        codes[np.arange(n_b) + np.cumsum(of_a)[self.group_b]] = self.b.ids + last_b * sizes[1] + 2 * sizes[0]
        spelled = self._tokenizers.spell(codes)
        ends = np.cumsum(self.a.counts + self.b.counts).tolist()
        return ["".join(spelled[s:e]) for s, e in zip([0, *ends], ends, strict=False)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct linked id pairs (a * size of B's vocabulary + b) of each text, one text after another, how many
        links hold each, and the number of pairs of each text."""
        size = len(self._tokenizers.b_bytes)
        pair = self.a.ids[self.link_a] * size + self.b.ids[self.link_b]
        whole = size * len(self._tokenizers.a_bytes)
        keys, times = np.unique(self.link_doc * whole + pair, return_counts=True)
        return keys % whole, times, self.per_doc(keys // whole)


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    """Texts in order, some at a time."""
    sizes = np.cumsum([len(t) for t in texts])
    for part in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(sizes // TOGETHER)) + 1):
        yield [texts[i] for i in part]


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(values, kind.value_type))


def _over(docs: DataFrame, key: str, text: str, ddl: str, paths: tuple[str, str], columns) -> DataFrame:
    """Map texts to columns by ``columns``, a function from an alignment to one array or list per column."""
    bound_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *T.StructType.fromDDL(ddl).fields])
    kinds = [to_arrow_type(f.dataType) for f in schema.fields[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = load(*paths)
        for batch in batches:
            done = 0
            for some in _chunks(as_texts(batch.column(1))) if batch.num_rows else ():
                found = columns(Alignment(tokenizers, some), kinds)
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(found, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(some)), *arrays], schema.names)
                done += len(some)
        let_go()

    return docs.select(F.col(key).alias("key"), F.col(text).cast("string")).mapInArrow(run, schema)


def _paths(a_path: str | None, b_path: str | None) -> tuple[str, str]:
    return a_path or public_tokenizers.path(BYTE_LEVEL), b_path or public_tokenizers.path(PIECES)


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """key, a_ids, b_ids, groups (``a1,a2|b1;a3|b2,b3``), links (an array of overlapping tokens by their places in a_ids and b_ids).

    Null and empty texts, and those that one side does not spell byte by byte, have no tokens. Repeated rows and null
    keys give a row each, an empty table none; other columns of docs, whatever their names, are not read.
    """

    def columns(found: Alignment, kinds: list[pa.DataType]) -> list:
        first_a, first_b = (np.cumsum(s.counts) - s.counts for s in (found.a, found.b))
        order = np.lexsort((found.link_b, found.link_a))
        link_a, link_b, doc = found.link_a[order], found.link_b[order], found.link_doc[order]
        linked = pa.StructArray.from_arrays(
            [pa.array(link_a - first_a[doc], pa.int32()), pa.array(link_b - first_b[doc], pa.int32())], ["a", "b"]
        )
        offsets = np.concatenate([[0], np.cumsum(found.n_links)]).astype(np.int32)
        return [
            _lists(found.a.ids, found.a.counts, kinds[0]),
            _lists(found.b.ids, found.b.counts, kinds[1]),
            found.groups(),
            pa.ListArray.from_arrays(offsets, linked),
        ]

    ddl = "a_ids array<int>, b_ids array<int>, groups string, links array<struct<a int, b int>>"
    return _over(docs, key, text, ddl, _paths(a_path, b_path), columns).withColumnRenamed("key", key)


def pair_counts(linked: DataFrame) -> DataFrame:
    """(pair, n): how many links of the whole corpus hold a pair."""
    return linked.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n"))


def report(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    a_path: str | None = None,
    b_path: str | None = None,
    top_pairs: int = TOP_PAIRS,
) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row of docs.

    n_best: links whose id pair is the most frequent one of its B id in the corpus (or as frequent); count_sum: the
    counts of all links' pairs. Rows without tokens have zeros and an empty digest. Null keys and repeated rows give a row each.

    Texts are tokenized once; what is written of a text are its distinct pairs and their times. The counts of
    the ``top_pairs`` most frequent pairs and each B id's highest count, whose sizes are bounded, go to all executors; rarer
    pairs are joined with their counts.
    """
    spark, paths = docs.sparkSession, _paths(a_path, b_path)

    def columns(found: Alignment, kinds: list[pa.DataType]) -> list:
        pairs, times, n = found.pairs()
        digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.groups()]
        sides = [found.a.counts, found.b.counts, found.n_groups, found.n_links]
        return [*sides, digests, _lists(pairs, n, kinds[5]), _lists(times, n, kinds[6])]

    ddl = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"
    numbered = _over(docs, key, text, ddl, paths, columns).withColumn("row", F.monotonically_increasing_id())
    linked = written(numbered, "links")
    counts = written(pair_counts(linked), "pairs")

    size = len(load(*paths).b_bytes)
    b_id = F.pmod("pair", F.lit(size))
    # a row for each entry of B's vocabulary
    best = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("best"))
    highest = np.zeros(size, np.int64)
    for r in best.collect():
        highest[r["b"]] = r["best"]
    top = counts.orderBy(F.desc("n"), "pair").limit(top_pairs).toArrow()
    order = np.argsort(top["pair"].to_numpy())
    shared = spark.sparkContext.broadcast((top["pair"].to_numpy()[order], top["n"].to_numpy()[order], highest))

    kept = ["row", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    outputs = T.StructType([*[linked.schema[c] for c in kept], *T.StructType.fromDDL("n_best bigint, count_sum bigint").fields])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers, highest = shared.value
        for batch in batches:
            pairs, times = (batch.column(len(kept) + i).flatten().to_numpy() for i in (0, 1))
            ends = np.cumsum(batch.column(len(kept)).value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            n = np.where(known[at] == pairs, numbers[at], 0) if len(known) else np.zeros(len(pairs), np.int64)
            is_best = (n > 0) & (n == highest[pairs % size])
            sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], ends])]) for x in (times * is_best, times * n)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *map(pa.array, sums)], outputs.names)

    found = linked.select(*kept, "pairs", "times").mapInArrow(look_up, outputs)
    if top.num_rows == top_pairs:
        # there may be pairs that the top lacks
        frequent = F.broadcast(spark.createDataFrame(top.select(["pair"])))
        single = linked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
        single = single.select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
        rare = single.join(frequent, "pair", "left_anti").join(counts, "pair").join(F.broadcast(best), b_id == F.col("b"))
        more = rare.groupBy("row").agg(
            F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("n") * F.col("times")).alias("more_sum"),
        )
        found = found.join(more, "row", "left").withColumns(
            {c: F.col(c) + F.coalesce(m, F.lit(0)) for c, m in (("n_best", F.col("more_best")), ("count_sum", F.col("more_sum")))}
        )
    return found.select(F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
