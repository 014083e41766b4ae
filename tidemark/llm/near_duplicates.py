"""Join of documents whose word n-grams overlap: Jaccard similarity of 0.8 or more over five-word shingles.

Documents with the same shingles make a class at once; what follows works on one representative of each. Its MinHash
signature is cut into trees, and the sorted prefixes of a tree's part are the nodes of a trie: representatives that
share a prefix are candidates. Long prefixes come first. From the similarities found, the share of links that
prefixes of this length must have missed is estimated, and prefixes get shorter until the target recall is reached.

Every candidate pair is looked at once: in the first tree in which it shares a prefix. Nodes with many members are
split into blocks, each pair of blocks being a unit of work of its own. Signatures tell which members of a unit have
a candidate in it; only these get their shingles, on which similarities are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bound_batches, may_be_in, mix64, reference, thrifty, written

WORDS, SIMILARITY = 5, (4, 5)
TREES, LONGEST, SHORTEST = 16, 5, 3
TARGET_RECALL = 0.9995
# Signatures agree in a share of places near the similarity; five standard deviations below it a pair is left out.
AGREEMENT = 0.8 - 5 * math.sqrt(0.8 * 0.2 / (TREES * LONGEST))
# Members and shingles of a block.
BLOCK, BLOCK_SHINGLES = 1024, 500_000
# Shingles hashed together.
TOGETHER = 1 << 16

_RNG = np.random.default_rng(20240229)
_FACTORS = _RNG.integers(0, 1 << 63, TREES * LONGEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = _RNG.integers(0, 1 << 63, TREES * LONGEST, dtype=np.uint64)
_PLACES = _RNG.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct shingles.

    Words are runs of characters other than space and \\t to \\r, A-Z in lower case. A text of fewer words than a
    shingle has all of them as its only one; a text without words has none.
    """
    lists = [text.lower().split() for text in texts]
    flat = [w for words in lists for w in words]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    by_word = np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))
    hashes = by_word[np.fromiter(map(numbers.__getitem__, flat), np.int64, len(flat))]
    n = len(flat) - WORDS + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(WORDS if n > 0 else 0):
        rolled += hashes[k : k + n] * _PLACES[k]
    rolled = mix64(rolled)
    found, at = [], 0
    for words in lists:
        if len(words) >= WORDS:
            found.append(np.unique(rolled[at : at + len(words) - WORDS + 1]))
        elif words:
            short = (hashes[at : at + len(words)] * _PLACES[: len(words)]).sum(dtype=np.uint64)
            found.append(mix64(np.array([short + np.uint64(len(words))], np.uint64)))
        else:
            found.append(np.zeros(0, np.uint64))
        at += len(words)
    return found


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash signatures, a row of 32-bit integers for each set that isn't empty."""
    out = np.empty((len(sets), TREES * LONGEST), np.uint32)
    sizes = np.array([len(s) for s in sets], np.int64)
    for part in np.split(np.arange(len(sets)), np.flatnonzero(np.diff(np.cumsum(sizes) // TOGETHER)) + 1):
        if len(part):
            values = np.concatenate([sets[i] for i in part])
            starts = np.cumsum(sizes[part]) - sizes[part]
            for k in range(out.shape[1]):
                out[part, k] = np.minimum.reduceat((values ^ _MASKS[k]) * _FACTORS[k], starts) >> np.uint64(32)
    return out


def features(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, reference, shingle set (16-byte digest, null without words), its size n, signature: written."""
    bound_batches(docs.sparkSession)
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField("key", kind), *T.StructType.fromDDL("reference string, set binary, n int, signature binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sets = shingle_hashes([x or b"" for x in batch.column(2).cast(pa.large_binary()).to_pylist()])
            full = [s for s in sets if len(s)]
            signed = iter(signatures(full)) if full else iter(())
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            signed = [next(signed).tobytes() if len(s) else None for s in sets]
            columns = [pa.array(digests, pa.binary()), pa.array([len(s) for s in sets], pa.int32()), pa.array(signed, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], schema.names)

    source = docs.select(F.col(key).alias("key"), reference(key, text).alias("reference"), F.col(text).cast("string"))
    return written(source.mapInArrow(thrifty(run, 2), schema), "features")


def _units(reps: DataFrame, depth: int) -> DataFrame:
    """Members of the trie nodes at a depth: unit of work, tree, side (of a pair of different blocks, else null), set.

    A node's blocks are paired with each other, so a member is in as many units as its node has blocks.
    """
    nodes = reps.select("set", "n", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "signature").select(
        "set", "n", "tree", F.xxhash64("tree", F.expr(f"substring(signature, tree * {LONGEST * 4} + 1, {depth * 4})")).alias("node")
    )
    sizes = nodes.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles")).where(F.col("members") > 1)
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    many = nodes.drop("n").join(sizes.select("tree", "node", blocks.alias("blocks")), ["tree", "node"])
    own = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    paired = many.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(low != high, (F.col("own") == high).cast("int"))
    return paired.select(F.xxhash64("tree", "node", low, high).alias("unit"), "tree", side.alias("side"), "set")


def _by_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by their first column, in tables that end where a unit ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = batch.column(0).to_numpy()
        changes = np.flatnonzero(np.diff(unit)) + 1
        if held and held[-1].column(0)[-1].as_py() != unit[0]:
            yield pa.Table.from_batches(held)
            held = []
        if len(changes):
            yield pa.Table.from_batches([*held, batch.slice(0, changes[-1])])
            held = []
            batch = batch.slice(changes[-1])
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _fixed_width(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    data = column.combine_chunks().to_pylist()
    return np.frombuffer(b"".join(data), kind).reshape(len(data), -1)


def _candidates(rows: pa.Table, depth: int, before: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows to verify: in one unit, of different blocks where the unit is a pair of blocks, of similar size
    and signature, sharing a prefix first in this tree and not at the depth before."""
    unit, tree, size = (rows[c].to_numpy() for c in ("unit", "tree", "n"))
    side = rows["side"].fill_null(-1).to_numpy()
    signed = _fixed_width(rows["signature"], np.uint32).reshape(len(unit), TREES, LONGEST)
    here = np.arange(len(unit))
    for step in range(1, len(unit)):
        here = here[here + step < len(unit)]
        here = here[unit[here] == unit[here + step]]
        if not len(here):
            return
        a, b = here, here + step
        fits = (tree[a] == tree[b]) & ((side[a] < 0) | (side[a] != side[b]))
        low, high = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
        fits &= low.astype(np.int64) * SIMILARITY[1] >= high.astype(np.int64) * SIMILARITY[0]
        a, b = a[fits], b[fits]
        if not len(a):
            continue
        same = signed[a] == signed[b]
        shared = same[:, :, :depth].all(axis=2)
        first = shared.argmax(axis=1)
        new = (first == tree[a]) & shared[np.arange(len(a)), first] & (same.mean(axis=(1, 2)) >= AGREEMENT)
        if before is not None:
            new &= ~same[:, :, :before].all(axis=2).any(axis=1)
        if new.any():
            yield a[new], b[new]


def _with_candidates(members: DataFrame, depth: int, before: int | None) -> DataFrame:
    """The members that have a candidate in their unit."""
    schema = members.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_unit(batches):
            use = np.zeros(len(rows), bool)
            for a, b in _candidates(rows, depth, before):
                use[a] = use[b] = True
            yield from rows.filter(pa.array(use)).to_batches()

    return members.repartition("unit").sortWithinPartitions("unit").mapInArrow(thrifty(run), schema)


def _overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of shared shingles of each pair of sets."""
    used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    sizes = np.array([len(sets[i]) for i in used])
    if len(a) * 8 < len(used) * 32 or len(a) < 64:
        return np.array([_shared(sets[i], sets[j]) for i, j in zip(a, b, strict=True)], np.int64)
    values, inverse, counts = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)
    column = np.cumsum(counts > 1) - 1
    owner = np.repeat(np.arange(len(used)), sizes)
    often = counts[inverse] > 1
    owner, column = owner[often], column[inverse[often]]
    n_columns = int((counts > 1).sum())
    if len(used) ** 2 * n_columns / 5e9 > len(a) * 3e-5:
        return np.array([_shared(sets[i], sets[j]) for i, j in zip(a, b, strict=True)], np.int64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(used), len(used)), np.float32)
    for at in range(0, n_columns, 1024):
        low, high = np.searchsorted(column, [at, at + 1024])
        block = np.zeros((len(used), 1024), np.float32)
        block[owner[low:high], column[low:high] - at] = 1
        total += block @ block.T
    return total[place[: len(a)], place[len(a) :]].round().astype(np.int64)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


FOUND = "what string, a binary, b binary, n long"
BINS = 40


def _verify(members: DataFrame, depth: int, before: int | None) -> DataFrame:
    """Rows of FOUND: ``links`` of a set in a unit (documents linked to it), ``edge`` between linked sets, enough to
    connect all linked sets of a unit, and ``bin``, the number of links of a range of similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_unit(batches):
            names = rows["set"].to_pylist()
            copies = rows["copies"].to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"].to_pylist()]
            size = np.array([len(s) for s in sets], np.int64)
            unit = rows["unit"].to_numpy()
            pairs = list(_candidates(rows, depth, before))
            if not pairs:
                continue
            a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
            order = np.argsort(unit[a], kind="stable")
            a, b = a[order], b[order]
            overlap = np.concatenate([_overlaps(sets, a[x], b[x]) for x in np.split(np.arange(len(a)), np.flatnonzero(np.diff(unit[a])) + 1)])
            union = size[a] + size[b] - overlap
            linked = overlap * SIMILARITY[1] >= union * SIMILARITY[0]
            a, b, similarity = a[linked], b[linked], (overlap / union)[linked]
            links = np.zeros(len(names), np.int64)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            root = _roots(len(names), a, b)
            out: list[tuple] = [("links", names[i], None, int(links[i])) for i in np.flatnonzero(links)]
            out += [("edge", names[i], names[root[i]], 0) for i in np.flatnonzero(root != np.arange(len(names)))]
            low = SIMILARITY[0] / SIMILARITY[1]
            bins = np.bincount(np.minimum((similarity - low) / (1 - low) * BINS, BINS - 1).astype(int), minlength=BINS)
            out += [("bin", bytes([k]), None, int(n)) for k, n in enumerate(bins) if n]
            what, first, second, n = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(what, pa.string()), pa.array(first, pa.binary()), pa.array(second, pa.binary()), pa.array(n, pa.int64())],
                ["what", "a", "b", "n"],
            )

    return members.repartition("unit").sortWithinPartitions("unit").mapInArrow(thrifty(run), FOUND)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lowest row that each row is connected to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def _shingles(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """set, shingles of the wanted sets, from the texts of their references."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_hashes([x or b"" for x in batch.column(0).cast(pa.large_binary()).to_pylist()])
            names = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["set", "shingles"]
            )

    texts = docs.select(reference(key, text).alias("reference"), F.col(text).cast("string").alias("text"))
    # an inner join: a semi-join would be pushed below the filter; a set has one reference, and a reference one set
    few = may_be_in(texts, "reference", wanted).join(wanted.select("reference"), "reference")
    made = few.select("text").mapInArrow(thrifty(run, 0), "set binary, shingles binary")
    # repeated rows have the same reference
    return written(made.groupBy("set").agg(F.first("shingles").alias("shingles")), "shingles")


def _recall(bins: dict[int, int], depth: int) -> float:
    """Share of all links that prefixes of this length find, from the similarities of those found."""
    low = SIMILARITY[0] / SIMILARITY[1]
    found = sum(bins.values())
    expected = sum(n / (1 - (1 - (low + (1 - low) * k / BINS) ** depth) ** TREES) for k, n in bins.items())
    return found / expected if expected else 1 - (1 - (1 - low**depth)) ** TREES


def components(edges: DataFrame) -> DataFrame:
    """node, root: the lowest node that each node of the edges (a, b) is connected to.

    Alternates hooking neighbours to the lowest one around (large star, small star) until nothing changes. Every
    round is written; neighbourhoods are reduced before they are joined, so no node's edges meet in one task.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(lowest, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = written(large.where("a != b").distinct(), "large-star")
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        edges = written(small.where("a != b").distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def classes(docs: DataFrame, key: str, text: str, target_recall: float) -> tuple[DataFrame, DataFrame]:
    """The features of all rows; and of each shingle set: class_id, copy_id, n_links, and the reference that stays."""
    rows = features(docs, key, text)
    sets = rows.where(F.col("set").isNotNull()).groupBy("set").agg(
        F.min("key").alias("copy_id"),
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct(F.col("key").isNull(), "key", "reference")).alias("stays"),
        F.first("n").alias("n"),
        F.first("signature").alias("signature"),
    )
    sets = written(sets.withColumn("reference", F.col("stays.reference")), "sets")
    found, bins, before = None, {}, None
    for depth in range(LONGEST, SHORTEST - 1, -1):
        members = _units(sets, depth).join(sets.select("set", "n", "signature"), "set").select("unit", "tree", "side", "set", "n", "signature")
        use = written(_with_candidates(members, depth, before), "candidates")
        wanted = written(use.select("set").distinct().join(sets.select("set", "reference", "copies"), "set"), "wanted")
        full = use.join(_shingles(docs, wanted, key, text), "set").join(wanted.select("set", "copies"), "set")
        level = written(_verify(full.select("unit", "tree", "side", "set", "n", "signature", "copies", "shingles"), depth, before), "found")
        found = level if found is None else found.unionByName(level)
        for r in level.where("what = 'bin'").groupBy("a").agg(F.sum("n").alias("n")).collect():
            bins[r.a[0]] = bins.get(r.a[0], 0) + r.n
        before = depth
        if _recall(bins, depth) >= target_recall:
            break
    links = found.where("what = 'links'").groupBy("a").agg(F.sum("n").alias("linked"))
    roots = components(found.where("what = 'edge'").select("a", "b"))
    named = sets.select("set", "copy_id", "copies", "stays").join(links, sets["set"] == links["a"], "left").drop("a")
    named = named.join(roots, named["set"] == roots["node"], "left").withColumn("root", F.coalesce("root", "set")).drop("node")
    named = written(named, "named")
    lowest = named.groupBy("root").agg(F.min("copy_id").alias("class_id"), F.min("stays").alias("first"))
    total = F.coalesce("linked", F.lit(0)) + F.col("copies") - 1
    stays = F.col("first.reference").alias("stays")
    return rows, written(named.join(lowest, "root").select("set", "class_id", "copy_id", total.alias("n_links"), stays), "classes")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", target_recall: float = TARGET_RECALL) -> DataFrame:
    """Per row of docs: key, class_id, copy_id, n_links.

    copy_id is the lowest key among rows with the same shingles, class_id that among all rows connected by links,
    n_links the number of other rows with a similarity of 0.8 or more. Rows without any word are linked to none and
    have their own key for both. Null keys are taken part in and are the lowest key only of classes that have no
    other. Repeated rows are copies of each other. An empty table gives no row; other columns of docs aren't read.
    """
    rows, answer = classes(docs, key, text, target_recall)
    # a set may have much of the rows: its side is split by adaptive execution
    joined = rows.select("key", "set").join(answer, "set", "left")
    alone = F.col("set").isNull()
    return joined.select(
        F.col("key").alias(key),
        F.when(alone, F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("key")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", target_recall: float = TARGET_RECALL) -> DataFrame:
    """The row of the lowest key of each class, with all its columns; rows without any word all stay.

    Rows that repeat a key and text count as one row.
    """
    rows, answer = classes(docs, key, text, target_recall)
    stay = rows.where(F.col("set").isNull()).select("reference").unionByName(answer.select(F.col("stays").alias("reference")))
    stay = written(stay.distinct(), "staying")
    named = docs.select(reference(key, text).alias("reference"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    one = named.join(stay, "reference", "left_semi").dropDuplicates(["reference"])
    return one.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
