"""Language-model scores by logistic context mixing.

A text is a series of bits: the Huffman code of each word among the corpus's frequent ones, for any other word an
escape and the codes of its bytes, and an end. Words that occur once in the training documents have no code, so escapes
are learned as often as such words turn up. Predictors look up how often a bit fell either way after the same
context, in tables counted over the training documents: no context, the last word and the last two words; within a
spelled word the last byte, two and three bytes. Longer contexts are hashed. The predictors' log-odds are added with
weights chosen by a gate, that is by the kind of bit and how often its contexts were seen, and squashed to the
probability of the bit. Weights are learned on a part of the training documents before it is counted too, in groups and an
order that depend on the texts alone, and each document refines them as it is read. The sum of the logarithms is the
score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import as_bytes, bound_batches, mix64, thrifty, written

HELD_OUT, WEIGHING = 0, 1
# Words that have a rank, and the most bytes of such a word: bounds of what is broadcast. A word needs to occur so often.
RANKS, RANK_BYTES, RANK_LEAST = 1 << 18, 128, 2
# Groups of documents that learn weights of their own.
GROUPS = 64
# Predictors of each bit, and their regions of the table as (first slot, bits of the slot within): of words without
# context, after one and after two words, of bytes after one, two and three bytes.
CONTEXTS = 3
WORD_SLOTS = ((0, 19), (1 << 19, 21), ((1 << 19) + (1 << 21), 21))
BYTE_SLOTS = (((1 << 19) + (2 << 21), 17), ((1 << 19) + (2 << 21) + (1 << 17), 20), ((1 << 19) + (2 << 21) + (1 << 17) + (1 << 20), 20))
SLOTS = BYTE_SLOTS[2][0] + (1 << 20)
# Slots handed on together.
SLOT_BLOCK = 1 << 14
# Symbols that are held until contexts that are alike are counted together, and how many are spelled out in bits at a time.
SYMBOLS_HELD, SYMBOLS_TOGETHER = 1 << 20, 1 << 12
# Bytes of texts whose words are counted together, and different words that a task holds before it hands them on.
WORD_BYTES, WORDS_HELD = 16 << 20, 800_000
# Tokens read together; symbols of a document between two refinements of its weights; sizes of a step, while
# learning and while refining.
TOGETHER, STEP, LEARN_RATE, RATE = 40_000, 40, 0.03, 0.003
# Texts of like length that are scored together.
READ_TOGETHER = 256
# Times seen: 0, 1, 2 to 3, 4 to 7, 8 to 31, 32 or more.
SEEN = 6
# Gates of words or of bytes, and of both.
KIND_GATES = SEEN * SEEN
GATES = 2 * KIND_GATES
# Weights before learning, of words and of bytes.
FIRST = np.repeat(np.array([[1.0, 0.2, 0.2], [0.3, 0.4, 0.4]]), KIND_GATES, axis=0)
# Smoothing of the base score and of a slot's odds.
BASE, ODDS = 0.1, 0.4
# Unit of the log-odds in the table; the bit of a 32-bit float that holds its sign.
SCALE, _SIGN = 1 / 16, np.uint32(1 << 31)


def crc_mod(key: str) -> F.Column:
    """crc32 of the id as text, modulo 10; a null id is none of the parts that are set aside."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 10, F.lit(9))


def words_of(data: bytes) -> list[bytes]:
    """Runs of bytes other than space and \\t to \\r, A-Z in lower case."""
    return data.lower().split()


def word_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """word, c: how often each word occurs in the training documents. Tasks add up their own words first."""
    bound_batches(docs.sparkSession)
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])

    def counted(held: list[pa.Array]) -> pa.Table:
        counts = pa.chunked_array(held).value_counts()
        return pa.table([counts.field("values"), counts.field("counts")], ["word", "c"])

    def added(parts: list[pa.Table]) -> pa.Table:
        if len(parts) == 1:
            return parts[0]
        return pa.concat_tables(parts).group_by("word").aggregate([("c", "sum")]).select(["word", "c_sum"]).rename_columns(["word", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, parts = [], 0, []
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = as_bytes(batch.column(0))
            held.append(cut(texts)[0])
            n += sum(map(len, texts))
            if n >= WORD_BYTES:
                parts = [added([*parts, counted(held)])]
                held, n = [], 0
                if len(parts[0]) > WORDS_HELD // 2:
                    yield from parts.pop().cast(schema).to_batches()
        if held:
            parts.append(counted(held))
        if parts:
            yield from added(parts).cast(schema).to_batches()

    train = docs.where(crc_mod(key) != HELD_OUT).select(F.col(text).cast("string"))
    return written(train.mapInArrow(thrifty(run), "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "words")


class Ranks(dict):
    """Ranks of frequent words, from 0 on; -1 for others."""

    def __missing__(self, word: bytes) -> int:
        return -1

    def of(self, words: pa.LargeBinaryArray) -> np.ndarray:
        """Ranks of many words. Those of at most 16 bytes are compared as two numbers, others one by one."""
        if not hasattr(self, "short"):
            self.short = ShortWords(self)
        head, tail, plain = halves_of(words)
        rank = self.short.find(head, tail)
        other = np.flatnonzero(~plain)
        if len(other):
            found = words.take(pa.array(other)).dictionary_encode()
            different = found.dictionary.to_numpy(zero_copy_only=False).tolist()
            rank[other] = np.fromiter(map(self.__getitem__, different), np.int64, len(different))[found.indices.to_numpy()]
        return rank


# Of so many bytes from the first on, all that a number of eight bytes has.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def halves_of(words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first and the second eight bytes of words as numbers, with zeros behind the end, and whether these tell a word from
    all others: it has 1 to 16 bytes and doesn't end in a zero."""
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    begin, lengths = offsets[:-1], np.diff(offsets)
    padding = np.zeros(8, np.uint8)
    padded = np.concatenate([padding, np.frombuffer(data or b"", np.uint8)[: offsets[-1]], padding])
    # the eight bytes from each place on
    eight = np.ndarray(len(padded) - 7, np.dtype("<u8"), padded, 0, (1,))
    head = eight[begin + 8]
    head &= _FIRST_BYTES.take(lengths, mode="clip")
    tail = np.zeros(len(words), np.uint64)
    two = np.flatnonzero(lengths > 8)
    tail[two] = eight[offsets[1:].take(two)] >> (8 * np.maximum(16 - lengths.take(two), 0)).astype(np.uint64)
    plain = padded[offsets[1:] + 7] != 0
    plain &= (lengths > 0) & (lengths <= 16)
    return head, tail, plain


class ShortWords:
    """Ranks of the words that :func:`halves_of` tells from all others: places are searched from a hash of the word on."""

    def __init__(self, ranks: dict[bytes, int]):
        # by rank; one place at least can be read
        self.head, self.tail, plain = halves_of(pa.array(sorted(ranks, key=ranks.__getitem__) or [b"\0"], pa.large_binary()))
        self.bits = max(4, (4 * len(plain)).bit_length())
        # the word at each place, -1 where there is none
        self.words = np.full(1 << self.bits, -1, np.int32)
        left = np.flatnonzero(plain)
        place = self.begin(self.head[left], self.tail[left])
        while len(left):
            free = self.words[place] < 0
            self.words[place[free]] = left[free]
            out = self.words[place] != left
            left, place = left[out], self.after(place[out])

    def begin(self, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
        return (mix64(head ^ tail * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def after(self, place: np.ndarray) -> np.ndarray:
        return place + 1 & (1 << self.bits) - 1

    def find(self, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """Ranks of words as :func:`halves_of` gives them; -1 for those without."""
        rank = np.full(len(head), -1, np.int64)
        left, place = np.arange(len(head)), self.begin(head, tail)
        while len(left):
            word = self.words.take(place)
            taken = word >= 0
            same = self.head.take(word, mode="clip") == head
            same &= self.tail.take(word, mode="clip") == tail
            same &= taken
            rank[left] = np.where(same, word, -1)
            # a place that another word holds is passed
            taken ^= same
            on = np.flatnonzero(taken)
            left, place, head, tail = left.take(on), self.after(place.take(on)), head.take(on), tail.take(on)
        return rank


class Tree:
    """A Huffman code: of each symbol the path from the root, as inner node * 2 + bit, one behind the other."""

    def __init__(self, weights: np.ndarray):
        n = len(weights)
        order = np.argsort(weights, kind="stable")
        heavy = [float(x) for x in weights[order]] + [0.0] * (n - 1)
        above, bit = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.int64)
        leaf, inner = 0, n
        # leaves and inner nodes both come in order of weight: take the two lightest, n - 1 times
        for node in range(n, 2 * n - 1):
            for side in (0, 1):
                if leaf < n and (inner >= node or heavy[leaf] <= heavy[inner]):
                    at, leaf = leaf, leaf + 1
                else:
                    at, inner = inner, inner + 1
                heavy[node] += heavy[at]
                above[at], bit[at] = node, side
        root = 2 * n - 2
        self.length = np.zeros(n, np.int64)
        at = np.arange(n)
        while (going := at != root).any():
            self.length[order[going]] += 1
            at = np.where(going, above[at], root)
        self.first = np.cumsum(self.length) - self.length
        self.path = np.zeros(int(self.length.sum()), np.uint32)
        at, place = np.arange(n), (self.first + self.length)[order]
        while (going := at != root).any():
            place = place - going
            self.path[place[going]] = (above[at[going]] - n) * 2 + bit[at[going]]
            at = np.where(going, above[at], root)


class Codes:
    """The codes of words with a rank, then of an escape and an end, and the codes of bytes."""

    def __init__(self, words: list[bytes], counts: list[int], escapes: int, ends: int):
        self.words, self.counts = words, np.array(counts, np.int64)
        self.by_word = Tree(np.array([*counts, escapes + 1, ends + 1], np.float64))
        often = np.ones(256)
        for word, n in zip(words, counts, strict=True):
            # spelled words are like the rarer ones, so that each different word counts alike
            often[np.frombuffer(word, np.uint8)] += 1
            often[32] += 1
        self.by_byte = Tree(often)


def _ranks(shared: Broadcast) -> tuple[Codes, Ranks]:
    codes = shared.value
    if not hasattr(codes, "ranks"):
        codes.ranks = Ranks(zip(codes.words, range(len(codes.words)), strict=True))
    return codes, codes.ranks


class Bits:
    """Some symbols of owners, in steps that follow each other, whose bits are made a part at a time."""

    def __init__(self, owner: np.ndarray, symbol: np.ndarray, contexts: list[np.ndarray | None], tree: Tree, slots, kind: int):
        count = np.bincount(owner)
        step = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) // STEP
        contexts = [c if c is None else scrambled(c) for c in contexts]
        if step.any():
            # short integers are sorted by radix
            order = np.argsort(step.astype(np.uint16) if step.max() < 1 << 16 else step, kind="stable")
            owner, symbol, step = owner[order], symbol[order], step[order]
            contexts = [c if c is None else c[order] for c in contexts]
        self.kind, self.owner, self.symbol, self.contexts, self.tree, self.regions = kind, owner, symbol, contexts, tree, slots
        self.bounds = np.concatenate([[0], np.flatnonzero(np.diff(step)) + 1, [len(step)]])
        # where an owner's symbols of a step begin, which of these each step begins with, and whether the owner has further steps
        self.firsts = np.append(0, np.flatnonzero((owner[1:] != owner[:-1]) | (step[1:] != step[:-1])) + 1)
        self.at_first = np.searchsorted(self.firsts, self.bounds)
        self.goes_on = count[owner[self.firsts]] > (step[self.firsts] + 1) * STEP

    @property
    def bit(self) -> np.ndarray:
        return paths_of(self.tree, self.symbol)[1] & np.uint32(1)

    @property
    def slots(self) -> list[np.ndarray]:
        length, path = paths_of(self.tree, self.symbol)
        return [slots_of(c, length, path, region) for c, region in zip(self.contexts, self.regions, strict=True)]


def paths_of(tree: Tree, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the symbols' codes, and the codes behind each other."""
    length, at = places_of(tree, symbol)
    return length, tree.path.take(at, mode="clip")


def places_of(tree: Tree, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the symbols' codes, and the places of their bits in the tree's paths."""
    length = tree.length[symbol]
    ends = np.cumsum(length)
    at = np.repeat(tree.first[symbol] + length - ends, length)
    at += np.arange(len(at))
    return length, at


def scrambled(context: np.ndarray) -> np.ndarray:
    """Contexts in 32 bits, as slots are made from."""
    return (mix64(context) >> np.uint64(32)).astype(np.uint32)


def slots_of(context: np.ndarray | None, length: np.ndarray, path: np.ndarray, region: tuple[int, int]) -> np.ndarray:
    """Slots of the codes of symbols after a scrambled context each."""
    place = path >> np.uint32(1)
    if context is not None:
        place = hashed(context, length, place * MIXED, region[1])
    place = place.astype(np.int64)
    place += region[0]
    return place


# Factor of the inner nodes before they are hashed.
MIXED = np.uint32(0x9E3779B1)


def hashed(context: np.ndarray, length: np.ndarray, mixed: np.ndarray, bits: int) -> np.ndarray:
    """Slots within a region of so many bits, of scrambled contexts and inner nodes times MIXED."""
    place = np.repeat(context, length)
    place ^= mixed
    place *= np.uint32(0x85EBCA6B)
    place >>= np.uint32(32 - bits)
    return place


# Bytes between words.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def cut(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts as :func:`words_of` gives them, and where each ends if a space is put behind each text."""
    data = np.frombuffer(b"".join(t + b" " for t in texts).lower(), np.uint8)
    space = _SPACE[data]
    after = np.flatnonzero(space)
    lengths = np.diff(after, prepend=-1) - 1
    after, lengths = after[lengths > 0], lengths[lengths > 0]
    offsets = np.append(0, np.cumsum(lengths))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data[~space])]), after


def ranks_of(ranks: Ranks, texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Ranks of the words of some texts, where each text ends with -2, and the words without a rank.

    Words are those of :func:`words_of`.
    """
    words, after = cut(texts)
    rank = ranks.of(words)
    rare = words.filter(pa.array(rank == -1)).to_numpy(zero_copy_only=False).tolist()
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return np.insert(rank, np.searchsorted(after, ends - 1, "right"), -2), rare


def word_symbols(codes: Codes, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbol of each word and end, and the one and the two before it in the text, as symbols."""
    known = len(codes.words)
    symbol = np.where(rank >= 0, rank, np.where(rank == -1, known, known + 1))
    first = np.ones(len(rank), bool)
    first[1:] = rank[:-1] == -2
    before = np.where(first, known + 2, np.roll(symbol, 1))
    return symbol, before, np.where(first, known + 2, np.roll(before, 1))


def byte_symbols(rare: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of spelled words with the space behind, their bytes, and the bytes one to three places before, 0 outside."""
    data = np.frombuffer(b" ".join(rare) + b" ", np.uint8)
    lengths = np.fromiter(map(len, rare), np.int64, len(rare)) + 1
    place = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return lengths, data, *(np.where(place >= k, np.roll(data, k), 0).astype(np.uint64) for k in (1, 2, 3))


def word_contexts(before: np.ndarray, earlier: np.ndarray) -> list[np.ndarray | None]:
    near = before.astype(np.uint64)
    return [None, near, (near << np.uint64(24)) + earlier.astype(np.uint64) + np.uint64(1 << 60)]


def byte_contexts(one: np.ndarray, two: np.ndarray, three: np.ndarray) -> list[np.ndarray]:
    two = (two << np.uint64(8)) + one + np.uint64(1 << 61)
    return [one, two, (three << np.uint64(24)) + two + np.uint64(1 << 62)]


def owners_of(rank: np.ndarray) -> np.ndarray:
    """The number of the text that each word and end is from."""
    end = rank == -2
    return np.cumsum(end) - end


def bits_of(codes: Codes, rank: np.ndarray, rare: list[bytes]) -> list[Bits]:
    """The bits of some texts: of their words and ends, and of the bytes of words without a rank."""
    owner = owners_of(rank)
    symbol, before, earlier = word_symbols(codes, rank)
    parts = [Bits(owner, symbol, word_contexts(before, earlier), codes.by_word, WORD_SLOTS, 0)]
    if rare:
        lengths, data, *others = byte_symbols(rare)
        parts.append(Bits(np.repeat(owner[rank == -1], lengths), data, byte_contexts(*others), codes.by_byte, BYTE_SLOTS, 1))
    return parts


class Tally:
    """Counts the outcomes at slots. Symbols are held with their contexts until there are many; those that are alike are
    counted together, so that the bits of each different context are made once."""

    def __init__(self, codes: Codes):
        self.codes, self.table = codes, np.zeros(2 * SLOTS, np.int32)
        self.held: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])

    def add(self, rank: np.ndarray, rare: list[bytes]) -> None:
        symbol, before, earlier = (x.astype(np.uint64) for x in word_symbols(self.codes, rank))
        # symbols have less than 20 bits
        self.held[0].append(((symbol << np.uint64(20)) + before << np.uint64(20)) + earlier)
        if rare:
            _, data, one, two, three = byte_symbols(rare)
            keys = (((data.astype(np.uint64) << np.uint64(8)) + one << np.uint64(8)) + two << np.uint64(8)) + three
            self.held[1].append(keys.astype(np.uint32))
        for kind in (0, 1):
            if sum(map(len, self.held[kind])) >= SYMBOLS_HELD:
                self._count(kind)

    def _count(self, kind: int) -> None:
        if not self.held[kind]:
            return
        key = np.sort(np.concatenate(self.held[kind]))
        self.held[kind].clear()
        width, tree, regions = (20, self.codes.by_word, WORD_SLOTS) if kind == 0 else (8, self.codes.by_byte, BYTE_SLOTS)
        n = np.ones(len(key), np.int32)
        # the sorted keys begin with the symbol, so shorter contexts lie together as well; the words' first has none
        fields = 2 if kind == 0 else 3
        for k, region in zip((2, 1, 0), regions[::-1], strict=True):
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            key, n = key[first], np.add.reduceat(n, first, dtype=np.int32)
            self._add(kind, key.astype(np.uint64), n, fields, width, tree, region)
            key = key >> key.dtype.type(width)
            fields -= 1

    def _add(self, kind: int, key: np.ndarray, n: np.ndarray, fields: int, width: int, tree: Tree, region: tuple[int, int]) -> None:
        mask = np.uint64((1 << width) - 1)
        for low in range(0, len(key), SYMBOLS_TOGETHER):
            some = key[low : low + SYMBOLS_TOGETHER]
            near, *others = [(some >> np.uint64(width * (fields - 1 - i))) & mask for i in range(fields)] or [None]
            symbol = (some >> np.uint64(width * fields)).astype(np.int64)
            zero = np.zeros(len(some), np.uint64)
            if kind == 0:
                context = word_contexts(near, others[0] if others else zero)[fields] if fields else None
            else:
                context = byte_contexts(near, *others, *[zero] * (3 - fields))[fields - 1]
            length, path = paths_of(tree, symbol)
            at = slots_of(context if context is None else scrambled(context), length, path, region)
            at *= 2
            at += path & np.uint32(1)
            np.add.at(self.table, at, np.repeat(n[low : low + SYMBOLS_TOGETHER], length))

    def counts(self) -> np.ndarray:
        """Times that the decision of each slot was 0 and 1."""
        for kind in (0, 1):
            self._count(kind)
        return self.table


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts that are scored together, from their numbers of tokens."""
    begin, n = 0, 0
    for i, size in enumerate(sizes.tolist(), 1):
        n += size
        if i - begin >= READ_TOGETHER or n >= 10 * TOGETHER:
            yield begin, i
            begin, n = i, 0
    if begin < len(sizes):
        yield begin, len(sizes)


def _by_text(counts: np.ndarray, rare: list[bytes]) -> tuple[pa.ListArray, pa.ListArray]:
    """Of each text, from the number of its words without a rank and these of all: the different ones, and how often each occurs."""
    owner = pa.array(np.repeat(np.arange(len(counts)), counts))
    found = pa.table([owner, pa.array(rare, pa.binary())], ["owner", "word"])
    found = found.group_by(["owner", "word"], use_threads=False).aggregate([([], "count_all")]).sort_by("owner").combine_chunks()
    offsets = pa.array(np.searchsorted(found["owner"].to_numpy(), np.arange(len(counts) + 1)), pa.int32())
    word, times = (pa.concat_arrays(found[c].chunks) if found.num_rows else pa.array([], kind) for c, kind in (("word", pa.binary()), ("count_all", pa.int64())))
    return pa.ListArray.from_arrays(offsets, word), pa.ListArray.from_arrays(offsets, times)


def _planes(counts: np.ndarray) -> bytes:
    """The counts of a block byte by byte, first all lowest bytes, as many as the largest count has."""
    width = max(1, (int(counts.max()).bit_length() + 7) // 8)
    return b"".join([(counts >> 8 * k).astype(np.uint8).tobytes() for k in range(width)])


def _add_planes(total: np.ndarray, planes: bytes) -> np.ndarray:
    """Add what :func:`_planes` gave to 64-bit counts."""
    for k, plane in enumerate(np.frombuffer(planes, np.uint8).reshape(-1, len(total))):
        total += plane if k == 0 else plane.astype(np.int64) << 8 * k
    return total


def _from_planes(planes: bytes) -> np.ndarray:
    return _add_planes(np.zeros(2 * SLOT_BLOCK, np.int64), planes)


def count_contexts(docs: DataFrame, shared: Broadcast, text: str) -> DataFrame:
    """block, counts: times that the decision of each slot of a block was 0 and 1, from each task that saw the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, ranks = _ranks(shared)
        tally = Tally(codes)
        for batch in batches:
            if batch.num_rows:
                tally.add(*ranks_of(ranks, as_bytes(batch.column(0))))
        blocks = tally.counts().reshape(-1, 2 * SLOT_BLOCK)
        for i in np.flatnonzero(blocks.any(axis=1)):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([_planes(blocks[i])], pa.binary())], ["block", "counts"])

    return docs.select(F.col(text).cast("string")).mapInArrow(thrifty(run), "block int, counts binary")


def add_up(parts: DataFrame) -> DataFrame:
    """block, counts: one row per block, written."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, planes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if block not in total:
                    total[block] = np.zeros(2 * SLOT_BLOCK, np.int64)
                _add_planes(total[block], planes)
        for block, counts in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([_planes(counts)], pa.binary())], ["block", "counts"])

    return written(parts.repartition("block").mapInArrow(thrifty(add), "block int, counts binary"), "contexts")


def table_of(counts: DataFrame) -> np.ndarray:
    """The packed slots of all blocks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [_pack(_from_planes(x).reshape(-1, 2)).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["block", "packed"])

    table = np.zeros(SLOTS, np.uint16)
    for r in counts.mapInArrow(thrifty(pack), "block int, packed binary").toLocalIterator():
        table[r.block * SLOT_BLOCK : (r.block + 1) * SLOT_BLOCK] = np.frombuffer(r.packed, np.uint16)
    return table


def _pack(counts: np.ndarray) -> np.ndarray:
    """Log-odds of a slot in sixteenths and how often it was seen, in 16 bits."""
    zero, one = counts[:, 0], counts[:, 1]
    odds = np.clip(np.rint(16 * np.log((one + ODDS) / (zero + ODDS))), -127, 127).astype(np.int64) + 128
    seen = np.searchsorted([1, 2, 4, 8, 32], zero + one, "right")
    return (odds | (seen << 8)).astype(np.uint16)


class Mixer:
    """Reads texts with a table and gate weights."""

    def __init__(self, codes: Codes, ranks: Ranks, table: np.ndarray, weights: np.ndarray):
        # a copy of its own lies in large pages, which random places are read from faster; its log-odds are signed bytes, and
        # the last region's times seen are steps of SEEN gates
        self.codes, self.ranks, self.table = codes, ranks, table ^ np.uint16(128)
        self.regions = [[self.table[first : first + (1 << bits)] for first, bits in slots] for slots in (WORD_SLOTS, BYTE_SLOTS)]
        for regions in self.regions:
            regions[2] += (regions[2] >> np.uint16(8)) * np.uint16((SEEN - 1) << 8)
        # words' first region has no context: its log-odds lie above the paths' 20 bits, in the highest byte
        self.paths = [codes.by_word.path.copy(), codes.by_byte.path]
        for low in range(0, len(self.paths[0]), SLOT_BLOCK):
            some = self.paths[0][low : low + SLOT_BLOCK]
            some |= (self.table.take(some >> np.uint32(1), mode="clip") & np.uint16(255)).astype(np.uint32) << np.uint32(24)
        self.weights = weights.astype(np.float32)
        self.slope = np.full(weights.shape, 1e-3)

    def read(self, texts: list[list[bytes]], learn: bool = False) -> np.ndarray:
        """Natural logarithm of the probability of each text, given as words."""
        return self.read_ranked(*ranks_of(self.ranks, [b" ".join(words) for words in texts]), learn)

    def read_ranked(self, rank: np.ndarray, rare: list[bytes], learn: bool = False) -> np.ndarray:
        """The same of texts given by :func:`ranks_of`.

        Every text starts from the given weights and refines them; with ``learn`` all start from, and change, the
        mixer's own.
        """
        n = int((rank == -2).sum())
        total = np.zeros(n)
        for bits in bits_of(self.codes, rank, rare):
            own = 1 if learn else n
            # log-odds are read in sixteenths, so weights are taken by SCALE; powers of two change no digit
            gates = slice(bits.kind * KIND_GATES, (bits.kind + 1) * KIND_GATES)
            weights = np.repeat(self.weights.T[:, None, gates] * SCALE, own, axis=1).reshape(CONTEXTS, -1)
            # the bits of a step at a time, which stay in the processor's cache
            for i, (low, high) in enumerate(zip(bits.bounds[:-1], bits.bounds[1:], strict=True)):
                length, place = places_of(bits.tree, bits.symbol[low:high])
                path = self.paths[bits.kind].take(place, mode="clip")
                owners = slice(bits.at_first[i], bits.at_first[i + 1])
                first = bits.firsts[owners] - low
                owner = bits.owner[bits.firsts[owners]]
                size = np.add.reduceat(length, first)
                mixed = path & np.uint32((1 << 24) - 1)
                mixed >>= np.uint32(1)
                mixed *= MIXED
                packed = [
                    None if c is None else region.take(hashed(c[low:high], length, mixed, width), mode="clip")
                    for c, region, (_, width) in zip(bits.contexts, self.regions[bits.kind], bits.regions, strict=True)
                ]
                x = [((path >> np.uint32(24)) if p is None else p).astype(np.int8).astype(np.float32) for p in packed]
                cell = packed[2] >> np.uint16(8)
                cell += packed[1] >> np.uint16(8)
                # weights of the owners from the first to the last that are still read
                base, cells = (0, KIND_GATES) if learn else (int(owner[0]) * KIND_GATES, int(owner[-1] - owner[0] + 1) * KIND_GATES)
                mine = [w[base : base + cells] for w in weights]
                at = np.repeat(owner * (0 if learn else KIND_GATES) - base, size)
                at += cell
                # the sign of a float where the bit is 0
                sign = path << np.uint32(31)
                sign ^= _SIGN
                right = mine[0].take(at, mode="clip")
                right *= x[0]
                for k in range(1, CONTEXTS):
                    added = mine[k].take(at, mode="clip")
                    added *= x[k]
                    right += added
                right.view(np.uint32)[:] ^= sign
                # right: log-odds of the outcome; its cost is log(1 + exp(-right)), and miss the other's probability
                small = (right.view(np.uint32) | _SIGN).view(np.float32)
                np.exp(small, out=small)
                more = small + np.float32(1)
                cost = np.log(more)
                cost -= np.minimum(right, 0)
                begin = np.cumsum(size) - size
                total[owner] -= np.add.reduceat(cost.astype(np.float64), begin)
                # weights that no further step of their text reads need no refining
                goes_on = bits.goes_on[owners]
                if not learn and not goes_on.any():
                    continue
                rest = slice(0 if learn else int(begin[goes_on.argmax()]), None)
                at, small = at[rest], small[rest]
                small /= more[rest]
                # 1 - small where the other outcome was likelier
                miss = (right[rest] < 0).astype(np.float32)
                miss -= small
                np.abs(miss, out=miss)
                miss.view(np.uint32)[:] ^= sign[rest]
                for k in range(CONTEXTS):
                    slope = np.bincount(at, miss * x[k][rest], cells)
                    slope *= SCALE
                    if learn:
                        self.slope[gates, k] += slope * slope
                        mine[k] += LEARN_RATE * slope / np.sqrt(self.slope[gates, k]) * SCALE
                    else:
                        slope *= RATE * SCALE
                        mine[k] += slope
            if learn:
                self.weights[gates] = weights.T / SCALE
        return total


def learn_weights(docs: DataFrame, shared: Broadcast, table: Broadcast, key: str, text: str) -> np.ndarray:
    """Gate weights: groups of the documents set aside for it learn their own; they are averaged by texts read.

    Groups and the order within them follow from the texts, and runs of texts read together from the number of tokens, so
    the weights are the same however the documents are partitioned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mixer, n, held, tokens = None, None, 0, [], 0

        def learned() -> pa.RecordBatch:
            if held:
                mixer.read(held, learn=True)
            cells = mixer.weights.ravel().astype(np.float64)
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([n]), pa.array([cells.tolist()])], ["group", "n", "cells"])

        for batch in batches:
            for group, data in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                if group != now:
                    if n:
                        yield learned()
                    now, mixer, n, held, tokens = group, Mixer(*_ranks(shared), table.value, FIRST), 0, [], 0
                held.append(words_of(data))
                tokens += len(held[-1]) + 1
                n += 1
                if tokens >= TOGETHER:
                    mixer.read(held, learn=True)
                    held, tokens = [], 0
        if n:
            yield learned()

    part = docs.where(crc_mod(key) == WEIGHING).select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    grouped = part.select(F.pmod(F.xxhash64("text"), F.lit(GROUPS)).alias("group"), "text").repartition(GROUPS, "group")
    # an order without regard to the alphabet, in which equal texts lie together
    ordered = grouped.sortWithinPartitions("group", F.xxhash64(F.lit(1), "text"), "text")
    # a row of bounded size for each group
    rows = ordered.mapInArrow(thrifty(run), "group long, n long, cells array<double>").collect()
    found = [(r.n, np.array(r.cells)) for r in sorted(rows, key=lambda r: r.group)]
    total = sum(n for n, _ in found)
    mean = sum(n * np.where(np.isfinite(c), c, FIRST.ravel()) for n, c in found) / total if total else FIRST.ravel()
    return mean.reshape(GATES, CONTEXTS)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: key, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Training documents are those whose id's crc32 modulo 10 isn't 0; rows with a null id train. A null text is empty
    and has one token, its end. Without training documents all base scores are 0 and each decision has even odds.
    Repeated rows give a row each; an empty table gives none.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    words = word_counts(docs, key, text)
    size = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_end = docs.where(crc_mod(key) != HELD_OUT).count()
    train_tokens, different = size.n + n_end, size.v + (n_end > 0)
    divisor = train_tokens + BASE * (different + 1)
    often = (F.octet_length("word") <= RANK_BYTES) & (F.col("c") >= RANK_LEAST)
    top = words.where(often).orderBy(F.desc("c"), "word").limit(RANKS).toArrow()
    ranked = top["c"].to_pylist()
    shared = spark.sparkContext.broadcast(Codes(top["word"].to_pylist(), ranked, size.n - sum(ranked), n_end))
    weighing = docs.where(crc_mod(key) == WEIGHING)
    counted = add_up(count_contexts(docs.where((crc_mod(key) != HELD_OUT) & (crc_mod(key) != WEIGHING)), shared, text))
    # weights are learned on documents that the table has not seen; then these are counted as well
    partial = spark.sparkContext.broadcast(table_of(counted))
    weights = spark.sparkContext.broadcast(learn_weights(docs, shared, partial, key, text))
    partial.unpersist()
    table = spark.sparkContext.broadcast(table_of(add_up(counted.unionByName(count_contexts(weighing, shared, text)))))
    kind = docs.schema[key].dataType
    outputs = "row long, held_out boolean, n_tokens long, n_known long, base double, ln double, n_bytes long, rare array<binary>, times array<long>"
    schema = T.StructType([T.StructField("key", kind), *T.StructType.fromDDL(outputs).fields])
    arrow = [to_arrow_type(f.dataType) for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, ranks = _ranks(shared)
        mixer = Mixer(codes, ranks, table.value, weights.value)
        # the last entries are for an end and for words without a rank, whose part is added later
        logs = np.append(np.log10((codes.counts + BASE) / divisor), [np.log10((n_end + BASE) / divisor), 0.0])
        done = TaskContext.get().partitionId() << 33
        for batch in batches:
            # texts of like length are read together, so that few steps are left to a long one alone
            batch = batch.take(pc.sort_indices(pc.fill_null(pc.binary_length(batch.column(2)), 0)))
            texts = as_bytes(batch.column(2))
            if not texts:
                continue
            all_ranks, all_rare = ranks_of(ranks, texts)
            after = np.flatnonzero(all_ranks == -2) + 1
            rare_after = np.append(0, np.cumsum(all_ranks == -1))
            for low, high in _runs(np.diff(after, prepend=0)):
                n, start = high - low, int(after[low - 1]) if low else 0
                rank, rare = all_ranks[start : after[high - 1]], all_rare[rare_after[start] : rare_after[after[high - 1]]]
                begin = np.append(0, after[low : high - 1] - start)
                words_left, times = _by_text(np.add.reduceat(rank == -1, begin, dtype=np.int64), rare)
                columns = [
                    batch.column(0).slice(low, n),
                    range(done, done + n),
                    batch.column(1).slice(low, n),
                    np.diff(begin, append=len(rank)),
                    np.add.reduceat(rank >= 0, begin, dtype=np.int64) + (n_end > 0),
                    np.add.reduceat(logs[rank], begin),
                    mixer.read_ranked(rank, rare),
                    [len(x) for x in texts[low:high]],
                    words_left,
                    times,
                ]
                done += n
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, arrow, strict=True)], schema.names
                )

    source = docs.select(F.col(key).alias("key"), (crc_mod(key) == HELD_OUT).alias("held_out"), F.col(text).cast("string"))
    # written, since the numbers of rows are made in the tasks
    rows = written(source.mapInArrow(thrifty(run), schema), "scores")
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), "x.times")
    c = F.coalesce("c", F.lit(0))
    # words that are more frequent than the last rank have one, unless they are too long
    others = words.where((F.octet_length("word") > RANK_BYTES) | (F.col("c") <= max(min(ranked, default=0), RANK_LEAST)))
    looked_up = rare.join(others, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10((c + BASE) / F.lit(divisor))).alias("rare_base"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    joined = rows.drop("rare", "times").join(looked_up, "row", "left")
    return joined.select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("ln") / F.log(F.lit(10.0))).alias("score"),
        (-F.col("ln") / F.log(F.lit(2.0)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
