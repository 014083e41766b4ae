"""Split texts into pre-tokens as the tokenizer libraries do.

Python's pattern engines and the tokenizer libraries know different Unicode versions. The characters that
``\\p{L}``, ``\\p{N}`` and ``\\s`` stand for are therefore asked from the library itself and written into the pattern
as ranges. Most texts have no character from U+0540 on; they use a pattern that is made in no time.
"""

from __future__ import annotations

import functools
import re
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa

EARLY = 0x540
# UTF-8 bytes below this one can only belong to characters before EARLY.
LATE_BYTE = 0xD5
CLASSES = (r"\p{L}", r"\p{N}", r"\s")


def _characters(below: int) -> str:
    return "".join(chr(i) for i in range(below) if not 0xD800 <= i <= 0xDFFF)


def tiktoken_class(name: str, below: int) -> set[str]:
    """Characters that tiktoken's pattern engine holds to be in a class."""
    import tiktoken

    single = {bytes([i]): i for i in range(256)}
    encoding = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks=single, special_tokens={})
    return set(encoding.decode(encoding.encode_ordinary(_characters(below))))


def tokenizers_class(name: str, below: int) -> set[str]:
    """Characters that the pattern engine of the tokenizers library holds to be in a class."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    split = Split(Regex(f"[^{name}]+"), behavior="removed")
    return {c for part, _ in split.pre_tokenize_str(_characters(below)) for c in part}


LIBRARIES = {"tiktoken": tiktoken_class, "tokenizers": tokenizers_class}


def _ranges(characters: set[str]) -> str:
    """The inside of a set that holds exactly these characters."""
    spans: list[list[int]] = []
    for code in sorted(map(ord, characters)):
        if spans and code == spans[-1][1] + 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)


def pattern_for(pattern: str, library: str, below: int) -> re.Pattern:
    """The pattern with its classes written out, for texts of characters before ``below``."""
    inside = {name: _ranges(LIBRARIES[library](name, below)) for name in CLASSES}
    # first within sets, where the ranges stand bare, then outside
    pattern = re.sub(r"\[\^[^\]]*\]", lambda m: functools.reduce(lambda s, n: s.replace(n, inside[n]), CLASSES, m[0]), pattern)
    for name in CLASSES:
        pattern = pattern.replace(name, f"[{inside[name]}]")
    return re.compile(pattern.replace(r"\S", f"[^{inside[CLASSES[2]]}]"))


@functools.lru_cache(maxsize=4)
def splitter(pattern: str, library: str) -> Callable[[bytes], list[str]]:
    """A function from the UTF-8 bytes of a text to its pre-tokens; library is 'tiktoken' or 'tokenizers'."""
    early = pattern_for(pattern, library, EARLY).findall
    late: list[Callable[[str], list[str]]] = []

    def split(data: bytes) -> list[str]:
        text = data.decode()
        if len(text) == len(data) or is_early(data):
            return early(text)
        if not late:
            late.append(pattern_for(pattern, library, sys.maxunicode + 1).findall)
        return late[0](text)

    return split


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters for
    themselves, characters from U+0100 on for the other bytes in their order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


def is_early(data: bytes) -> bool:
    """Whether UTF-8 bytes hold only characters before EARLY."""
    return data.isascii() or (max(data) if len(data) < 100 else np.frombuffer(data, np.uint8).max()) < LATE_BYTE


@functools.lru_cache(maxsize=2)
def rank_encoder(path: str, pattern: str) -> Callable[[str], list[int]] | None:
    """The ids that the tokenizers library gives texts of early characters for a byte-level file, found by tiktoken, which is
    several times faster; None where the two could differ.

    They agree if merges come in the order of the ids they make and the pattern's classes are the same.
    """
    import json

    import tiktoken

    if any(tiktoken_class(name, EARLY) != tokenizers_class(name, EARLY) for name in CLASSES):
        return None
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    vocabulary, added = whole["model"]["vocab"], {t["content"] for t in whole.get("added_tokens", [])}
    made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in whole["model"]["merges"]]
    known = byte_of()
    if any(a >= b for a, b in zip(made, made[1:], strict=False)):
        return None
    ranks = {bytes(map(known.__getitem__, entry)): i for entry, i in vocabulary.items() if entry not in added}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def units(text: str) -> list[str] | None:
    """Cut a text into words that can be split into pre-tokens one by one; None if its white space is not plain.

    No pre-token crosses the gap before a single space or line break that stands between two other characters: a space
    belongs to what follows it, a line break is a pre-token of its own. A word that follows a line break is given with
    it, other words without the space before them. White space is what Python knows as such, which takes in all that
    the libraries do.
    """
    words = text.split()
    breaks = text.count("\n")
    gaps = breaks + text.count(" ")
    if len(words) != gaps + 1 or sum(map(len, words)) + gaps != len(text):
        return None
    return text.replace("\n", " \n").split(" ") if breaks else words


# A key of WordMemory for a string as it stands; no word begins with this character.
AS_IS = "\t"


def spelled(key: str) -> str:
    """The string that a key of WordMemory stands for: other words than those behind a line break have a space before them."""
    return key[1:] if key[0] == AS_IS else key if key[0] == "\n" else " " + key


class WordMemory:
    """Remembers what ``make`` gives for strings. It forgets all when it outgrows its bytes, except what it began with.

    ``make`` turns a list of strings into a list of values of about the size of the strings; none may be None.
    """

    # Bytes of an entry beside its characters.
    ENTRY = 200

    def __init__(self, make: Callable[[list[str]], list], size: int, first: dict | None = None) -> None:
        self._make, self._size, self._first = make, size, first or {}
        self._known, self._used = dict(self._first), 0

    def __call__(self, keys: list[str]) -> list:
        """The values of words as :func:`units` gives them, and of strings marked with AS_IS."""
        found = list(map(self._known.get, keys))
        if None in found:
            if self._used > self._size:
                self._known, self._used = dict(self._first), 0
            at = [i for i, value in enumerate(found) if value is None]
            new = list({keys[i] for i in at})
            made = dict(zip(new, self._make([spelled(k) for k in new]), strict=True))
            self._known.update(made)
            self._used += sum(map(len, new)) * 2 + self.ENTRY * len(new)
            for i in at:
                found[i] = made[keys[i]]
        return found


def keys_of(text: str, split: Callable[[bytes], list[str]]) -> list[str]:
    """What WordMemory is asked for a text: its words, or its pre-tokens where white space is not plain."""
    words = units(text)
    if words is None:
        return [AS_IS + piece for piece in split(text.encode())] if text else []
    words[0] = AS_IS + words[0]
    return words


# Bytes that may belong to white space other than a space or a line break: ASCII ones, and the first of longer characters.
_ODD = np.zeros(256, bool)
_ODD[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0xE1, 0xE2, 0xE3]] = True
_GAP = np.zeros(256, bool)
_GAP[[0x09, 0x0A, 0x20]] = True


def keys_together(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The keys of texts behind each other, as :func:`keys_of` gives them, how many each text has, and whether it was left out.

    Texts are left out, with no keys, if they are empty or their white space is, or may be, not plain.
    """
    # AS_IS before each text marks its first word; where a text holds it itself, it is left out
    data = np.frombuffer(b"".join(AS_IS.encode() + t for t in texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    starts = np.cumsum(sizes) - sizes
    gaps = np.flatnonzero(_GAP[data])
    lengths = np.diff(gaps, append=len(data))
    odd = np.flatnonzero(_ODD[data])
    odd = odd[~np.isin(odd, starts)]
    latin = np.flatnonzero(data[:-1] == 0xC2)
    latin = latin[np.isin(data[latin + 1], (0x85, 0xA0))]
    out = np.zeros(len(texts), bool)
    for places in (odd, latin, gaps[lengths == 1]):
        out[np.searchsorted(starts, places, "right") - 1] = True
    counts = np.diff(np.searchsorted(gaps, starts), append=len(gaps))
    spaces = data == 0x20
    ends = np.append(0, np.cumsum(lengths - spaces[gaps])).astype(np.int64)
    keys = pa.LargeStringArray.from_buffers(len(gaps), pa.py_buffer(ends), pa.py_buffer(data[~spaces])) if len(gaps) else pa.array([], pa.large_string())
    if out.any():
        keys = keys.filter(pa.array(np.repeat(~out, counts)))
        counts[out] = 0
    return keys, counts, out
