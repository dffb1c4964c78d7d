"""Words for the operators that run in Arrow batches: split at white space, folded, hashed to 64 bits.

Tables of words seen are caches of bounded size; emptying one never changes a result.
"""

from __future__ import annotations

import unicodedata
from functools import cached_property

import numpy as np
import regex
import xxhash
from tokenizers import Tokenizer

KNOWN, LONGEST = 300_000, 64
#: What is first tried at the ends of a chunk.
EDGES = ".,;:!?'\"()[]{}#*$%&|<>-_/=+~`«»“”‘’…"


def fold(chunk: str) -> str:
    """The chunk lower-cased, with its letters and digits only."""
    low = chunk.lower()
    if low.isalnum() or (low := low.strip(EDGES)).isalnum():
        return low
    return "".join(filter(str.isalnum, low))


class Cache(dict):
    """A bounded cache: ``make`` computes what is missing; long keys aren't kept.

    When it holds ``most`` keys they become the old generation, of which only keys asked for again come back.
    """

    def __init__(self, make, most: int = KNOWN):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def word_hash(chunk: str) -> int:
    """64 bits of the folded chunk; 0 where nothing is left of it."""
    word = fold(chunk)
    return (xxhash.xxh3_64_intdigest(word) or 1) if word else 0


def hashed_words(text: str, cache: Cache) -> np.ndarray:
    """The hashes of the text's words in order."""
    chunks = text.split()
    out = np.fromiter(map(cache.__getitem__, chunks), np.uint64, len(chunks))
    return out if out.all() else out[out != 0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the runs of ``size`` words; fewer words make one shingle, none make none."""
    if not len(words):
        return words
    n = min(size, len(words))
    with np.errstate(over="ignore"):
        acc = np.full(len(words) - n + 1, n, np.uint64)
        for k in range(n):
            acc = mix(acc + words[k : len(words) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
    return acc


class WordPattern:
    """A vocabulary's word pattern, with the letters and numbers that its library knows.

    The Unicode tables of the library and of ``regex`` are of different versions, which agree on the code points that Python's
    tables assign. Texts with any other are ``odd``: the library itself cuts them into words.
    """

    def __init__(self, path: str, pattern: str):
        self.path, self.usual = path, regex.compile(pattern, regex.V0)
        self.assigned: set[str] = set()

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def odd(self, text: str) -> bool:
        if text.isascii() or not (new := set(text) - self.assigned):
            return False
        unknown = {c for c in new if unicodedata.category(c) == "Cn"}
        self.assigned |= new - unknown
        return bool(unknown)

    def spans(self, text: str, odd: bool) -> list[tuple[int, int]]:
        """Where the words of a text stand; ``odd`` tells of the text it is part of."""
        if odd:
            return [at for _, at in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return [m.span() for m in self.usual.finditer(text)]

    def words(self, text: str, odd: bool) -> list[str]:
        return [text[a:b] for a, b in self.spans(text, True)] if odd else self.usual.findall(text)
