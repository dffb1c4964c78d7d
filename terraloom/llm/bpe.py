"""BPE encoding and decoding with forced boundaries.

Two neighbouring bytes that stand side by side in no token of the vocabulary can never be merged, so a cut between them is
certain. Words are cut there, the fragments are encoded independently and the results are joined. Long words without white
space thus cost no more than their fragments.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, sliced, widened
from .words import Cache, WordPattern


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for themselves, the others for U+0100 onwards."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b) if b in shown else chr(256 + extra))
        extra += b not in shown
    return out


LETTERS = byte_letters()
BYTES = {c: b for b, c in enumerate(LETTERS)}


SHORT, NEVER, ID = 100, 1 << 60, (1 << 24) - 1


class Merges:
    """Byte-pair merges over token ids, by rank, then from the left."""

    def __init__(self, vocab: dict[str, int], merges: list):
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.pairs = {vocab[a] << 24 | vocab[b]: k << 24 | vocab[a + b] for k, (a, b) in reversed([*enumerate(pairs)])}

    def run(self, ids: list[int]) -> list[int]:
        if len(ids) > SHORT:
            return self._long(ids)
        get = self.pairs.get
        todo = [get(a << 24 | b, NEVER) for a, b in zip(ids, ids[1:], strict=False)]
        while todo and (least := min(todo)) < NEVER:
            k = todo.index(least)
            del todo[k], ids[k + 1]
            ids[k] = new = least & ID
            if k:
                todo[k - 1] = get(ids[k - 1] << 24 | new, NEVER)
            if k < len(todo):
                todo[k] = get(new << 24 | ids[k + 1], NEVER)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        """The same with a heap: n log n."""
        n, get = len(ids), self.pairs.get
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(v, k, ids[k], ids[k + 1]) for k in range(n - 1) if (v := get(ids[k] << 24 | ids[k + 1]))]
        heapq.heapify(heap)
        while heap:
            v, k, a, b = heapq.heappop(heap)
            j = right[k]
            if ids[k] != a or j >= n or ids[j] != b:
                continue
            ids[k], ids[j], right[k] = v & ID, -1, right[j]
            if right[k] < n:
                left[right[k]] = k
            for x, y in ((left[k], k), (k, right[k])):
                if x >= 0 and y < n and (v := get(ids[x] << 24 | ids[y])):
                    heapq.heappush(heap, (v, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]


class Bpe:
    """A vocabulary file of the tokenizers library: NFC, lower case, words by pattern, byte letters, merges, word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.merges = Merges(self.vocab, model["merges"])
        self.end = model["end_of_word_suffix"] or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        plain = all(not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"])
        if kinds != ["NFC", "Replace", "Lowercase"] or (split["behavior"], split["invert"], level["use_regex"], level["add_prefix_space"]) != ("Removed", True, False, False) or spec["decoder"] or not plain:
            raise ValueError("this vocabulary needs other steps than those written here")
        self.word = WordPattern(path, split["pattern"]["Regex"])
        self.special = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.names = {i: t for t, i in [*self.vocab.items(), *self.added.items()]}
        self.letter, self.last = [self.vocab[c] for c in LETTERS], [self.vocab[c + self.end] for c in LETTERS]
        self.inside = set()
        for t in self.vocab:
            body = [BYTES[c] for c in t.removesuffix(self.end) if c in BYTES]
            self.inside.update(zip(body, body[1:], strict=False))

    def fragments(self, word: bytes) -> list[bytes]:
        """The word cut between all neighbouring bytes that are side by side in no token."""
        cuts = [k for k, p in enumerate(zip(word, word[1:], strict=False), 1) if p not in self.inside]
        return [word[x:y] for x, y in zip([0, *cuts], [*cuts, len(word)], strict=True)] if cuts else [word]

    def fragment(self, body: bytes, last: bool) -> list[int]:
        ids = [self.letter[b] for b in body]
        if last:
            ids[-1] = self.last[body[-1]]
        return self.merges.run(ids)

    def encode_word(self, word: str) -> tuple[int, ...]:
        parts = self.fragments(word.encode("utf-8", "replace"))
        if len(parts) == 1:
            return tuple(self.fragment(parts[0], True))
        return tuple(chain.from_iterable(self.fragment(p, k == len(parts) - 1) for k, p in enumerate(parts)))

    def pieces(self, text: str) -> Iterator[tuple[list[str], int | None]]:
        """(words, id of the special token behind them) in order."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield self._words(text[at : m.start()]), self.added[m[0]]
            at = m.end()
        yield self._words(text[at:]), None

    def _words(self, text: str) -> list[str]:
        if self.word.odd(text):
            # The library's tables may also compose or lower-case what Python's leave alone.
            return self.word.words(self.word.library.normalizer.normalize_str(text), True)
        # One letter at a time: a sigma at a word's end is no special case.
        return self.word.usual.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def decode(self, ids) -> str:
        return " ".join(self.names[i] for i in ids)


@lru_cache(4)
def _loaded(path: str) -> tuple[Bpe, Cache]:
    bpe = Bpe(path)
    return bpe, packed_words(bpe)


def packed_words(bpe: Bpe) -> Cache:
    """Words' ids in 32 bits each: a tuple of numbers would take several times the memory, and a worker keeps it between tasks."""
    return Cache(lambda word: array("i", bpe.encode_word(word)).tobytes())


def packed_text(bpe: Bpe, cache: Cache, text: str) -> bytes:
    """The ids of ``encode_text`` in 32 bits each; ``cache`` is one of ``packed_words``."""
    out: list[bytes] = []
    for words, special in bpe.pieces(text):
        out.extend(map(cache.__getitem__, words))
        if special is not None:
            out.append(array("i", (special,)).tobytes())
    return b"".join(out)


def encode_text(bpe: Bpe, cache: Cache, text: str) -> list[int]:
    out: list[int] = []
    for words, special in bpe.pieces(text):
        out.extend(chain.from_iterable(map(cache.__getitem__, words)))
        if special is not None:
            out.append(special)
    return out


def encode(docs: DataFrame, path: str, text_col: str = "text", decoded: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` plus ``ids`` (array of int), ``n_tokens`` and, if asked for, ``decoded``.

    ``path`` names a vocabulary file that every executor has. Whole texts are encoded, without special tokens at their ends;
    strings of special tokens inside a text become those tokens. Null and empty texts have no tokens and decode to an empty
    text. Equal texts have equal results. Columns of ``docs`` named like a result are replaced, the text column is not.
    """
    ship(docs.sparkSession)
    new = ["ids", "n_tokens", *["decoded"] * decoded]
    if text_col in new:
        raise ValueError("the text column has the name of a result")
    out = docs.select(*[c for c in docs.columns if c not in new])
    schema = widened(out.schema, "ids array<int>, decoded string" if decoded else "ids array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, cache = _loaded(path)
        for whole in batches:
            for b in sliced(whole, text_col):
                got = [packed_text(bpe, cache, t or "") for t in b.column(text_col).to_pylist()]
                ends = (np.cumsum([0, *map(len, got)]) // 4).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(got), np.int32)))
                more = [pa.array([bpe.decode(memoryview(g).cast("i")) for g in got], pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays([*b.columns, ids, *more], names=schema.names)

    out = out.mapInArrow(run, schema)
    return out.select(*[c for c in out.columns if c not in new], "ids", F.size("ids").cast("long").alias("n_tokens"), *["decoded"] * decoded)


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All rows and columns of ``df`` plus the decoded text: token strings joined by blanks; null ids give an empty text."""
    ship(df.sparkSession)
    out = df.select(*[c for c in df.columns if c != text_col or c == ids_col])
    schema = widened(out.schema, f"`{text_col}` string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = _loaded(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([bpe.decode(g or ()) for g in b.column(ids_col).to_pylist()], pa.string())], names=schema.names)

    return out.mapInArrow(run, schema)
