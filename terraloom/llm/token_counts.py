"""Token counts by dynamic programming over prefixes.

The encoding of a prefix of a word is that of a shorter prefix plus one token: the token that ends there and may stand behind
the shorter prefix's last one. So one pass gives the exact number of tokens of every prefix, and questions about truncation
and budgets are lookups in the stored counts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import LETTERS, NEVER, Merges
from .common import ship, sliced, widened
from .words import LONGEST, Cache, WordPattern

#: The word pattern of byte-level vocabularies that leave it to the library.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHORT_FORMS, SPACE = ("'re", "'ve", "'ll"), regex.compile(r"\s+")
#: States of words' beginnings are kept for lengths that are multiples of this.
STRIDE = 4


class PrefixCounter:
    """Counts for a byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, level = spec["model"], spec["pre_tokenizer"]
        plain = all(not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"])
        if spec["normalizer"] or (level["type"], level["use_regex"], level["add_prefix_space"]) != ("ByteLevel", True, False) or model["end_of_word_suffix"] or not plain:
            raise ValueError("this vocabulary needs other steps than those written here")
        self.ranks = {(a, b): k for k, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"])}
        # Each token with the rank of the merge that makes it and its two halves; single letters have none.
        self.made: dict[str, tuple[int, str, str]] = {c: (-1, "", "") for c in LETTERS}
        for (a, b), k in self.ranks.items():
            self.made.setdefault(a + b, (k, a, b))
        vocab = model["vocab"]
        merges = Merges(vocab, model["merges"])
        self.made = {t: x for t, x in self.made.items() if t in vocab and (x[0] < 0 or merges.run([vocab[c] for c in t]) == [vocab[t]])}
        self.token = {t: t for t in self.made}
        self.tails = {t[k:] for t in self.made for k in range(len(t))}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.find_special = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.word = WordPattern(path, PATTERN)
        self.allowed = lru_cache(300_000)(self._allowed)
        self.states = Cache(self._state, 100_000)
        self.totals = Cache(lambda w: self._state(self.letters(w))[1][-1])
        self.prefixes = Cache(self.word_counts, 50_000)

    def letters(self, word: str) -> str:
        return "".join([LETTERS[b] for b in word.encode("utf-8", "replace")])

    def _allowed(self, a: str, b: str) -> bool:
        """Whether tokens a and b may stand side by side: no merge across their border comes before those that make them.

        The merges that make either token are undone from the last one back, keeping the parts at the border.
        """
        made, rank = self.made, self.ranks.get
        (ra, _, a2), (rb, b1, _) = made[a], made[b]
        until = NEVER
        while True:
            # Merges of equal rank happen from the left: one inside a comes before the border, one inside b after it.
            if rank((a, b), NEVER) < until:
                return False
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                until, a = ra, a2
                ra, _, a2 = made[a]
            else:
                until, b = rb + 1, b1
                rb, b1, _ = made[b]

    def _state(self, s: str) -> tuple[list[str], list[int]]:
        """(last token, number of tokens) of each prefix of a word's letters; the states of its beginnings are kept.

        Only beginnings that the cache keeps are asked for, so the calls nest at most LONGEST / STRIDE deep, however long the word is.
        """
        known = min(len(s) - 1, LONGEST) // STRIDE * STRIDE
        if known > 0:
            last, count = self.states[s[:known]]
            last, count = last[:], count[:]
        else:
            last, count, known = [""], [0], 0
        token, tails, allowed = self.token, self.tails, self.allowed
        for end in range(known + 1, len(s) + 1):
            found, start = [], end - 1
            while start >= 0 and (t := s[start:end]) in tails:
                if t in token:
                    found.append((start, token[t]))
                start -= 1
            for start, t in reversed(found):
                if not start or allowed(last[start], t):
                    last.append(t)
                    count.append(count[start] + 1)
                    break
        return last, count

    def word_counts(self, word: str) -> np.ndarray:
        """The number of tokens of each prefix of one word, by its characters, from 1 on."""
        count = self._state(self.letters(word))[1]
        ends = np.cumsum([len(c.encode("utf-8", "replace")) for c in word])
        out = np.array(count)[ends]
        if word in SHORT_FORMS:
            out[1] = 2  # up to there the quote and the letter are words of their own
        return out

    def total(self, text: str) -> int:
        """The number of tokens of the whole text."""
        n, at, odd = 0, 0, self.word.odd(text)
        for m in self.find_special.finditer(text) if self.find_special else ():
            n += sum(map(self.totals.__getitem__, self.word.words(text[at : m.start()], odd))) + 1
            at = m.end()
        return n + sum(map(self.totals.__getitem__, self.word.words(text[at:], odd)))

    def chars_within(self, text: str, budget: int) -> int:
        """The most characters whose prefix has at most ``budget`` tokens, from the counts of words and of one word's prefixes.

        Words behind the first that passes the budget can't fit, as each adds a token; white space at a prefix's end is one word.
        """
        if self.find_special and self.find_special.search(text):
            return int(np.flatnonzero(self.counts(text) <= budget)[-1])
        base, before, totals, odd = 0, "", self.totals, self.word.odd(text)
        spans = self.word.spans(text, True) if odd else (m.span() for m in self.word.usual.finditer(text))
        for start, end in spans:
            word = text[start:end]
            n = totals[word]
            if base + n > budget:
                break
            base, before = base + n, word
        else:
            return len(text)
        counts, first = base + self.prefixes[word], start
        if SPACE.match(word):
            held = len(before) if SPACE.fullmatch(before) else 0
            run = SPACE.match(text, start - held)[0]
            inside = base - (totals[before] if held else 0) + self.prefixes[run]
            counts, first = np.concatenate((inside, counts[len(run) - held :])), start - held
        fits = np.flatnonzero(counts <= budget)
        return first + int(fits[-1]) + 1 if len(fits) else first

    def _plain(self, text: str) -> np.ndarray:
        """Counts of the prefixes of 0, 1, ... characters of a text whose special strings count as text."""
        out, base = np.zeros(len(text) + 1, np.int64), 0
        for start, end in self.word.spans(text, self.word.odd(text)):
            out[start + 1 : end + 1] = base + self.prefixes[text[start:end]]
            base = int(out[end])
        # White space at a prefix's end is one word, whatever follows it in the text.
        for m in SPACE.finditer(text):
            out[m.start() + 1 : m.end() + 1] = out[m.start()] + self.prefixes[m[0]]
        return out

    def counts(self, text: str) -> np.ndarray:
        """The number of tokens of each prefix of 0, 1, ... characters of the text."""
        parts, base, at = [np.zeros(1, np.int64)], 0, 0
        for m in self.find_special.finditer(text) if self.find_special else ():
            inside = self._plain(text[at : m.end() - 1])
            base_here = base + int(inside[m.start() - at])
            parts += [base + inside[1:], np.array([base_here + 1])]
            base, at = base_here + 1, m.end()
        parts.append(base + self._plain(text[at:])[1:])
        return np.concatenate(parts)


@lru_cache(4)
def _loaded(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", prefixes: bool = False, budget: int | None = None) -> DataFrame:
    """All rows and columns of ``docs`` plus ``n_bytes`` (UTF-8), ``n_tokens`` and, if asked for, ``budget_chars``, ``prefix_tokens``.

    ``budget_chars`` is the most characters whose prefix has at most ``budget`` tokens. ``prefix_tokens`` holds the count of every prefix of 0, 1, ... characters of the whole text. ``path`` names a vocabulary
    file that every executor has. Null and empty texts have no bytes and no tokens (and one prefix). Strings of special
    tokens inside a text count as one token. Equal texts have equal results. Columns named like a result are replaced.
    """
    ship(docs.sparkSession)
    if budget is not None and budget < 0:
        raise ValueError("the budget is negative")
    new = ["n_bytes", "n_tokens", *["budget_chars"] * (budget is not None), *["prefix_tokens"] * prefixes]
    if text_col in new:
        raise ValueError("the text column has the name of a result")
    out = docs.select(*[c for c in docs.columns if c not in new])
    schema = widened(out.schema, "n_bytes bigint, n_tokens bigint" + ", budget_chars bigint" * (budget is not None) + ", prefix_tokens array<int>" * prefixes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _loaded(path)
        for whole in batches:
            for b in sliced(whole, text_col, 1_000_000 if prefixes else 16_000_000):
                texts = [t or "" for t in b.column(text_col).to_pylist()]
                size = pa.array([len(t.encode("utf-8", "replace")) for t in texts], pa.int64())
                got = [counter.counts(t).astype(np.int32) for t in texts] if prefixes else None
                n = [int(g[-1]) for g in got] if prefixes else [counter.total(t) for t in texts]
                more = [pa.array(n, pa.int64())]
                if budget is not None:
                    more.append(pa.array([len(t) if k <= budget else counter.chars_within(t, budget) for t, k in zip(texts, n, strict=True)], pa.int64()))
                if prefixes:
                    more.append(pa.array(got, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([*b.columns, size, *more], names=schema.names)

    return out.mapInArrow(run, schema)


def tokens_of_prefix(prefix_tokens: Column, chars: Column) -> Column:
    """The tokens of the first ``chars`` characters: a lookup; null beyond the text."""
    return F.get(prefix_tokens, chars)


def chars_in_budget(prefix_tokens: Column, budget: Column) -> Column:
    """The most characters whose prefix has at most ``budget`` tokens; counts of neighbouring prefixes may fall as well as rise."""
    fits = F.filter(F.transform(prefix_tokens, lambda n, k: F.when(n <= budget, k)), lambda k: k.isNotNull())
    return F.array_max(fits)


def truncate(text: Column, prefix_tokens: Column, budget: Column) -> Column:
    """The longest beginning of the text within the budget; null for a negative budget."""
    return F.substring(F.coalesce(text, F.lit("")), F.lit(1), chars_in_budget(prefix_tokens, budget))
