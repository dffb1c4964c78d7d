"""Benchmark decontamination: passages of every text as queries against a BM25 inverted index of test items.

The index is built once for each block of items and sent to the workers. Block-max WAND retrieves all items whose score
reaches their threshold; passages for which no block's bounds reach it are left out before. The threshold is proven: an item
whose shingles a passage holds to the required share can't score below it. Retrieved items are verified by shingles and by
the words of their question and of their answer.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Scratch, ship, sliced, small
from .words import Cache, fold, hashed_words, shingles, word_hash

SHINGLE, THRESHOLD = 5, 0.8
#: A copy with so many of the shingles needs no more; a question or answer of at least LONG words needs the lower share.
SURE, LONG, LOWER = 0.9, 5, 0.5
K1, B = 1.2, 0.75
#: Blocks of items in an index at most; items and their characters in a block on the driver, which bounds what is broadcast;
#: words that passages advance at least; rows that go are broadcast up to so many.
BLOCKS, ITEMS, ITEM_CHARS, STEP, BROADCAST_ROWS = 256, 16_384, 16_000_000, 64, 500_000
END, CURRENT = 1 << 60, itemgetter(0)


def split_item(text: str) -> tuple[list[str], list[str]]:
    """(question, answer) words: sentences belong to the question until it has half of the words; the answer may be empty."""
    parts = [[w for c in s.split() if (w := fold(c))] for s in re.split(r"(?<=[.?!])\s+|\n", text)]
    total, question, k = sum(map(len, parts)), [], 0
    while k < len(parts) and 2 * len(question) < total:
        question, k = question + parts[k], k + 1
    return question, [w for p in parts[k:] for w in p]


@dataclass
class Index:
    """Items of one length class. Postings by term, with impacts scaled so that 1 is an item's threshold; blocks of items and the
    greatest impact of each term in each; ``step`` is half a passage in words."""

    ids: list
    lists: list[tuple[list[int], list[float]]]
    top: list[float]
    bound: np.ndarray
    block: int
    grams: list[np.ndarray]
    parts: list[tuple[Counter, Counter]]
    full: np.ndarray
    step: int


def least_share(impacts: np.ndarray, words: int, threshold: float) -> float:
    """A lower bound of the impacts' sum over a passage that holds ``threshold`` of the item's shingles.

    Words of which none is in a shingle held are lost; m lost words in a row spoil at least m shingles (fewer at the ends only
    by the shingle's overhang), so at most the spoilt shingles and that overhang are lost. The greatest impacts are taken off.
    """
    n = max(1, words - SHINGLE + 1)
    lost = min(words, math.floor(n * (1 - threshold) + 1e-9) and math.floor(n * (1 - threshold) + 1e-9) + SHINGLE - 1)
    return float(max(0.0, np.sort(impacts)[: max(0, len(impacts) - lost)].sum()))


def step_of(words: int) -> int:
    """Half the passage for an item of so many words: STEP, doubled until it holds the item."""
    return STEP << max(0, math.ceil(math.log2(max(1, words) / STEP)))


def build_indexes(items: list[tuple], df: dict[int, int], n_items: int, mean_words: float, threshold: float = THRESHOLD) -> tuple[dict[int, int], list[Index]]:
    """(term numbers, an index for each length class) of ``items`` (id, text); ``df`` and the means are those of all items."""
    cache, terms, classes = Cache(word_hash), {}, {}
    for key, text in items:
        words = hashed_words(text or "", cache)
        if len(words):
            classes.setdefault(step_of(len(words)), []).append((key, text, words))
            for t in words.tolist():
                terms.setdefault(t, len(terms))
    return terms, [_index(step, rows, terms, df, n_items, mean_words, threshold) for step, rows in sorted(classes.items())]


def _index(step: int, rows: list[tuple], terms: dict[int, int], df: dict[int, int], n_items: int, mean_words: float, threshold: float) -> Index:
    ids, grams, parts, full = [], [], [], []
    lists, size = [([], []) for _ in terms], max(1, -(-len(rows) // BLOCKS))
    for k, (key, text, words) in enumerate(rows):
        tf = Counter(words.tolist())
        norm = K1 * (1 - B + B * len(words) / max(1.0, mean_words))
        scores = {t: math.log(1 + (n_items - df[t] + 0.5) / (df[t] + 0.5)) * n * (K1 + 1) / (n + norm) for t, n in tf.items()}
        least = least_share(np.array(list(scores.values())), len(words), threshold)
        # Where the bound is 0, any term of the item retrieves it.
        least = least if least > 0 else min(scores.values())
        for t, x in scores.items():
            at, impacts = lists[terms[t]]
            at.append(k)
            impacts.append(x / least)
        ids.append(key)
        grams.append(np.unique(shingles(words, SHINGLE)))
        full.append(sum(scores.values()) / least)
        q, a = split_item(text)
        parts.append((Counter(word_hash(w) for w in q), Counter(word_hash(w) for w in a)))
    bound = np.zeros((len(terms), -(-len(rows) // size)), np.float32)
    for t, (at, impacts) in enumerate(lists):
        np.maximum.at(bound[t], np.array(at, np.int64) // size, np.array(impacts, np.float32) * np.float32(1 + 1e-6))
    return Index(ids, lists, [max(x, default=0.0) for _, x in lists], bound, size, grams, parts, np.array(full), step)


def wand(ix: Index, terms: list[int], first: int = 0) -> Iterator[tuple[int, float]]:
    """(item, score over threshold) of all items that reach the threshold for the distinct ``terms`` of a passage, in order.

    Block-max WAND: a cursor for each term's list, in order of their items. The pivot is the first item at which the lists'
    greatest impacts reach the threshold. Where the block bounds of the lists up to it don't, the cursors leave the block;
    else they move to the pivot and it is scored. No item before ``first`` reaches the threshold.
    """
    cursors = []
    for t in terms:
        at, impacts = ix.lists[t]
        if at and (k := bisect_left(at, first)) < len(at):
            cursors.append([at[k], k, at, impacts, ix.top[t], t])

    def move(moved: list, to: int) -> None:
        for c in moved:
            if c[0] < to:
                c[1] = bisect_left(c[2], to, c[1] + 1)
                c[0] = c[2][c[1]] if c[1] < len(c[2]) else END

    while cursors:
        cursors.sort(key=CURRENT)
        total = 0.0
        for n, c in enumerate(cursors):
            total += c[4]
            if total >= 1 - 1e-9:
                break
        else:
            return
        pivot = c[0]
        if pivot == END:
            return
        while n + 1 < len(cursors) and cursors[n + 1][0] == pivot:
            n += 1
        ahead, block = cursors[: n + 1], pivot // ix.block
        if sum(float(ix.bound[c[5], block]) for c in ahead) < 1 - 1e-6:
            following = cursors[n + 1][0] if n + 1 < len(cursors) else END
            move(ahead, min((block + 1) * ix.block, following))
        elif cursors[0][0] == pivot:
            score = sum(c[3][c[1]] for c in ahead)
            if score >= 1 - 1e-9:
                yield pivot, score
            move(ahead, pivot + 1)
        else:
            move(ahead, pivot)
        while cursors and cursors[-1][0] == END:
            cursors.pop()
        cursors = [c for c in cursors if c[0] != END]


def least_part(words: int, threshold: float) -> float:
    """The share of a question or answer of so many words that a copy must hold: a cut at an item's end falls on one part alone."""
    return min(LOWER, threshold) if words >= LONG else threshold


def leaks_of(ix: Index, words: np.ndarray, numbers: np.ndarray, threshold: float) -> dict[int, tuple[float, float, float, float]]:
    """item -> (bm25 share, shingle share, question share, answer share), the best passage of a text for each item.

    ``words`` are the text's hashed words, ``numbers`` the term numbers, -1 for words of no item.
    """
    out: dict[int, tuple[float, float, float, float]] = {}
    step = ix.step
    known = np.flatnonzero(numbers >= 0)
    if not len(known):
        return out
    # Bounds by half passage first: a passage whose two halves can't bring any block to the threshold is no query.
    n_terms = len(ix.bound)
    keys = np.unique(known // step * n_terms + numbers[known])
    part, terms = np.divmod(keys, n_terms)
    halves, first = np.unique(part, return_index=True)
    sums = np.zeros((int(halves[-1]) + 2, ix.bound.shape[1]), np.float32)
    sums[halves] = np.add.reduceat(ix.bound[terms], first)
    open_ = sums[:-1] + sums[1:] >= 1 - 1e-4
    hot = np.flatnonzero(open_.any(1))
    ends = np.searchsorted(part, np.arange(int(halves[-1]) + 3))
    for h in hot.tolist():
        query = np.unique(terms[ends[h] : ends[h + 2]])
        # The halves may share terms; the whole passage's bounds say which blocks are left.
        left = np.flatnonzero(ix.bound[query].sum(0) >= 1 - 1e-4)
        if not len(left):
            continue
        for k, s in wand(ix, query[ix.bound[query][:, left].any(1)].tolist(), int(left[0]) * ix.block):
            passage = words[h * step : (h + 2) * step]
            held = ix.grams[k]
            share = np.isin(held, shingles_of(passage, ix.parts[k])).mean()
            if share < threshold - 1e-9:
                continue
            bag = Counter(passage.tolist())
            q, a = (sum((c & bag).values()) / c.total() if c else 1.0 for c in ix.parts[k])
            if share >= SURE - 1e-9 or all(x >= least_part(c.total(), threshold) - 1e-9 for x, c in zip((q, a), ix.parts[k], strict=True)):
                out[k] = max(out.get(k, (0.0,) * 4), (s / ix.full[k], float(share), q, a))
    return out


def shingles_of(passage: np.ndarray, parts: tuple[Counter, Counter]) -> np.ndarray:
    """The passage's shingles, as long as those of an item with these words."""
    n = min(SHINGLE, sum(c.total() for c in parts))
    return shingles(passage, n) if len(passage) >= n else passage[:0]


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (term, n): the distinct hashed words of each item and, under a null term, its number of words."""
    cache = Cache(word_hash)
    for b in batches:
        found = [hashed_words(t, cache) for t in b.column(0).to_pylist()]
        own = [np.unique(w).view(np.int64) for w in found]
        term = pa.concat_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *own])), pa.nulls(len(found), pa.int64())])
        n = [1] * sum(map(len, own)) + [len(w) for w in found]
        yield pa.RecordBatch.from_arrays([term, pa.array(n, pa.int64())], names=["term", "n"])


def _passes(items: DataFrame, item_col: str, text_col: str, threshold: float) -> Iterator[tuple[dict[int, int], list[Index]]]:
    """The indexes of each block of items; a block, bounded in rows and characters, is all that is on the driver at a time.

    A single block gives its own statistics; else those of all items are counted by Spark and each block fetches its terms'.
    """
    spark = items.sparkSession
    rows = items.where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(item_col).alias("k"), F.col(text_col).alias("t")).distinct()
    blocks = _blocks(rows)
    first, second = next(blocks, []), next(blocks, [])
    cache = Cache(word_hash)
    if not second:
        found = [hashed_words(t, cache) for _, t in first]
        df = Counter(t for w in found for t in set(w.tolist()))
        if first:
            yield build_indexes(first, df, len(first), sum(map(len, found)) / len(first), threshold)
        return
    store = Scratch(spark)
    counts = store.save(rows.select("t").mapInArrow(_terms, "term bigint, n bigint").groupBy("term").agg(F.count("*").alias("df"), F.sum("n").alias("words")))
    total = counts.where("term IS NULL").first()
    for block in chain((first, second), blocks):
        own = np.unique(np.concatenate([hashed_words(t, cache) for _, t in block])).view(np.int64)
        asked = F.broadcast(spark.createDataFrame(pa.table({"term": own})))
        df = {r.term % (1 << 64): r.df for r in counts.join(asked, "term").select("term", "df").collect()}
        yield build_indexes(block, df, total.df, total.words / total.df, threshold)
    store.drop(counts)


def _blocks(rows: DataFrame) -> Iterator[list[tuple]]:
    block, size = [], 0
    for r in rows.orderBy("k", "t").toLocalIterator():
        block.append((r.k, r.t))
        size += len(r.t)
        if len(block) == ITEMS or size >= ITEM_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _found(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, threshold: float) -> DataFrame:
    """(id, mark, item, bm25, shingles, question, answer): ``find_leaks`` with a hash of the row's text."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("mark"), F.col(text_col).alias("text"))
    kinds = [rows.schema["id"].dataType.simpleString(), items.schema[item_col].dataType.simpleString()]
    schema = f"id {kinds[0]}, mark bigint, item {kinds[1]}, bm25 double, shingles double, question double, answer double"
    batch_schema, out = to_arrow_schema(spark.createDataFrame([], schema).schema), None
    for block in _passes(items, item_col, item_text, threshold):
        sent = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            terms, indexes = sent.value
            hashes, numbers = Cache(word_hash), Cache(lambda c: terms.get(h, -1) if (h := word_hash(c)) else -2)
            for b in (part for whole in batches for part in sliced(whole, "text")):
                got = []
                for key, mark, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                    chunks = (text or "").split()
                    num = np.fromiter(map(numbers.__getitem__, chunks), np.int64, len(chunks))
                    if not (num >= 0).any():
                        continue
                    words, num = LazyWords(chunks, hashes), num[num != -2]
                    got += [(key, mark, ix.ids[k], *v) for ix in indexes for k, v in leaks_of(ix, words, num, threshold).items()]
                yield pa.RecordBatch.from_pylist([dict(zip(batch_schema.names, g, strict=True)) for g in got], schema=batch_schema)

        found = rows.mapInArrow(search, schema)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, item id, bm25, shingles, question, answer): the items that a text gives away, with the best passage's shares.

    A passage is a window of twice 64 words, doubled until half of it holds the item, and advances by half, so that a copy lies
    in one whole; it depends on the item alone. It gives an item away if it holds at least ``threshold`` of the item's five-word
    shingles and either SURE of them or enough words of its question and of its answer: LOWER of a part of at least LONG words,
    ``threshold`` of a shorter one. ``bm25`` is its share of the item's full score. Texts of any length are queried whole. Null
    and wordless texts and items match nothing; an empty table gives an empty result; rows that repeat an id are judged by their
    own text; repeated item rows count once; other columns aren't read. No shuffle of texts: one pass over ``docs`` for every
    ITEMS items (or ITEM_CHARS characters of them).
    """
    out = _found(docs, items, id_col, text_col, item_col, item_text, threshold)
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col if item_col != id_col else "item_id"), "bm25", "shingles", "question", "answer")


class LazyWords:
    """The hashed words of a text, made when a passage is first cut from it."""

    def __init__(self, chunks: list[str], cache: Cache):
        self.chunks, self.cache, self.words = chunks, cache, None

    def __getitem__(self, cut: slice) -> np.ndarray:
        if self.words is None:
            found = np.fromiter(map(self.cache.__getitem__, self.chunks), np.uint64, len(self.chunks))
            self.words = found[found != 0]
        return self.words[cut]


def drop_leaky(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that give no item away, with all their columns.

    Each row is judged by its own text, also where ids are null or repeated. The rows that go are broadcast if they are few.
    """
    store = Scratch(docs.sparkSession)
    gone = _found(docs, items, id_col, text_col, item_col, item_text, threshold).select(F.col("id").alias("__gone"), F.col("mark").alias("__mark")).distinct()
    gone = store.save(gone)
    same = F.col(id_col).eqNullSafe(F.col("__gone")) & (F.xxhash64(F.col(text_col)) == F.col("__mark"))
    return docs.join(small(gone, gone.count(), BROADCAST_ROWS), same, "left_anti")
