"""Toxicity: a factorization machine over hashed terms.

A text's terms are its words and their beginnings, hashed into a fixed number of slots. The model scores
``b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``, so that a pair such as an insult and the mention of a group can count for
more than both alone. It learns from a bounded, stratified sample of the labelled rows on the driver and scores all rows in
Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ship, widened
from .words import EDGES, mix

#: Bits of the slots, lengths of the beginnings, factors of a pair's weight.
BITS, PREFIXES, FACTORS = 17, (3, 4, 5, 6, 7), 6
#: Words of at least so many letters are hashed whole by themselves, not letter by letter.
WHOLE = 11
#: Documented bounds of the sample: at most this many labelled rows of each class are learnt from, and this many bytes of features.
SAMPLE_PER_CLASS, SAMPLE_BYTES = 3000, 256 << 20
EPOCHS, RATE, DECAY, SEED = 3, 0.12, 2e-5, 20240
#: Toxic rows that a slot needs, and the share of toxic rows that the cut assumes.
MIN_ROWS, USUAL_SHARE = 3, 0.1


def _slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, slot) of each term, beginnings and the whole word: hashes grow letter by letter, for all words at once."""
    long = [k for k, w in enumerate(words) if len(w) >= WHOLE]
    letters = np.array(words, f"U{WHOLE}").view(np.uint32).reshape(len(words), WHOLE).astype(np.uint64)
    size = (letters != 0).sum(1)
    rows, slots, h = [], [], np.zeros(len(words), np.uint64)
    for k in range(1, WHOLE + 1):
        h = mix(h + letters[:, k - 1] + np.uint64(k))
        if k in PREFIXES:
            rows.append(np.flatnonzero(size >= k))
            slots.append(h[rows[-1]] >> np.uint64(64 - BITS))
        if k < WHOLE:
            rows.append(np.flatnonzero(size == k))
            slots.append(mix(h[rows[-1]]) >> np.uint64(64 - BITS))
    rows.append(np.array(long, np.int64))
    slots.append(np.array([xxhash.xxh3_64_intdigest(words[k].encode("utf-8", "replace")) for k in long], np.uint64) >> np.uint64(64 - BITS))
    return np.concatenate(rows), np.concatenate(slots).astype(np.int64)


def features(texts: list[str | None], used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, slot, value), ascending: log counts of the slots (those in ``used``) over the root of the number of words.

    A text's words are its runs of non-white-space, lower-cased, without punctuation at their ends.
    """
    found, owner = [], []
    for k, t in enumerate(texts):
        got = [w for c in (t or "").lower().replace("\x00", " ").split() if (w := c.strip(EDGES))]
        found += got
        owner.append(len(got))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    words = np.array(owner)
    rows, slots = _slots(found)
    doc = np.repeat(np.arange(len(texts)), words)[rows]
    if used is not None:
        doc, slots = doc[used[slots]], slots[used[slots]]
    keys, counts = np.unique((doc << BITS) | slots, return_counts=True)
    doc = keys >> BITS
    return doc, keys & ((1 << BITS) - 1), np.log1p(counts) / np.sqrt(words[doc])


def blocks(texts: list[str | None], most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of the texts of about ``most`` characters, one text at least, so that memory stays bounded by the longest text."""
    start, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t or "") > most:
            yield start, k
            start, size = k, 0
        size += len(t or "")
    if start < len(texts):
        yield start, len(texts)


@dataclass
class Machine:
    """``used`` marks the slots with a weight; the others never count."""

    bias: float
    used: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, slots: np.ndarray, values: np.ndarray) -> float:
        v = self.factors[slots] * values[:, None]
        s = v.sum(0)
        return float(self.bias + self.weights[slots] @ values + 0.5 * (s @ s - (v * v).sum()))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for a, b in blocks(texts):
            doc, slots, values = features(texts[a:b], self.used)
            if len(doc):
                v = self.factors[slots] * values[:, None]
                first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
                pairs = 0.5 * ((np.add.reduceat(v, first) ** 2).sum(1) - np.add.reduceat((v * v).sum(1), first))
                out[a + doc[first]] += np.add.reduceat(self.weights[slots] * values, first) + pairs
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def best_cut(raws: list[float], labels: list[int]) -> float:
    """The cut with the best F1, in the middle of the gap to the next raw score; classes count by their usual shares."""
    order = np.argsort(raws)[::-1]
    x, y = np.array(raws)[order], np.array(labels)[order]
    weight = np.where(y == 1, USUAL_SHARE / max(1, (y == 1).sum()), (1 - USUAL_SHARE) / max(1, (y == 0).sum()))
    hit, taken = np.cumsum(weight * (y == 1)), np.cumsum(weight)
    f1 = 2 * hit / (taken + USUAL_SHARE)
    k = int(np.argmax(f1))
    return float((x[k] + x[k + 1]) / 2 if k + 1 < len(x) else x[k] - 1)


Row = tuple[np.ndarray, np.ndarray, int]


def train(rows: list[Row], epochs: int = EPOCHS, rate: float = RATE, decay: float = DECAY, seed: int = SEED) -> Machine:
    """Logistic loss, one row a step with a step size of its own for each parameter; the same rows in the same order give the same model.

    Slots need MIN_ROWS toxic rows to be used. Every fifth row only places the bias, where F1 is best on those rows.
    """
    size, n = 1 << BITS, [sum(1 for r in rows if r[2] == y) for y in (0, 1)]
    seen = np.zeros(size, np.int32)
    for slots, _, y in rows:
        seen[slots] += y
    rng = np.random.default_rng(seed)
    m = Machine(0.0, seen >= MIN_ROWS, np.zeros(size, np.float32), (rng.standard_normal((size, FACTORS)) * 0.02).astype(np.float32))
    m.factors[~m.used] = 0
    if not all(n):
        m.bias = 4.0 if n[1] > n[0] else -4.0
        return m
    rows = [(s[m.used[s]], v[m.used[s]], y) for s, v, y in rows]
    held = [k for y in (0, 1) for k in [k for k, r in enumerate(rows) if r[2] == y][4::5]]
    fitted = np.setdiff1d(np.arange(len(rows)), held)
    even = [len(rows) / (2 * k) for k in n]
    gb, gw, gv = 1e-2, np.full(size, 1e-2, np.float32), np.full((size, FACTORS), 1e-2, np.float32)
    for _ in range(epochs):
        for k in rng.permutation(fitted):
            slots, values, y = rows[k]
            v = m.factors[slots]
            s = values @ v
            raw = m.bias + m.weights[slots] @ values + 0.5 * (s @ s - ((v * values[:, None]) ** 2).sum())
            g = np.float32((1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y) * even[y])
            gb += float(g * g)
            m.bias -= rate * float(g) / gb**0.5
            dw = g * values + decay * m.weights[slots]
            gw[slots] += dw * dw
            m.weights[slots] -= rate * dw / np.sqrt(gw[slots])
            dv = g * (values[:, None] * s - v * (values * values)[:, None]) + decay * v
            gv[slots] += dv * dv
            m.factors[slots] = v - rate * dv / np.sqrt(gv[slots])
    if held:
        m.bias -= best_cut([m.raw(*rows[k][:2]) for k in held], [rows[k][2] for k in held])
    return m


def held_out(key: Column) -> Column:
    """True for the fifth of the rows that is never learnt from; false for a null key, which is never learnt from either."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", text_col: str = "text", per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(id, label, text) of at most ``per_class`` ids of each label, the least by a hash of the id; held-out ids never.

    An id whose rows in ``labels`` disagree counts as toxic; null ids and labels are left out. Of several rows of an id the
    least text is taken. The ids are broadcast: at most twice ``per_class`` rows.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("__id")).agg((F.max(label_col) > 0).cast("int").alias("__label"))
    first = [known.where(F.col("__label") == y).orderBy(F.xxhash64("__id"), "__id").limit(per_class) for y in (0, 1)]
    chosen = first[0].unionByName(first[1])
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(chosen), "__id")
    return rows.groupBy("__id", "__label").agg(F.min("__text").alias("__text"))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("__text").to_pylist()
        slots, vals = [], []
        for lo, hi in blocks(texts):
            doc, s, v = features(texts[lo:hi])
            ends = np.searchsorted(doc, np.arange(hi - lo + 1))
            slots += [s[x:y].astype(np.int32).tobytes() for x, y in zip(ends, ends[1:], strict=False)]
            vals += [v[x:y].astype(np.float32).tobytes() for x, y in zip(ends, ends[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([b.column("__id"), b.column("__label"), pa.array(slots, pa.binary()), pa.array(vals, pa.binary())], names=["id", "label", "slots", "vals"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", text_col: str = "text", per_class: int = SAMPLE_PER_CLASS) -> Machine:
    """Learn a machine. Without both labels it scores all rows alike.

    Only features of the sample come to the driver, SAMPLE_BYTES of them at most: rows are taken in order of the hash of their
    id until these are full.
    """
    ship(docs.sparkSession)
    store = Scratch(docs.sparkSession)
    sample = labelled_sample(docs, labels, id_col, label_col, text_col, per_class)
    made = store.save(sample.mapInArrow(_featured, f"id {sample.schema['__id'].dataType.simpleString()}, label int, slots binary, vals binary"))
    upto = Window.orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0)
    sizes = made.select("id", (F.length("slots") + F.length("vals")).cast("long").alias("n"))  # at most twice per_class rows
    taken = sizes.withColumn("n", F.sum("n").over(upto)).where(F.col("n") <= SAMPLE_BYTES).select("id")
    got = made.join(F.broadcast(taken), "id").collect()
    store.drop(made)
    got.sort(key=lambda r: (str(r.id), bytes(r.slots), bytes(r.vals)))
    return train([(np.frombuffer(r.slots, np.int32), np.frombuffer(r.vals, np.float32), r.label) for r in got])


def score(docs: DataFrame, machine: Machine, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    The whole text is scored. Null, empty and wordless texts have no terms and score by the bias alone; equal texts score
    alike. Columns of ``docs`` named like a result are replaced unless they are the text. The model's size is fixed by
    BITS and FACTORS.
    """
    ship(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(machine)
    keep = [c for c in docs.columns if c == text_col or c not in ("score", "predicted")]
    if text_col in ("score", "predicted"):
        raise ValueError("the text column has the name of a result")
    out = docs.select(*keep)
    schema = widened(out.schema, "score double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = model.value.scores(b.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.float64())], names=[*b.schema.names, "score"])

    return out.mapInArrow(scored, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
