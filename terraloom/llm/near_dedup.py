"""MinHash near-dedup for weighted shingles.

A text's shingles are runs of five words, weighted by how often they occur. Each shingle is a Poisson process whose rate is
its weight; every arrival goes to a random register, and a register keeps the shingle that arrived first. Two texts agree in
a register with their probability Jaccard. A process ends early, once its next arrival is later than all registers' first
ones. Registers are banded; texts that share a band are candidates and are verified exactly.

Texts with equal shingles are folded into one node first. Then three steps join nodes into classes:

1. in each bucket (nodes that share a band) one node is compared with all others;
2. in buckets that still hold several classes, the most central node is compared with those of other classes; texts of which
   less than the threshold's share of shingles stands in any other candidate are set aside, since they can't reach it;
3. what is left between classes is joined over an inverted index of shingles, the rarest first. Of two texts that reach the
   threshold the first common shingle stands so far ahead in both that little mass lies before it, so each text is listed
   only under its rarest shingles, by length, and only pairs whose bounds reach the threshold are compared.

So a group of copies costs a few comparisons for each member, never all its pairs, and no candidate pair of different classes
is left out that could reach the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ship, sliced, small
from .words import Cache, hashed_words, mix, shingles, word_hash

SHINGLE, THRESHOLD = 5, 0.8
#: Registers are BANDS x ROWS. A pair at 0.8 shares a band with probability 1 - (1 - 0.8^5)^25 = 0.99995.
BANDS, ROWS = 25, 5
#: Candidate ids are broadcast up to so many rows of 8 bytes; beyond, Spark shuffles.
BROADCAST_ROWS = 500_000
#: Bytes of a stored shingle; members of one pivot that are compared in one task; step of the length classes.
GRAM_BYTES, SLICE, LENGTH_STEP = 6, 512, 0.02
EPS = 1e-6
#: Words whose hashes a worker keeps; more cost memory and save no time.
KNOWN_WORDS = 100_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def signatures(shingle: np.ndarray, weight: np.ndarray, owner: np.ndarray, n: int, registers: int = BANDS * ROWS) -> np.ndarray:
    """``n`` rows of registers; ``owner`` is the text of each (shingle, weight). Texts without shingles keep zeros."""
    best, who = np.full(n * registers, np.inf), np.zeros(n * registers, np.uint64)
    state, time = shingle.copy(), np.zeros(len(shingle))
    while len(state):
        with np.errstate(over="ignore"):
            state = state + GOLDEN
        bits = mix(state)
        time = time - np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        slot = owner * registers + (mix(bits ^ GOLDEN) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(best, slot, time)
        won = best[slot] == time
        who[slot[won]] = shingle[won]
        on = time < best.reshape(n, registers).max(1)[owner]
        state, time, shingle, weight, owner = state[on], time[on], shingle[on], weight[on], owner[on]
    return who.reshape(n, registers)


def band_keys(who: np.ndarray) -> np.ndarray:
    """(n, BANDS) keys of the bands, different for each band."""
    parts = who.reshape(len(who), BANDS, ROWS)
    with np.errstate(over="ignore"):
        acc = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * GOLDEN, parts.shape[:2]).copy()
        for k in range(ROWS):
            acc = mix(acc + parts[:, :, k]) * GOLDEN
    return acc.view(np.int64)


def packed(grams: np.ndarray) -> bytes:
    """Shingles cut to their upper 48 bits, ascending, with repeats."""
    cut = np.sort(grams >> np.uint64(64 - 8 * GRAM_BYTES)).astype("<u8")
    return cut.view(np.uint8).reshape(-1, 8)[:, :GRAM_BYTES].tobytes()


def unpacked(data) -> np.ndarray:
    flat = np.frombuffer(data, np.uint8).reshape(-1, GRAM_BYTES)
    out = np.zeros((len(flat), 8), np.uint8)
    out[:, :GRAM_BYTES] = flat
    return out.reshape(-1).view("<u8").astype(np.int64)


class Pivot:
    """A text's shingles (ascending, a shingle of weight w stands w times), ready to be compared with many."""

    def __init__(self, grams: np.ndarray):
        self.n = len(grams)
        self.keys, self.weights = np.unique(grams, return_counts=True)

    def similarity(self, other: np.ndarray) -> float:
        """The probability Jaccard with another text; 0 if either is empty.

        The sum over common i of 1 / sum_j max(a_j / a_i, b_j / b_i): the chance that one exponential race with these rates
        has the same winner in both. With weights of 1 it is the Jaccard coefficient.
        """
        if not self.n or not len(other):
            return 0.0
        plain = len(self.keys) == self.n and bool((other[1:] != other[:-1]).all())
        keys, wb = (other, None) if plain else np.unique(other, return_counts=True)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        held = self.keys[at] == keys
        k = int(held.sum())
        if plain:
            return k / (self.n + len(other) - k)
        if not k:
            return 0.0
        a, b = self.weights[at[held]].astype(np.float64), wb[held].astype(np.float64)
        # Shingles of one text only have ratios of infinity or 0 and stand at the ends of the order.
        ratio = a / b
        order = np.argsort(-ratio, kind="stable")
        ahead = self.n - a.sum() + np.cumsum(a[order])
        behind = np.concatenate((np.cumsum(b[order][::-1])[::-1], [0.0])) + (len(other) - b.sum())
        last = np.searchsorted(-ratio[order], -ratio, side="right")
        return float((1 / (ahead[last - 1] / a + behind[last] / b)).sum())


def probability_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two ascending arrays of shingles."""
    return Pivot(a).similarity(b)


def _flush(texts: list[tuple[int, np.ndarray]], keys: list, bands: list) -> None:
    """Signatures of the (row, shingles) gathered."""
    parts = [np.unique(g, return_counts=True) for _, g in texts]
    owner = np.repeat(np.arange(len(parts)), [len(u) for u, _ in parts])
    who = signatures(np.concatenate([u for u, _ in parts]), np.concatenate([c for _, c in parts]).astype(np.float64), owner, len(parts))
    for (row, g), band in zip(texts, band_keys(who), strict=True):
        keys[row], bands[row] = xxhash.xxh3_128_hexdigest(np.sort(g).tobytes()), band


def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, mark, text) to (id, mark, key, bands): key is a hash of the text's shingles. The shingles themselves aren't kept."""
    cache = Cache(word_hash, KNOWN_WORDS)
    for b in (part for whole in batches for part in sliced(whole, "text")):
        texts = b.column("text").to_pylist()
        keys, bands, open_, size = [None] * len(texts), [None] * len(texts), [], 0
        for k, t in enumerate(texts):
            g = shingles(hashed_words(t or "", cache), SHINGLE)
            if not len(g):
                continue
            open_.append((k, g))
            size += len(g)
            if size >= 100_000:
                _flush(open_, keys, bands)
                open_, size = [], 0
        if open_:
            _flush(open_, keys, bands)
        more = [pa.array(keys, pa.string()), pa.array(bands, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*(b.column(n) for n in ("id", "mark")), *more], names=["id", "mark", "key", "bands"])


def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text) to (node, plain, grams): grams are the packed shingles, plain if none repeats."""
    cache = Cache(word_hash, KNOWN_WORDS)
    for b in (part for whole in batches for part in sliced(whole, "text")):
        found = [shingles(hashed_words(t, cache), SHINGLE) for t in b.column("text").to_pylist()]
        plain = pa.array([len(np.unique(g)) == len(g) for g in found], pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column("node"), plain, pa.array([packed(g) for g in found], pa.binary())], names=["node", "plain", "grams"])


SIGNED = "id bigint, mark bigint, key string, bands array<bigint>"
SHINGLED = "node bigint, plain boolean, grams binary"


def _verified(threshold: float):
    """(a, b, grams), each pivot's own row, with a null b, ahead of its members: the pairs that reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = None
        for batch in batches:
            found = []
            for a, b, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                grams = unpacked(g.as_buffer())
                if b is None:
                    pivot = Pivot(grams)
                elif pivot.similarity(grams) >= threshold - 1e-9:
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, grams) to (node, gram, part): the distinct shingles and their shares of the text's weight."""

    def made(rows: list[tuple]) -> pa.RecordBatch:
        nodes = np.repeat(np.array([r[0] for r in rows], np.int64), [len(r[1]) for r in rows])
        columns = [nodes, np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows])]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "gram", "part"])

    for b in batches:
        rows, size = [], 0
        for node, g in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            grams = unpacked(g.as_buffer())
            gram, n = np.unique(grams, return_counts=True)
            rows.append((node, gram, n / len(grams)))
            size += len(gram)
            if size >= 100_000:
                yield made(rows)
                rows, size = [], 0
        if rows:
            yield made(rows)


def _mixed(members: DataFrame) -> DataFrame:
    """The rows of buckets that hold several classes. Sort-merge joins: Spark splits the partition of a hot bucket."""
    buckets = members.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("band")
    return members.join(buckets.hint("merge"), "band")


def _links(store: Scratch, pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The distinct pairs (a, b) whose texts reach the threshold.

    The members of a pivot are dealt in slices; the pivot's shingles travel once for each slice, a member's once for each pair.
    """
    pairs = store.save(pairs.distinct())
    counts = pairs.groupBy("a").agg(F.count("*").alias("n"))
    placed = store.save(pairs.join(counts.hint("merge"), "a").select("a", "b", F.pmod(F.xxhash64("b"), F.floor(F.col("n") / SLICE) + 1).alias("slice")))
    n = placed.count()
    store.drop(pairs)
    heads = sets.select(F.col("node").alias("a"), "grams").join(small(placed.select("a", "slice").distinct(), n, BROADCAST_ROWS), "a")
    members = sets.select(F.col("node").alias("b"), "grams").join(small(placed, n, BROADCAST_ROWS), "b")
    both = heads.select("a", "slice", F.lit(None).cast("bigint").alias("b"), "grams").union(members.select("a", "slice", "b", "grams"))
    both = both.repartition("a", "slice").sortWithinPartitions("a", "slice", F.col("b").asc_nulls_first())
    out = store.save(both.select("a", "b", "grams").mapInArrow(_verified(threshold), "a bigint, b bigint"))
    store.drop(placed)
    return out


def _class_of_length(n: Column) -> Column:
    """Texts of about the same number of shingles have one class; classes are ordered by it."""
    return F.floor(F.log(n.cast("double")) / LENGTH_STEP).cast("int")


def _best_jaccard(k: Column, n: Column, m: Column) -> Column:
    """The greatest Jaccard of two plain texts of n and at least m shingles of which at most k are common."""
    return k / (n + F.greatest(m, k) - k)


def _listed(rows: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(probing, stored): the postings ``rows`` (gram, node, root, suffix, k, size, plain) by list.

    ``suffix`` is the share of the text's weight that stands at the posting's shingle or behind and could be common, ``k`` the
    number of these shingles. For common masses x and y the probability Jaccard is at most 1 / (1 / x + 1 / y - 1): the sum
    over common i of 1 / (1 / x_i + u_y / y_i) bounds it, u being the weight of one text alone, and its terms are concave and
    homogeneous. So the lesser mass is at least the threshold and the greater at least ``more``. Plain texts (no shingle
    repeats) are stored by length, and the longer of two probes; list -1 holds the others, list -2 plain texts for them.
    """
    k, n, plain = F.col("k"), F.col("size"), F.col("plain")
    none = F.array().cast("array<int>")
    more = 2 / (1 + 1 / threshold)
    own = F.when(_best_jaccard(k, n, n) >= threshold - EPS, F.array(_class_of_length(n))).otherwise(none)
    wide = F.when(F.col("suffix") >= more - EPS, F.array(F.when(plain, F.lit(-2)).otherwise(F.lit(-1)))).otherwise(none)
    stored = rows.withColumn("list", F.explode(F.concat(F.when(plain, own).otherwise(none), wide)))
    # A class holds lengths from exp(c step) on; a shorter text has at least the threshold's share of the longer one's length.
    lengths = F.sequence(F.greatest(_class_of_length(n * threshold) - 1, F.lit(0)), _class_of_length(n))
    able = F.filter(lengths, lambda c: _best_jaccard(k, n, F.exp(c * LENGTH_STEP) * (1 - EPS)) >= threshold - EPS)
    probing = rows.withColumn("list", F.explode(F.when(plain, F.concat(able, F.array(F.lit(-1)))).otherwise(F.array(F.lit(-1), F.lit(-2)))))
    return probing, stored


def _across(store: Scratch, weighted: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of different classes whose bounds reach the threshold. ``weighted`` has (node, root, gram, part, size,
    plain, n), n being the number of texts that hold the shingle."""
    ahead = Window.partitionBy("node").orderBy(F.desc("n"), F.desc("gram")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rarer = F.lead("gram").over(Window.partitionBy("node").orderBy(F.desc("n"), F.desc("gram")))
    rows = weighted.withColumn("suffix", F.sum("part").over(ahead)).withColumn("k", F.count("*").over(ahead)).withColumn("rarer", rarer)
    rows = store.save(rows.where(F.col("suffix") >= threshold - EPS).select("gram", "node", "root", "suffix", "k", "size", "plain", "rarer"))
    grams = rows.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("gram")
    held = store.save(rows.join(grams.hint("merge"), "gram"))
    store.drop(rows)
    probing, stored = _listed(held, threshold)
    counts = probing.select("gram", "list", "root").union(stored.select("gram", "list", "root")).groupBy("gram", "list", "root").agg(F.count("*").alias("c"))
    lists = counts.groupBy("gram", "list").agg(F.max_by("root", F.struct("c", "root")).alias("most"), F.count("*").alias("roots")).where("roots > 1")
    lists = store.save(lists.select("gram", "list", "most"))
    named = lambda rows, s: rows.select("gram", "list", *[F.col(c).alias(f"{s}_{c}") for c in ("node", "root", "suffix", "k", "size", "plain", "rarer", "most")])
    x, y = (named(rows.join(lists.hint("merge"), ["gram", "list"]), s) for rows, s in ((probing, "x"), (stored, "y")))
    k = F.least("x_k", "y_k")
    plain = k / (F.col("x_size") + F.col("y_size") - k)
    other = 1 / (1 / F.col("x_suffix") + 1 / F.col("y_suffix") - 1)
    able = (F.col("x_root") != F.col("y_root")) & (F.when(F.col("x_plain") & F.col("y_plain"), plain).otherwise(other) >= threshold - EPS)
    # Texts that share the next rarer shingle too have met there, where their bounds are no less.
    able = able & F.coalesce(F.col("x_rarer") != F.col("y_rarer"), F.lit(True))
    # A list's largest class is never compared with itself.
    sides = ((x.where("x_root <> x_most"), y), (x.where("x_root = x_most"), y.where("y_root <> y_most")))
    first, second = (one.join(two.hint("merge"), ["gram", "list"]).where(able).select("x_node", "y_node") for one, two in sides)
    pairs = first.union(second)
    out = store.save(pairs.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct())
    store.drop(held, lists)
    return out


def components(store: Scratch, edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b): the root is the least node of the component.

    Every node points to its least neighbour; pointers are followed to their ends, which at least halves the nodes that have
    an edge; edges are drawn anew between the ends until none is left.
    """
    whole, given = None, edges
    while True:
        both = edges.select("a", "b").union(edges.select("b", "a"))
        parent = store.save(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")))
        while True:
            up = parent.select(F.col("a").alias("p"), F.col("p").alias("q"))
            then = store.save(parent.join(up.hint("merge"), "p").select("a", F.col("q").alias("p"), (F.col("q") < F.col("p")).alias("moved")))
            store.drop(parent)
            parent = then
            if parent.where("moved").isEmpty():
                break
        roots = parent.select(F.col("a").alias("node"), F.col("p").alias("root"))
        if whole is None:
            then = store.save(roots)
        else:
            then = store.save(_renamed(whole, roots.select(F.col("node").alias("root"), F.col("root").alias("next"))))
            store.drop(whole)
        whole = then
        ends = edges.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        then = store.save(ends.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        store.drop(parent, *[edges] * (edges is not given))
        edges = then
        if edges.isEmpty():
            store.drop(edges)
            return whole


def _renamed(known: DataFrame, step: DataFrame) -> DataFrame:
    """(node, root) with the roots that ``step`` (root, next) names replaced."""
    return known.join(step.hint("merge"), "root", "left").select("node", F.coalesce("next", "root").alias("root"))


def _merged(store: Scratch, known: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """``known`` (node, root) with the links' components; ``links`` and the old table are dropped."""
    if links.isEmpty():
        out = known
    elif known is None:
        out = components(store, links)
    else:
        a, b = (known.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
        ends = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b")
        ends = store.save(ends.distinct())
        step = components(store, ends) if not ends.isEmpty() else store.save(known.limit(0))
        new = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct().join(known, "node", "left_anti").select("node", F.col("node").alias("root"))
        out = store.save(_renamed(known.union(new), step.select(F.col("node").alias("root"), F.col("root").alias("next"))))
        store.drop(known, ends, step)
    store.drop(links)
    return out


def _placed(store: Scratch, members: DataFrame, held: DataFrame | None) -> DataFrame:
    """``members`` of the buckets that hold several classes, with their roots; the old table is dropped."""
    if members.isEmpty():
        return members
    bare = members.drop("root", "pivot")
    with_root = bare.withColumn("root", F.col("node")) if held is None else bare.join(held, "node", "left").withColumn("root", F.coalesce("root", "node"))
    out = store.save(_mixed(with_root))
    store.drop(members)
    return out


def _sets(store: Scratch, given: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, plain, grams) for ``wanted`` (node, id, mark): the shingles of candidates alone, made anew from their texts."""
    n = wanted.count()
    texts = given.join(small(wanted, n, BROADCAST_ROWS), ["id", "mark"]).select("node", "text")
    sets = store.save(texts.mapInArrow(shingled, SHINGLED))
    found = sets.count()
    if found < n:
        raise ValueError("the texts changed between two readings")
    if found == n:
        return sets
    # Rows that repeat id and text.
    once = store.save(sets.dropDuplicates(["node"]))
    store.drop(sets)
    return once


def _roots(store: Scratch, judged: DataFrame, nodes: DataFrame, given: DataFrame, threshold: float) -> DataFrame | None:
    """(node, root) of the nodes that are linked to others; None if none is."""
    bands = judged.select(F.xxhash64("key").alias("node"), F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot < last")
    shared = store.save(shared.select("band", "pivot"))
    n = shared.count()
    # Beyond the broadcast a sort-merge join, for which Spark splits the partition of a hot band.
    members = store.save(bands.join(F.broadcast(shared) if n <= BROADCAST_ROWS else shared.hint("merge"), "band").distinct())
    store.drop(shared)
    if not n:
        store.drop(members)
        return None
    wanted = store.save(members.select("node").distinct().join(nodes.select("node", "least.id", "least.mark"), "node"))
    sets = _sets(store, given, wanted)
    store.drop(wanted)
    pairs = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    held = _merged(store, None, _links(store, pairs, sets, threshold))

    members = _placed(store, members, held)
    if not members.isEmpty():
        held = _joined_across(store, members, sets, held, threshold)
    store.drop(sets, members)
    return held


def _joined_across(store: Scratch, members: DataFrame, sets: DataFrame, held: DataFrame | None, threshold: float) -> DataFrame | None:
    """``held`` with the links between the classes of ``members`` (band, node, root)."""
    ex = sets.select("node", "grams").join(members.select("node").distinct(), "node").mapInArrow(_exploded, "node bigint, gram bigint, part double")
    seen = store.save(ex.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"))
    weighted = store.save(ex.join(seen.hint("merge"), "gram"))
    about = weighted.groupBy("node").agg(F.sum("part").alias("share"), F.sum(F.col("part") * F.col("n")).alias("central"))
    able = store.save(about.where(F.col("share") >= threshold - EPS).select("node", "central"))
    then = store.save(_mixed(members.join(able, "node")))
    store.drop(able)
    centres = then.groupBy("band").agg(F.max_by(F.struct("node", "root"), F.struct("central", "node")).alias("c"))
    pairs = then.join(centres.hint("merge"), "band").where("root <> c.root").select(F.col("c.node").alias("a"), F.col("node").alias("b"))
    held = _merged(store, held, _links(store, pairs, sets, threshold))

    left = _placed(store, then, held)
    open_ = store.save(left.select("node", "root").distinct().join(sets.select("node", "plain", (F.length("grams") / GRAM_BYTES).cast("long").alias("size")), "node"))
    n = open_.count()
    if n:
        weighted_open = weighted.join(small(open_, n, BROADCAST_ROWS), "node")
        across = _across(store, weighted_open, threshold)
        held = _merged(store, held, _links(store, across, sets, threshold))
        store.drop(across)
    store.drop(left, open_, seen, weighted)
    return held


def _judged(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> tuple[Scratch, DataFrame, DataFrame]:
    """(store, rows, keys): rows (id, mark, key) for each row of ``docs``, the mark being a hash of the text and the key one of
    its shingles; keys (key, class_id, stays) with the least id of the class and its struct (id, mark) that stays."""
    spark = docs.sparkSession
    ship(spark)
    store = Scratch(spark)
    text = F.col(text_col).cast("string")
    given = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    signed_rows = store.save(given.mapInArrow(signed, SIGNED))
    judged = signed_rows.where("id IS NOT NULL AND key IS NOT NULL")
    # A node is a text, not an id: several texts may have one id.
    nodes = store.save(judged.groupBy("key").agg(F.min(F.struct("id", "mark")).alias("least")).withColumn("node", F.xxhash64("key")))
    held = _roots(store, judged, nodes, given, threshold)
    if held is None:
        keys = nodes.select("key", "least")
    else:
        rooted = store.save(nodes.join(held, "node").select("key", "root", "least"))
        best = rooted.groupBy("root").agg(F.min("least").alias("best"))
        linked = store.save(rooted.join(best.hint("merge"), "root").select("key", "best"))
        keys = nodes.select("key", "least").join(linked, "key", "left").select("key", F.coalesce("best", "least").alias("least"))
    keys = store.save(keys.select("key", F.col("least.id").alias("class_id"), F.struct("least.id", "least.mark").alias("stays")))
    rows = store.save(signed_rows.select("id", "mark", "key"))
    store.drop(signed_rows, nodes, *[held, rooted, linked] if held is not None else [])
    return store, rows, keys


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, class_id): one row for each row of ``docs``; the class is the least id among texts linked directly or through others.

    Words are runs of non-white-space, lower-cased, letters and digits only. Fewer than five words make one shingle. Null
    texts and texts without words are alike to nothing and a class of their own; so are rows with a null id, whose class is
    null. Rows that repeat an id are judged by their own text; rows that repeat id and text are alike. An empty table gives an
    empty result. Texts of any length are compared whole. The id must be an integer. Other columns aren't read. ``docs`` is read
    twice: the shingles of texts that share a band are made anew, those of others are never written.
    """
    _, rows, keys = _judged(docs, id_col, text_col, threshold)
    known = rows.where("id IS NOT NULL AND key IS NOT NULL").join(keys.select("key", "class_id").hint("merge"), "key").select("id", "class_id")
    alone = rows.where("id IS NULL OR key IS NULL").select("id", F.col("id").alias("class_id"))
    return known.union(alone).select(F.col("id").alias(id_col), "class_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs``, with all its columns, less all rows but one of each class: the one with the least id.

    Of rows that repeat this id in the class one stays too, of equal rows any. Rows with a null id and texts without words stay
    all. An empty table gives an empty result. The ids that go are broadcast if they are few, else the texts are shuffled.
    """
    store, rows, keys = _judged(docs, id_col, text_col, threshold)
    judged = rows.where("id IS NOT NULL AND key IS NOT NULL")
    own = F.struct("id", "mark")
    gone = store.save(judged.join(keys.select("key", "stays").hint("merge"), "key").where(own != F.col("stays")).select(F.col("id").alias("__id"), F.col("mark").alias("__mark")).distinct())
    twice = store.save(judged.groupBy("id", "mark").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("__id"), F.col("mark").alias("__mark")))
    store.drop(rows, keys)
    key, mark = F.col(id_col).cast("bigint"), F.xxhash64(F.col(text_col).cast("string"))
    same = (key == F.col("__id")) & (mark == F.col("__mark"))
    left = docs.join(small(gone, gone.count(), BROADCAST_ROWS), same, "left_anti")
    if twice.isEmpty():
        return left
    few = small(twice, twice.count(), BROADCAST_ROWS)
    return left.join(few, same, "left_anti").union(left.join(few, same, "left_semi").dropDuplicates([id_col, text_col]))
