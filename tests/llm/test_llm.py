"""The training-data operators: brute force, round trips and edge cases on small tables."""

import hashlib
import math
import os
import random
import tracemalloc
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oracle import differ
from terraloom.llm import bpe, decontaminate, license_scan, line_dedup, near_dedup, quality_rules, queries, sharding, token_counts, toxicity, url_filter
from terraloom.llm.common import Scratch
from terraloom.llm.words import Cache, fold, word_hash

SF = "/root/testdata/sf0.001"
WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"
LONG = " ".join(f"w{k % 977} x{k % 1013}" for k in range(60_000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (4, LONG), (None, "some text of no document"), (5, "ß" * 30_000)]
WS = " \t\n\x0b\x0c\r"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    assert not differ(spark, queries.QUERIES[name], queries.ORACLES[name], SF)


OPERATORS = {
    "quality": lambda d: quality_rules.quality_rules(d),
    "lines": lambda d: line_dedup.dedup_lines(d),
    "licences": lambda d: license_scan.scan_licenses(d),
    "near": lambda d: near_dedup.classes(d),
    "drop_near": lambda d: near_dedup.drop_near_duplicates(d),
    "bpe": lambda d: bpe.encode(d, WORDS, decoded=True),
    "tokens": lambda d: token_counts.count_tokens(d, BYTES, budget=5),
    "prefixes": lambda d: token_counts.count_tokens(d, BYTES, prefixes=True),
    "leaks": lambda d: decontaminate.find_leaks(d, d.select(F.col("doc_id").alias("item_id"), "text").where("length(text) < 100")),
    "shards": lambda d: sharding.assign_shards(d),
    "toxic": lambda d: toxicity.score(d, toxicity.train([])),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_and_clashing_columns(spark, name):
    run = OPERATORS[name]
    clash = ["n_words", "kept", "n_lines", "ids", "decoded", "n_tokens", "n_bytes", "score", "slot", "shard", "class_id", "license", "node", "key", "id", "grams", "band", "item"]
    rows = frame(spark, ODD)
    wide = rows.select("*", *[F.lit("old").alias(c) for c in clash])
    assert run(frame(spark, [])).count() == 0
    got = run(wide).collect()
    if name in ("licences", "leaks"):
        assert len(got) == len(run(rows).collect())
    elif name == "drop_near":
        assert sorted(r.doc_id or 0 for r in got) == [0, 1, 2, 3, 4, 5]
    else:
        assert len(got) == len(ODD)
        new = [c for c in run(rows).columns if c != "text"]
        key = lambda r: [repr(r[c]) for c in new]
        assert sorted(map(key, got)) == sorted(map(key, run(rows).collect()))


def brute_quality(text):
    w = [x for x in "".join(" " if c in WS else c for c in text or "").split(" ") if x]
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k + j for k, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if grams[g] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(WS)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_brute_force(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a", "b ", "c\n", "é", " ", "#", "\t"]) for _ in range(rng.randint(0, 120))) for _ in range(150)]
    got = quality_rules.quality_rules(frame(spark, list(enumerate(texts)))).collect()
    for r in got:
        want = brute_quality(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)


def test_lines_brute_force(spark):
    a, b = "A common line that is longer than forty characters, surely.", "another line which only four documents hold, but long enough"
    docs = {k: "\n".join(["own %d" % k, f"  {a.upper() if k % 2 else a}\t", *([b] if k < 4 else []), a, "short"]) for k in range(6)}
    got = {r.doc_id: r for r in line_dedup.dedup_lines(frame(spark, list(docs.items()))).collect()}
    for k, t in docs.items():
        keep = [x for x in t.split("\n") if k == 5 or x.strip(WS).lower() != a.lower()]
        assert got[k].text == "\n".join(keep) and got[k].n_lines == len(t.split("\n")) and got[k].n_dropped == len(t.split("\n")) - len(keep)


def folded(text):
    return [w for c in (text or "").split() if (w := fold(c))]


def brute_pj(a, b):
    a, b = Counter(a), Counter(b)
    keys = set(a) | set(b)
    if set(a.values()) | set(b.values()) == {1}:
        return len(set(a) & set(b)) / len(keys)
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in keys) for i in set(a) & set(b))


def grams(text, n=5):
    w = folded(text)
    return [tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))] if w else []


def near_texts():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    out = []
    for size in (3, 6, 40, 120):
        for _ in range(4):
            base = [word() for _ in range(size)]
            out.append(" ".join(base))
            for edits in (0, 1, 2, 4):
                copy = list(base)
                for _ in range(edits):
                    copy[rng.randrange(size)] = word()
                out.append(" ".join(copy))
    base = [word() for _ in range(100)]
    for _ in range(80):  # a large group around one text, with pairs on both sides of the threshold
        copy = list(base)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(100)] = word()
        out.append(" ".join(copy))
    return [*out, *(" ".join(t.split() * 2) for t in out[:20]), "", None, "!!"]


def test_near_dedup_brute_force(spark):
    texts = near_texts()
    sets = [grams(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and brute_pj(sets[a], sets[b]) >= 0.8 - 1e-9:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: r.class_id for r in near_dedup.classes(frame(spark, list(enumerate(texts)))).collect()}
    assert got == {k: find(k) for k in range(len(texts))}
    kept = near_dedup.drop_near_duplicates(frame(spark, list(enumerate(texts))))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({find(k) for k in range(len(texts))})


def test_near_dedup_judges_rows_of_one_id_by_their_text(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    near = lambda t: t + " more"
    # Ids 5 and 2 stand for two texts each; a, b and c have nothing in common.
    rows = [(5, a), (5, b), (7, near(a)), (8, near(b)), (2, c), (2, near(near(a))), (9, near(c))]
    got = sorted(tuple(r) for r in near_dedup.classes(frame(spark, rows)).collect())
    assert got == [(2, 2), (2, 2), (5, 2), (5, 5), (7, 2), (8, 5), (9, 2)]
    got = sorted(tuple(r) for r in near_dedup.classes(frame(spark, [(5, a), (5, b), (3, near(a)), (8, near(b))])).collect())
    assert got == [(3, 3), (5, 3), (5, 5), (8, 5)]


def test_near_dedup_writes_shingles_of_candidates_only(spark, monkeypatch):
    written = []

    class Watched(Scratch):
        def save(self, df):
            out = super().save(df)
            path = out._terraloom_path.removeprefix("file://")
            written.append(sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet")))
            return out

    monkeypatch.setattr(near_dedup, "Scratch", Watched)
    texts = [" ".join(f"{k}x{j}" for j in range(20_000)) for k in range(10)]
    a = " ".join(f"a{j}" for j in range(60))
    # A text of a candidate stands twice under one id.
    rows = [*enumerate(texts, 10), (1, a), (1, a), (2, a + " more"), (3, a + " more words")]
    got = sorted(tuple(r) for r in near_dedup.classes(frame(spark, rows)).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), *((k, k) for k in range(10, 20))]
    assert sum(written) < 0.2 * sum(map(len, texts))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=25), st.lists(st.integers(0, 12), min_size=1, max_size=25))
def test_probability_jaccard(a, b):
    got = near_dedup.probability_jaccard(np.sort(np.array(a, np.uint32)), np.sort(np.array(b, np.uint32)))
    assert abs(got - brute_pj(a, b)) < 1e-9


def test_registers_agree_as_often_as_texts_are_alike():
    a, b = {k: 1 + k % 3 for k in range(1, 120)}, {k: 1 + k % 2 for k in range(20, 140)}
    n = 4000
    pack = lambda d: (np.array([word_hash(f"w{k}") for k in d], np.uint64), np.array([*d.values()], float))
    (sa, wa), (sb, wb) = pack(a), pack(b)
    who = near_dedup.signatures(np.concatenate((sa, sb)), np.concatenate((wa, wb)), np.repeat([0, 1], [len(a), len(b)]), 2, n)
    assert abs((who[0] == who[1]).mean() - brute_pj(list(Counter(a).elements()), list(Counter(b).elements()))) < 4 * 0.5 / n**0.5


@pytest.fixture(scope="module")
def libraries():
    return Tokenizer.from_file(WORDS), bpe.Bpe(WORDS), Tokenizer.from_file(BYTES), token_counts.PrefixCounter(BYTES)


PIECES = st.lists(st.one_of(st.text(max_size=4), st.sampled_from([" ", "  ", "\n", "'s", "'re", "the", "ing", "É", "ΟΔΟΣ", "日本", "12", "!?", "<|endoftext|>", "<|start", "😀"])), max_size=14).map("".join)


@settings(max_examples=250, deadline=None)
@given(PIECES)
def test_bpe_is_the_library(libraries, text):
    lib, own, _, _ = libraries
    text = text.encode("utf-8", "replace").decode()
    ids = lib.encode(text, add_special_tokens=False).ids
    assert bpe.encode_text(own, Cache(own.encode_word), text) == ids
    assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_every_code_point_is_the_library(libraries):
    words, own, letters, counter = libraries
    cache = Cache(own.encode_word)
    # Every 7th of the large uniform blocks (ideographs, syllables), every 61st of planes without characters of their own.
    step = lambda c: 7 if 0x3400 <= c < 0xA000 or 0xAC00 <= c < 0xD800 or 0x17000 <= c < 0x18D00 or 0x20000 <= c < 0x40000 else 61 if c >= 0x40000 or 0xE000 <= c < 0xF900 else 1
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and not c % step(c)]
    for lo in range(0, len(codes), 64):
        text = "".join(f"a{chr(c)}:{chr(c)} 1{chr(c)}" for c in codes[lo : lo + 64])
        assert bpe.encode_text(own, cache, text) == words.encode(text, add_special_tokens=False).ids, hex(lo)
        assert counter.total(text) == len(letters.encode(text, add_special_tokens=False).ids), hex(lo)


@settings(max_examples=120, deadline=None)
@given(PIECES)
def test_every_prefix_count_is_the_library(libraries, text):
    _, _, lib, own = libraries
    text = text.encode("utf-8", "replace").decode()
    want = [len(lib.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
    assert own.counts(text).tolist() == want and own.total(text) == want[-1]
    for budget in range(want[-1] + 2):
        assert own.chars_within(text, budget) == max(k for k, n in enumerate(want) if n <= budget)


def test_long_fragments_are_the_library(libraries):
    lib, own, count, prefix = libraries
    for t in ("ab" * 700, "a" * 3000, "é" * 900 + "x", "-" * 1200):
        assert bpe.encode_text(own, Cache(own.encode_word), t) == lib.encode(t, add_special_tokens=False).ids
        assert prefix.total(t) == len(count.encode(t, add_special_tokens=False).ids)


def test_prefix_counts_of_long_words_are_the_library(libraries):
    _, _, lib, own = libraries
    rng = random.Random(2)
    letters = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") for _ in range(6000))
    for t in (letters, "-" * 3000, " " * 3000 + "x", "a" * 4000, "é" * 2000, "x" + "=" * 5000, "\n " * 1600, letters[:65]):
        got = own.counts(t)
        at = sorted({0, 1, len(t), *(k for k in (63, 64, 65, 2048) if k <= len(t)), *(rng.randint(0, len(t)) for _ in range(40))})
        assert [int(got[k]) for k in at] == [len(lib.encode(t[:k], add_special_tokens=False).ids) for k in at]
        assert own.total(t) == got[-1] and len(got) == len(t) + 1


def test_forced_cuts_change_nothing(libraries):
    _, own, _, _ = libraries
    word = "straße日本ab"
    assert len(own.fragments(word.encode())) > 1 and b"".join(own.fragments(word.encode())) == word.encode()
    assert list(own.encode_word(word)) == own.fragment(word.encode(), True)


def test_ids_of_words_are_kept_small(libraries):
    words, own, _, _ = libraries
    end = next(iter(own.added))
    texts = ["", " ", "one two", f"one{end} two {end}{end}", "\u0378 odd", "ß" * 300]
    cache = bpe.packed_words(own)
    assert [np.frombuffer(bpe.packed_text(own, cache, t), np.int32).tolist() for t in texts] == [words.encode(t, add_special_tokens=False).ids for t in texts]
    rng = random.Random(3)
    names = ["".join(rng.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(20_000)]
    tracemalloc.start()
    kept = bpe._loaded.__wrapped__(WORDS)[1]
    before = tracemalloc.get_traced_memory()[0]
    for name in names:
        kept[name]
    size = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    # The table's slots and an object for each word's ids; the words themselves stand in names.
    assert size < 150 * len(names)


def test_round_trip_and_budgets(spark):
    df = frame(spark, [(1, "Hello wörld, it's 12"), (2, None)])
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(df, WORDS), WORDS).collect()}
    assert got[1].decoded.replace("</w>", "").startswith("hello") and got[2].decoded == "" and got[2].ids == []
    out = token_counts.count_tokens(df, BYTES, prefixes=True)
    cut = {r.doc_id: r[1:] for r in out.select("doc_id", token_counts.truncate(F.col("text"), F.col("prefix_tokens"), F.lit(2)).alias("t"), token_counts.tokens_of_prefix(F.col("prefix_tokens"), F.lit(5)).alias("n")).collect()}
    lib = Tokenizer.from_file(BYTES)
    text = "Hello wörld, it's 12"
    want = max(k for k in range(len(text) + 1) if len(lib.encode(text[:k]).ids) <= 2)
    assert cut[1] == (text[:want], len(lib.encode(text[:5]).ids)) and cut[2] == ("", None)


def test_token_queries(spark):
    rows = {r.doc_id: r for r in queries.op6_bpe(spark, SF).collect()}
    counts = {r.doc_id: r for r in queries.op8_token_counts(spark, SF).collect()}
    lib, count = Tokenizer.from_file(WORDS), Tokenizer.from_file(BYTES)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        assert (rows[r.doc_id].n_tokens, rows[r.doc_id].ids_sha256, rows[r.doc_id].decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False)))
        n = len(count.encode(r.text or "", add_special_tokens=False).ids)
        assert (counts[r.doc_id].n_tokens, counts[r.doc_id].n_bytes, counts[r.doc_id].over_limit) == (n, len((r.text or "").encode()), n > 512)


def test_toxicity_held_out(spark):
    got = {r.doc_id: r for r in queries.op7_toxicity(spark, "/root/testdata/sf0.1").where("held_out").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect() if r.doc_id in got}
    hit = sum(got[k].predicted == y for k, y in labels.items()) / len(labels)
    taken, toxic = [k for k in labels if got[k].predicted], [k for k, y in labels.items() if y]
    both = sum(labels[k] for k in taken)
    assert hit > 0.93 and hit > 1 - len(toxic) / len(labels) + 0.05 and all(0 <= r.score <= 1 for r in got.values())
    assert both / len(taken) > 0.75 and both / len(toxic) > 0.75


def test_scores_brute_force():
    rng = np.random.default_rng(4)
    size = 1 << toxicity.BITS
    m = toxicity.Machine(-0.3, rng.random(size) < 0.7, rng.standard_normal(size).astype(np.float32), rng.standard_normal((size, toxicity.FACTORS)).astype(np.float32))
    texts = ["an insult to a group", "one", "", None, "word " * 30 + "other"]
    for t, got in zip(texts, m.scores(texts), strict=True):
        _, slots, values = toxicity.features([t], m.used)
        raw = m.bias + sum(m.weights[i] * x for i, x in zip(slots, values, strict=True))
        for j in range(len(slots)):
            for k in range(j):
                raw += float(m.factors[slots[j]] @ m.factors[slots[k]]) * values[j] * values[k]
        assert abs(got - 1 / (1 + math.exp(-raw))) < 1e-4


def test_toxicity_sample_is_bounded_and_odd_labels_do(spark, monkeypatch):
    docs = frame(spark, [(k % 40, f"text {k} of some words insult" if k % 2 else f"text {k} nice") for k in range(400)] + [(None, "x"), (41, None)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(1, 0), (None, 1), (2, None), (41, 1)], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(docs, labels, per_class=5).collect()
    assert len(sample) <= 10 and len({r["__id"] for r in sample}) == len(sample)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 0)
    assert len(set(toxicity.fit(docs, labels).scores(["a", "b c"]).tolist())) == 1
    empty = toxicity.fit(frame(spark, []), labels.limit(0))
    assert toxicity.score(docs.limit(3), empty).where("predicted = 0").count() == 3
    assert [r.h for r in spark.range(1).select(toxicity.held_out(F.lit(None).cast("long")).alias("h")).collect()] == [False]


def test_pairs_count_for_more_than_their_terms():
    texts = [f"{a} {b} filler words here" for a in ("insult", "nice") for b in ("group", "tree")] * 40
    labels = [int("insult" in t and "group" in t) for t in texts]
    rows = []
    for t, y in zip(texts, labels, strict=True):
        _, s, v = toxicity.features([t])
        rows.append((s.astype(np.int32), v.astype(np.float32), y))
    m = toxicity.train(rows, epochs=30)
    assert [int(p >= 0.5) for p in m.scores(texts[:4])] == labels[:4]


def test_long_words_count_whole():
    slots = lambda t: set(toxicity.features([t])[1].tolist())
    for a, b in (("donaudampfschiff", "donaudampfkessel"), ("x" * 11, "x" * 12), ("a" * 200 + "b", "a" * 200 + "c")):
        assert len(slots(a)) == 6 and len(slots(a) & slots(b)) == 5
    assert slots("shortish") != slots("shortist") and slots("(Donaudampfschiff!)") == slots("donaudampfschiff")


def test_leaks_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 60))) + ".\nAn answer " + rng.choice(vocabulary)) for k in range(60)]
    docs = []
    for k in range(200):
        body = [rng.choice(vocabulary) for _ in range(rng.randint(5, 400))]
        if k % 3 == 0:
            copy = rng.choice(items)[1].upper().split()
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = "edited"
            body[rng.randrange(len(body)) : 0] = copy
        docs.append((k, " ".join(body)))
    want = set()
    for d, text in docs:
        w = folded(text)
        for k, item in items:
            g, (q, a) = set(grams(item)), decontaminate.split_item(item)
            for at in range(0, max(1, len(w)), 64):
                p = w[at : at + 128]
                held = {tuple(p[i : i + 5]) for i in range(len(p) - 4)}
                bag = Counter(p)
                part = lambda x: sum((Counter(x) & bag).values()) / len(x) if x else 1.0  # noqa: B023, E731
                if len(g & held) / len(g) >= 0.8 - 1e-9 and min(part(q), part(a)) >= 0.8 - 1e-9:
                    want.add((d, k))
    frame_items = spark.createDataFrame([*items, (99, None), (98, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(frame(spark, docs), frame_items).collect()}
    assert got == want and len(want) > 30
    kept = decontaminate.drop_leaky(frame(spark, docs), frame_items)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_edited_and_truncated_copies_leak(spark):
    question, answer = [f"q{k}" for k in range(25)], [f"a{k}" for k in range(16)]
    items = [(1, " ".join(question) + ". " + " ".join(answer)), (2, " ".join(f"r{k}" for k in range(60)) + ". yes indeed"), (3, " ".join(f"s{k}" for k in range(60)) + ". one two three four five six seven")]
    prose = " ".join(f"p{k}" for k in range(50))
    cut, edited = " ".join([*question, *answer[:-5]]), items[1][1].replace("indeed", "never")
    bare = items[2][1].split(".")[0]
    # An item that keeps its question and 4 words of 16, at too few of the shingles, and prose give nothing away.
    few = " ".join([*question, *answer[:4]])
    docs = [(k, f"{prose} {t} {prose}") for k, t in enumerate((cut, edited, bare, few, prose))]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(frame(spark, docs), table).collect()}
    assert set(got) == {(0, 1), (1, 2)}
    assert got[0, 1].answer < 0.8 <= got[0, 1].shingles < 0.9 and got[1, 2].answer < 0.8 and got[1, 2].shingles >= 0.9


def test_wand_loses_nothing():
    rng = random.Random(11)
    words = [f"w{k}" for k in range(120)]
    items = [(k, " ".join(rng.choice(words[: rng.choice((20, 120))]) for _ in range(rng.randint(1, 90)))) for k in range(700)]
    df = Counter(w for _, t in items for w in {word_hash(c) for c in t.split()})
    terms, indexes = decontaminate.build_indexes(items, df, len(items), 30.0)
    assert [ix.step for ix in indexes] == [64, 128] and any(ix.block > 1 for ix in indexes)
    for _ in range(60):
        query = sorted({terms[word_hash(rng.choice(words[:60]))] for _ in range(rng.randint(1, 60))})
        for ix in indexes:
            scores = np.zeros(len(ix.ids))
            for t in query:
                np.add.at(scores, ix.lists[t][0], ix.lists[t][1])
            got = dict(decontaminate.wand(ix, query))
            assert sorted(got) == np.flatnonzero(scores >= 1 - 1e-9).tolist() and all(abs(scores[k] - s) < 1e-9 for k, s in got.items())


def test_an_item_leaks_whatever_the_others_are(spark, monkeypatch):
    item, long = " ".join(f"q{k}" for k in range(30)) + ". An answer of six words here", " ".join(f"z{k}" for k in range(600))
    prose = [f"p{k}" for k in range(150)]
    # Its words lie too far apart for its own passage, not for that of a long item.
    spread = " ".join(w for k, c in enumerate(item.split()) for w in (c, *prose[k * 4 : k * 4 + 4]))
    docs = frame(spark, [(1, item), (2, spread), (None, item), (1, "clean text")])
    table = lambda rows: spark.createDataFrame(rows, "item_id long, text string")
    alone = sorted(map(repr, decontaminate.find_leaks(docs, table([(1, item)])).where("item_id = 1").select("doc_id", "shingles", "question", "answer").collect()))
    both = sorted(map(repr, decontaminate.find_leaks(docs, table([(1, item), (2, long)])).select("doc_id", "shingles", "question", "answer").collect()))
    assert alone == both and len(alone) == 2
    assert [tuple(r) for r in decontaminate.drop_leaky(docs, table([(1, item)])).orderBy("doc_id").collect()] == [(1, "clean text"), (2, spread)]
    monkeypatch.setattr(decontaminate, "ITEMS", 2)
    more = table([(1, item), (2, long), *((k, f"{k} other words of no text {k}") for k in range(3, 8))])
    assert sorted(map(repr, decontaminate.find_leaks(docs, more).select("doc_id", "shingles", "question", "answer").collect())) == alone


def test_sharding():
    names = [f"s{k}" for k in range(7)]
    table = sharding.lookup_table(names, 101)
    fewer = sharding.lookup_table(names[:-1], 101)
    sizes = Counter(table)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert sum(a != b for a, b in zip(table, fewer, strict=True) if a != 6) < 30
    for bad in ((names, 100), (["a", "a"], 101), ([], 101)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://A.COM/en/x", "http://com/en/", "http://xcom/en/", "http://example.com/en/71?q", "http://b.example.net/de/8#f", "http://c.net/de/9", "ftp://x.org/ES/", "http://x.org"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("old"))
    none = spark.createDataFrame([], "tokens array<string>, confidence double, support double, anchor string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, none).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.com", "/en/x", "com/en/", "block") and got[5][2] is None and got[6][2:] == ("example.com/en/7", "allow")
    assert got[7] == ("b.example.net", "/de/8", "example.net/de/8", "block") and got[8][2:] == ("net/de/", "allow") and got[9][2] is None and got[10][:2] == ("x.org", "")
    assert url_filter.filter_urls(pages.limit(0), none).count() == 0
    empty = spark.createDataFrame([], "url string, bad boolean")
    assert url_filter.mine_rules(empty).count() == 0


def test_mined_rules_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.sample("abcdefg", rng.randint(1, 6)), None) for _ in range(200)]
    rows = [(t, {"a", "b", "c"} <= set(t) or {"d", "e", "f", "g"} <= set(t)) for t, _ in rows]
    total, bad = Counter(), Counter()
    for tokens, b in rows:
        for n in range(1, len(tokens) + 1):
            for x in combinations(sorted(tokens), n):
                total[x] += 1
                bad[x] += b
    want = {x: bad[x] / total[x] for x in total if bad[x] >= math.ceil(0.01 * len(rows)) and bad[x] / total[x] >= 0.8}
    want = {x: c for x, c in want.items() if not any(set(y) < set(x) for y in want)}
    urls = spark.createDataFrame([("http://" + "/".join(t), b) for t, b in rows], "url string, bad boolean")
    mined = url_filter.mine_rules(urls, 0.01, 0.8).cache()
    assert {tuple(r.tokens): round(r.confidence, 9) for r in mined.collect()} == {x: round(c, 9) for x, c in want.items()}
    assert min(map(len, want)) == 3 and max(map(len, want)) == 4
    got = url_filter.filter_urls(urls.withColumn("page_id", F.monotonically_increasing_id()), mined, ()).collect()
    assert len(got) == len(rows) and all((r.verdict == "block") == any(set(x) <= set(r.url[7:].split("/")) for x in want) for r in got)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in quality_rules.quality_rules(docs).where("kept").collect()}
    texts = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame(spark, list(texts.items()))).collect()}
    left, sets = {}, {}
    for k in sorted(texts):
        sets[k] = grams(texts[k])
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if min(len(sets[a]), len(sets[b])) and set(sets[a]) & set(sets[b]) and brute_pj(sets[a], sets[b]) >= 0.8 - 1e-9:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    left = {k for k in texts if find(k) == k}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaky = {k for k in left if any(len(set(grams(t)) & set(sets[k])) >= 0.8 * len(set(grams(t))) for t in items)}
    lib = Tokenizer.from_file(WORDS)
    assert got == {k: lib.encode(texts[k], add_special_tokens=False).ids for k in left - leaky}


def test_pipeline_odd_rows(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    prose = lambda n: " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else "".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    a, b, c = prose(120), prose(120), prose(90)
    long, item = prose(20_000), " ".join(f"q{k}" for k in range(30)) + ". an answer of six words here"
    rows = [(1, a), (1, b), (2, a + " more"), (3, b), (3, b), (4, f"{prose(60)} {item} {prose(60)}"), (5, long), (6, None), (7, ""), (None, c), (8, "too short"), (9, c + " more")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, ids string, class_id string, __lost string"

    def run(name, rows):
        (tmp_path / name).mkdir()
        spark.createDataFrame([(*r, "en", "s", 0, "x", "y", "z") for r in rows], schema).write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / name / "benchmark.parquet"))
        return corpus_pipeline.run(spark, str(tmp_path / name)).collect()

    # Both texts of id 1 are the least of their classes and go on; the rows with id 2 and 3 are their copies; 4 leaks; a null id stays.
    got = run("odd", rows)
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 1, 5, 9] and all(r.n_tokens == len(r.ids) > 0 for r in got)
    assert run("none", []) == []


def test_recall_of_near_dedup(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
    sets = {r.doc_id: grams(r.text) for r in docs.collect()}
    by = {}
    for k, g in sets.items():
        for x in set(g):
            by.setdefault(x, []).append(k)
    pairs = {(x, y) for ids in by.values() for x in ids for y in ids if x < y}
    alike = [(x, y) for x, y in pairs if brute_pj(sets[x], sets[y]) >= 0.8 - 1e-9]
    assert len(alike) > 10 and sum(got[x] == got[y] for x, y in alike) >= 0.99 * len(alike)

