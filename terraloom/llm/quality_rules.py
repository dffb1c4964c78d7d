"""Quality rules: a threshold table compiled into one Spark projection.

Every statistic is a built-in expression over the whole text; no user function, no shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, let, words_of

SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = sorted(
    set(
        """the of and to in is that it was for on are as with his they at be this have from or had by not but what all were
        when we there can an your which their said if do will each how them then she many some so these would into has her
        le la les de des du un une et est en que qui pour dans sur pas par avec au aux ce se ne plus son sont il elle
        der die das und ist im den dem des ein eine mit von zu auf für nicht sich als auch es an er sie wie bei nach aus
        el los las y del al una por con para como su no lo más o sus""".split()
    )
)


@dataclass(frozen=True)
class Rule:
    """A statistic must lie in [low, high]; None leaves a side open."""

    name: str
    low: float | None
    high: float | None


COUNTS = ("n_words", "n_lines", "n_repeat_words", "n_dup_lines", "word_chars", "n_symbols", "n_stop_words")

#: The threshold table. Ratios are 0 for texts without words or lines.
RULES = (
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbols_per_word", None, 0.3),
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.5),
)


def _repeated(w: Column) -> Column:
    """Words covered by a 3-word window that occurs twice or more, counting the first occurrence.

    Windows are compared by 64-bit hash within one text. The sort only runs for texts that repeat a window.
    """
    windows = F.slice(F.arrays_zip(w, F.slice(w, 2, F.size(w)), F.slice(w, 3, F.size(w))), 1, F.size(w) - 2)
    grams = F.transform(windows, lambda x: F.xxhash64(x))

    def marked(s: Column) -> Column:
        again = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
        starts = F.transform(again, lambda x: x["i"])
        return let(starts, lambda p: F.size(F.array_distinct(F.concat(p, F.transform(p, lambda v: v + 1), F.transform(p, lambda v: v + 2)))))

    def count(g: Column) -> Column:
        placed = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(placed, marked))

    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(grams, count)).cast("long")


def _trie(words: list[str]) -> str:
    """A regular expression for exactly these words that shares their beginnings."""
    ends, by = "" in words, {}
    for w in words:
        if w:
            by.setdefault(w[0], []).append(w[1:])
    if not by:
        return ""
    body = "|".join(re.escape(c) + _trie(rest) for c, rest in sorted(by.items()))
    return f"(?:{body})" + "?" * ends


STOP_PATTERN = r"(?<![^\x20\x09-\x0D])" + _trie(STOP_WORDS) + r"(?![^\x20\x09-\x0D])"


def statistics(text: Column) -> Column:
    """A struct of counts over the whole text, each a long; all 0 for a null text."""
    t = F.coalesce(text, F.lit(""))
    of_words = let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated(w).alias("n_repeat_words")))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(WS)) != "")
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return F.struct(
        of_words.alias("w"),
        of_lines.alias("l"),
        F.length(F.translate(t, WS, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.regexp_count(F.lower(t), F.lit(STOP_PATTERN)).cast("long").alias("n_stop_words"),
    )


def ratios(c=F.col) -> dict[str, Column]:
    """The statistics of the threshold table, over the columns of ``statistics``."""

    def per(a: str, b: str) -> Column:
        return F.when(c(b) > 0, c(a) / c(b)).otherwise(F.lit(0.0))

    return {
        "mean_word_chars": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "stop_word_ratio": per("n_stop_words", "n_words"),
        "dup_line_ratio": per("n_dup_lines", "n_lines"),
    }


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where all rules hold."""
    values, ok = ratios(), F.lit(True)
    for r in rules:
        if r.low is not None:
            ok = ok & (values[r.name] >= r.low)
        if r.high is not None:
            ok = ok & (values[r.name] <= r.high)
    return ok


def quality_rules(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows and columns of ``docs`` plus the statistics, ``base_failed`` and ``kept``.

    Null, empty and blank texts have counts of 0 and fail the base rule. Ties and repeated rows are judged
    alike, row by row; an empty table gives an empty result. Columns of ``docs`` that bear a result's name
    are replaced by the result.
    """
    keep = [c for c in docs.columns if c == text_col or c not in {*COUNTS, "base_failed", "kept"}]
    # A generator of one row: its statistics are made once, whatever is later asked of them.
    out = docs.select(*keep, F.inline(F.array(statistics(F.col(text_col)))).alias("__w", "__l", *COUNTS[4:]))
    out = out.select(*keep, F.col("__w.n_words"), F.col("__l.n_lines"), F.col("__w.n_repeat_words"), F.col("__l.n_dup_lines"), *COUNTS[4:])
    base = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return out.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & verdict(rules))
