"""URL filters: given rules by host and path, then association rules that FP-growth mines from labelled URLs.

Mined rules are token sets whose presence implies a bad label with enough support and confidence. They match through an
inverted index from a rule's rarest token.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ascii_lower, let

MIN_SUPPORT, MIN_CONFIDENCE = 0.002, 0.8
BAD = "!bad"


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("com", "/en/", "block"),
    UrlRule("example.com", "/en/7", "allow"),
    UrlRule("net", "/de/", "allow"),
    UrlRule("example.net", "/de/8", "block"),
    UrlRule("org", "/es/", "block"),
)


def host_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct runs of a-z and 0-9 behind ``://`` (A-Z lower-cased), without plain numbers; none for null."""
    rest = ascii_lower(F.regexp_replace(F.coalesce(url, F.lit("")), r"^.*?://", ""))
    return F.array_distinct(F.filter(F.split(rest, "[^a-z0-9]+"), lambda t: t.rlike("[a-z]")))


def rule_for(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else null. The list is configuration of bounded length."""
    fits = lambda r: ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    pick = lambda of: F.coalesce(*[F.when(fits(r), F.lit(of(r))) for r in ordered]) if ordered else F.lit(None).cast("string")
    return pick(lambda r: r.text), pick(lambda r: r.verdict)


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """The least token sets that imply the bad label: ``tokens``, ``confidence``, ``support``, ``anchor``.

    A set is a rule if it stands in at least ``min_support`` of all rows with the bad label and at least ``min_confidence`` of
    the rows that hold it are bad; sets of any size count, but not those that hold a smaller rule, which would add nothing.
    ``labelled`` has ``url`` and ``bad`` (boolean); rows with a null in either are left out, repeated rows count as often as they
    stand, other columns aren't read; no rows give no rules. Tokens that too few bad rows hold and tokens that are a rule alone
    are taken from the rows before FP-growth sees them. At most k / ``min_support`` tokens are left for rows of k tokens, and
    fewer than 2^k / ``min_support`` sets, however large the table is. The anchor is a rule's rarest token (ties: the lesser).
    """
    spark = labelled.sparkSession
    none = spark.createDataFrame([], "tokens array<string>, confidence double, support double, anchor string")
    rows = labelled.where(F.col("url").isNotNull() & F.col("bad").isNotNull()).select(url_tokens(F.col("url")).alias("all"), "bad")
    if not (n := rows.count()):
        return none
    need = math.ceil(min_support * n - 1e-9)
    per = rows.select(F.explode("all").alias("token"), "bad").groupBy("token").agg(F.count("*").alias("freq"), F.count_if("bad").alias("hits"))
    known = per.where(F.col("hits") >= max(1, need)).collect()
    if not known:
        return none
    freq = {r.token: r.freq for r in known}
    alone = [(r.token, r.freq, r.hits) for r in known if r.hits / r.freq >= min_confidence]
    ones = spark.createDataFrame([([t], h / f, h / n, t) for t, f, h in alone], none.schema)
    rest = sorted(freq.keys() - {t for t, _, _ in alone})
    if not rest:
        return ones
    left = F.array_intersect("all", F.split(F.lit(" ".join(rest)), " "))
    items = rows.select(F.concat(left, F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))).alias("items"))
    sets = FPGrowth(itemsCol="items", minSupport=max(1, need) / n * (1 - 1e-9)).fit(items).freqItemsets
    sets = sets.select(F.sort_array(F.array_remove("items", BAD)).alias("tokens"), F.array_contains("items", BAD).alias("bad"), "freq").where(F.size("tokens") > 1)
    both = sets.groupBy("tokens").agg(F.max(F.when(F.col("bad"), F.col("freq"))).alias("hits"), F.max(F.when(~F.col("bad"), F.col("freq"))).alias("freq"))
    rank = F.split(F.lit(" ".join(sorted(rest, key=lambda t: (freq[t], t)))), " ")
    found = both.where(F.col("hits") / F.col("freq") >= min_confidence)
    found = found.select("tokens", (F.col("hits") / F.col("freq")).alias("confidence"), (F.col("hits") / F.lit(n)).alias("support"), F.array_intersect(rank, F.col("tokens"))[0].alias("anchor"))
    store = Scratch(spark)
    found = store.save(found)  # mined once
    lesser = found.select(F.col("tokens").alias("__in"), F.col("anchor").alias("__at"))
    larger = found.select("tokens", F.explode("tokens").alias("__at")).join(lesser, "__at").where((F.size("__in") < F.size("tokens")) & (F.size(F.array_except("__in", "tokens")) == 0))
    out = store.save(ones.union(found.join(larger.select("tokens").distinct(), "tokens", "left_anti")))
    store.drop(found)
    return out


def _by_bucket(mined: DataFrame, n: int) -> Column:
    """The mined rules as a literal: bucket of the anchor's hash -> rules by ``;``, tokens by blanks. A lookup is one array access."""
    buckets = mined.groupBy((F.crc32(F.col("anchor").cast("binary")) % n).alias("at")).agg(F.array_join(F.collect_list(F.array_join("tokens", " ")), ";").alias("rules"))
    held = {r.at: r.rules for r in buckets.collect()}
    return F.split(F.lit("\n".join(held.get(k, "") for k in range(n))), "\n", -1)


def mined_rule(tokens: Column, mined: DataFrame) -> Column:
    """The least mined rule, joined by blanks, whose tokens are all among ``tokens``; else null."""
    n = 1 << max(0, mined.count() - 1).bit_length()
    buckets = _by_bucket(mined, n)

    def least(all_: Column) -> Column:
        listed = F.flatten(F.transform(all_, lambda t: F.split(F.get(buckets, (F.crc32(t.cast("binary")) % n).cast("int")), ";")))
        return F.array_min(F.filter(listed, lambda r: (r != "") & (F.size(F.array_except(F.split(r, " "), all_)) == 0)))

    return let(tokens, least)


def filter_urls(pages: DataFrame, mined: DataFrame, rules: tuple[UrlRule, ...] = RULES, url_col: str = "url") -> DataFrame:
    """All rows and columns of ``pages`` plus ``host``, ``path``, ``rule``, ``verdict`` and ``mined_rule``.

    The longest given rule decides; else a URL that holds all tokens of a mined rule is blocked and any other is
    allowed. ``mined_rule`` is the least such token set joined by blanks, else null. Null URLs and URLs without ``://``
    have an empty host and path and fit no given rule; a null URL is allowed. Repeated rows are judged alike. Columns of
    ``pages`` named like a result are replaced. The mined rules (see ``mine_rules`` for their bound) go into the plan as one
    literal, so pages are judged where they are read, without a shuffle, however often a URL is repeated.
    """
    out = ["host", "path", "rule", "verdict", "mined_rule"]
    df = pages.select(*[c for c in pages.columns if c not in out or c == url_col])
    df = df.withColumn("host", F.coalesce(host_of(F.col(url_col)), F.lit(""))).withColumn("path", F.coalesce(path_of(F.col(url_col)), F.lit("")))
    rule, said = rule_for(F.col("host"), F.col("path"), rules)
    df = df.withColumn("rule", rule).withColumn("__said", said).withColumn("mined_rule", mined_rule(url_tokens(F.col(url_col)), mined))
    verdict = F.coalesce(F.col("__said"), F.when(F.col("mined_rule").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return df.withColumn("verdict", verdict).select(*[c for c in df.columns if c not in ("__said", "mined_rule")], "verdict", "mined_rule")


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """URLs with the labels of the document they serve: the number in the path is its doc_id; bad is poor or toxic."""
    doc = F.try_to_number(F.regexp_extract(path_of(F.col("url")), r"/(\d{1,18})", 1), F.lit("9" * 18)).cast("long")
    facts = labels.groupBy("doc_id").agg((F.min("quality") == 0).alias("poor"), (F.max("toxic") == 1).alias("harm"))
    facts = facts.select("doc_id", (F.coalesce("poor", F.lit(False)) | F.coalesce("harm", F.lit(False))).alias("bad"))
    return pages.select("url", doc.alias("doc_id")).join(facts, "doc_id").select("url", "bad")
