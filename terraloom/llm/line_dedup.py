"""Line dedup: lines found in many documents stay only in the last of them.

Lines are exploded, normalised and hashed to 128 bits once; the hashes and positions are written to the shared folder, and only
they are shuffled for the counts. Where few hashes are common, or few positions lost, they are broadcast, so that neither a
line that stands everywhere nor a text has to move; else the join is a sort-merge join, whose hot partitions Spark splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, Scratch, ascii_lower, let

MIN_CHARS, MIN_DOCS = 40, 5
#: Common hashes and lost positions are broadcast up to so many; at most some 30 bytes each.
BROADCAST_HASHES, BROADCAST_POSITIONS = 500_000, 1_000_000


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(WS)))


def _hashed(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    lines = F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("__pos", "__line")
    keyed = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__row"), lines)
    keyed = keyed.select("__id", "__row", "__pos", line_key(F.col("__line")).alias("__key")).where(F.length("__key") >= min_chars)
    return keyed.select("__id", "__row", "__pos", F.xxhash64("__key").alias("__h1"), F.xxhash64(F.lit(7), "__key").alias("__h2"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All rows and columns of ``docs`` with the text's surviving lines, ``n_lines`` (before) and ``n_dropped``.

    A key of at least ``min_chars`` code points found in at least ``min_docs`` distinct ids loses all its lines except in
    the largest id that holds it (there every occurrence stays). A null text counts as one empty line and becomes an
    empty text. Rows with a null id hold no document: they neither count nor lose lines. Rows that repeat an id count as
    one document. An empty table gives an empty result; texts of any length are split whole. Columns of ``docs`` named like a
    result are replaced.
    """
    store = Scratch(docs.sparkSession)
    lines = store.save(_hashed(docs, id_col, text_col, min_chars))
    counts = lines.groupBy("__h1", "__h2").agg(F.count_distinct("__id").alias("__docs"), F.max("__id").alias("__last"))
    common = store.save(counts.where(F.col("__docs") >= min_docs))
    few = F.broadcast(common) if common.count() <= BROADCAST_HASHES else common.hint("merge")
    lost = lines.join(few, ["__h1", "__h2"]).where(F.col("__id") < F.col("__last")).groupBy("__id", "__row").agg(F.sort_array(F.collect_set("__pos")).alias("__lost"))
    lost = store.save(lost.select(F.col("__id").alias("__lost_id"), F.col("__row").alias("__lost_row"), "__lost"))
    positions = lost.agg(F.coalesce(F.sum(F.size("__lost")), F.lit(0))).first()[0]
    store.drop(lines, common)
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = F.split(text, "\n", -1)
    kept = let(split, lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("__lost")), lambda p: F.get(x, p)), "\n"))
    out = docs.drop("n_lines", "n_dropped") if text_col not in ("n_lines", "n_dropped") else docs
    same = (F.col(id_col) == F.col("__lost_id")) & (F.col("__row") == F.col("__lost_row"))
    out = out.withColumn("__row", F.xxhash64(text_col)).join(F.broadcast(lost) if positions <= BROADCAST_POSITIONS else lost, same, "left")
    done = [F.when(F.col("__lost").isNull(), text).otherwise(kept).alias(text_col) if c == text_col else F.col(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    n_lines = (F.length(text) - F.length(F.translate(text, "\n", "")) + 1).cast("long")
    return out.select(*done, n_lines.alias("n_lines"), F.coalesce(F.size("__lost"), F.lit(0)).cast("long").alias("n_dropped"))

