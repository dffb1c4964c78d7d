"""The corpus pipeline: quality rules, line dedup, MinHash near-dedup, benchmark decontamination, BPE encoding.

Each stage works on all rows its predecessor kept and its decisions take effect. Between stages the rows are written as
Parquet to the folder that all executors share and read again, so a lost executor costs no earlier stage. ``text`` and
``n_chars`` change with line dedup; the other columns of ``documents`` pass through, further ones are left out. Null texts count
as empty and fall to the quality rules. Rows that repeat an id are judged by their own text; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.llm import bpe, decontaminate, line_dedup, near_dedup, quality_rules
from terraloom.llm.common import Scratch, table
from terraloom.llm.queries import ENCODER, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.quality_rules(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; ``n_chars`` is counted anew."""
    out = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the least doc_id, of each class of near copies."""
    return near_dedup.drop_near_duplicates(docs.select(*COLUMNS))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give no benchmark item away."""
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontaminate.drop_leaky(docs.select(*COLUMNS), items)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and their number, with the columns that say where a document comes from."""
    return bpe.encode(docs.select(*COLUMNS), vocabulary(ENCODER)).select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [("quality rules", quality), ("line dedup", lines), ("near dedup", near), ("decontamination", benchmark), ("bpe encoding", encoded)]

#: Near-dedup, decontamination and BPE have no SQL form; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, docs = Scratch(spark), table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        then = store.save(stage(spark, docs, sf_dir))
        store.drop(docs)
        docs = then
    return docs
