"""The registered queries of the ten operators and of the pipeline, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, license_scan, line_dedup, near_dedup, oracles, quality_rules, sharding, token_counts, toxicity, url_filter
from .common import table

#: Vocabulary files are looked up where the installed package has them; the operators take any path.
ENCODER, COUNTER, TOKEN_LIMIT = "word_bpe_49k.json", "byte_bpe_50k.json", 512


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _sha256(text: str) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality_rules.quality_rules(docs)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_stop_words"]
    return out.select("doc_id", *names)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", _sha256("text").alias("kept_sha256"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    mined = url_filter.mine_rules(url_filter.labelled_pages(pages, table(spark, sf_dir, "labels")))
    return url_filter.filter_urls(pages, mined).select("page_id", "host", "path", "rule", "verdict", "mined_rule")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary(ENCODER), decoded=True)
    out = out.withColumn("listed", F.array_join(F.col("ids").cast("array<string>"), " "))
    return out.select("doc_id", "n_tokens", _sha256("listed").alias("ids_sha256"), _sha256("decoded").alias("decoded_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, machine).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = token_counts.count_tokens(docs, vocabulary(COUNTER), budget=TOKEN_LIMIT)
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "budget_chars")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text")
    return decontaminate.find_leaks(docs, items)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents").select("doc_id")).select("doc_id", "slot", "shard")


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_line_dedup, op3_license_scan, op4_url_filter, op5_near_dedup,
        op6_bpe, op7_toxicity, op8_token_counts, op9_decontaminate, op10_sharding,
    )
}

#: Without SQL: near-dedup, BPE, toxicity, token counts and decontamination, which are tested against brute force.
ORACLES = {
    "op1_quality_rules": oracles.quality_rules_sql(),
    "op2_line_dedup": oracles.line_dedup_sql(),
    "op3_license_scan": oracles.license_scan_sql(),
    "op4_url_filter": oracles.url_filter_sql(),
    "op10_sharding": oracles.sharding_sql(),
}
