"""The registered query of each operator, over its whole intended table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    adaptive_rules, conversations, embed_dedup, fingerprints, kneser_ney, language_id, license_scan,
    line_dedup, mixing, ngram_join, packing, periodic, quality,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op3_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("source", "text")


def op4_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the tables have no URL of a document: its source is the host, its language the path
    site = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    return quality.rate_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), site)


def op5_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_kneser_ney_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score_texts(_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(_table(spark, sf_dir, "documents"), damage=True, spans=False)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, copies = conversations.damaged(_table(spark, sf_dir, "conversations"))
    return conversations.repair(rows, copies)


def op13_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = adaptive_rules.rate(_table(spark, sf_dir, "documents"))
    return rated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept")


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_license_scan, op3_pfair_mixing, op4_quality_bayes, op5_merkle_fingerprints,
    op6_best_fit_packing, op7_language_id, op8_ngram_jaccard_join,
    op9_embedding_near_dedup, op10_kneser_ney_scores,
    op11_periodic_runs, op12_conversation_repair, op13_adaptive_rules)}

ORACLE: dict[str, str] = {
    "op3_pfair_mixing": mixing.ORACLE,
    "op5_merkle_fingerprints": fingerprints.ORACLE,
}
