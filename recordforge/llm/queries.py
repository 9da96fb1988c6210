"""Registered queries of the subpackage: opN_<name> -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import binary_neardup, boosted_rules, chat_preferences, graph_ann, html_consensus, language_id, license_scan, lsh_forest, packing, seekable_tokens, source_mixing, token_alignment, whitening
from .common import table


def op1_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return chat_preferences.format_pairs(chat_preferences.swapped_answers(turns))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.language_id(docs).select("doc_id", "held_out", "lang_pred", "score", "bits_per_char")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    span = F.transform("hits", lambda h: F.concat_ws(":", h["license"], h["first"].cast("string"), h["end"].cast("string")))
    return rows.select("doc_id", "n_words", "license", F.round("coverage", 6).alias("coverage"), F.array_join(span, " ").alias("hits"))


def op4_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_consensus.main_text(table(spark, sf_dir, "pages"))


def op5_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = seekable_tokens.token_files(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return graph_ann.nearest(rows, rows.filter(F.col("vec_id") % 50 == 0), k=5)


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.jaccard_join(table(spark, sf_dir, "documents"))


def op11_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = boosted_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", *boosted_rules.BASE, "base_failed", "kept", "quality")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_preference_pairs, op2_language_id, op3_license_scan, op4_html_main_text, op5_embedding_neardup, op6_best_fit_packing, op7_token_files, op8_source_mix, op9_graph_neighbours, op10_ngram_jaccard, op11_quality_trees, op12_token_alignment, op13_whitening)}
ORACLE_SQL = {"op1_preference_pairs": chat_preferences.ORACLE, "op8_source_mix": source_mixing.ORACLE}
