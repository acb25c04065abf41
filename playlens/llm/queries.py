"""The registered queries of this subpackage: thin, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playlens.llm import (compression, decontaminate, filter_audit, hard_negatives, licenses, mixing, near_dedup, passages, quality_gam,
                          sharding, simhash, suffix_dedup, toxicity)
from playlens.llm.common import read_table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(licenses.document_paths(read_table(spark, sf_dir, "documents")))


def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.compression_report(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "ratio", "n_chunks", "n_bad_chunks")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op5_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_duplicate_substrings(read_table(spark, sf_dir, "documents"))


def op8_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op9_compact_window_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passage_classes(read_table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicate_groups(read_table(spark, sf_dir, "documents"))


def op11_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_hard_negatives(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_license_scan, op2_compression_bands, op3_benchmark_decontamination, op4_rendezvous_sharding, op5_toxicity_gru, op6_quality_gam,
                            op7_suffix_array_dedup, op8_entropy_mixing, op9_compact_window_passages,
                            op10_minhash_near_dedup, op11_filter_interaction_audit, op12_simhash_near_dedup, op13_hard_negatives)
}

SQL: dict[str, str] = {
    "op1_license_scan": licenses.ORACLE_SQL,
    "op3_benchmark_decontamination": decontaminate.ORACLE_SQL,
    "op4_rendezvous_sharding": sharding.ORACLE_SQL,
    "op10_minhash_near_dedup": near_dedup.ORACLE_SQL,
    "op11_filter_interaction_audit": filter_audit.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}
