"""Registered queries of the corpus operators: each applies one operator,
with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm import (
    decontaminate, language_id, line_dedup, minhash_dedup, mixing, quality_classifier, quality_rules, secret_scan, sharding,
    substring_dedup, turn_repair, vector_codes, warc)
from ordermart.llm.common import corpus_session, read_table
from ordermart.llm.oracle import ORACLE  # noqa: F401  (registered with the queries)
from ordermart.session import scratch_path


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus_session(spark)
    out = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus_session(spark)
    return quality_classifier.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus_session(spark)
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus_session(spark)
    return secret_scan.scan(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus_session(spark)
    return mixing.mixture(read_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus_session(spark)
    path = scratch_path(spark, "warc")
    warc.write_archives(read_table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path, payload=False)


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus_session(spark)
    return minhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus_session(spark)
    return sharding.manifest(read_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus_session(spark)
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus_session(spark)
    return quality_rules.judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus_session(spark)
    return line_dedup.drop_common_lines(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus_session(spark)
    conversations = read_table(spark, sf_dir, "conversations")
    found = turn_repair.digest(turn_repair.repair(turn_repair.damage(conversations)))
    ids = conversations.select(F.col("conv_id").cast("long").alias("of_conv")).distinct()
    nothing = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return ids.join(found, F.col("of_conv").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("of_conv").alias("conv_id"),
        *(F.coalesce(F.col(c), nothing.get(c, F.lit(0).cast("long"))).alias(c) for c in found.columns if c != "conv_id"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus_session(spark)
    coded, codebooks = vector_codes.compress(read_table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(coded).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(vector_codes.codebooks_sha256(codebooks)).alias("codebooks_sha256"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_language_id": op3_language_id,
    "op4_secret_scan": op4_secret_scan,
    "op5_source_mixing": op5_source_mixing,
    "op6_warc": op6_warc,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_sharding": op8_sharding,
    "op9_decontamination": op9_decontamination,
    "op10_quality_rules": op10_quality_rules,
    "op11_line_dedup": op11_line_dedup,
    "op12_turn_repair": op12_turn_repair,
    "op13_vector_codes": op13_vector_codes,
}
