"""Registered queries of this package: one per operator, over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_repair,
    decontaminate,
    embedding_dedup,
    lattice_sampling,
    lexical_search,
    license_scan,
    line_dedup,
    secret_scan,
    simhash,
    structure_repair,
    token_counts,
    toxicity,
    warc,
)
from .common import table
from .oracle import ORACLE  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op2_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op4_gumbel_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lattice_sampling.encode(table(spark, sf_dir, "documents"), with_pieces=False, with_source=True, with_decoded=True)
    decoded = F.sha2("decoded", 256)
    return found.withColumn("decoded_sha256", decoded).withColumn("round_trip", F.col("decoded_sha256") == F.col("source_sha256")).drop("decoded", "source_sha256")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", spans.alias("spans"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op7_longest_match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op8_simhash_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_pstable_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair(table(spark, sf_dir, "conversations"))


def op11_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair.repair_conversations(table(spark, sf_dir, "conversations"))


def op13_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_secret_ownership": op1_secret_ownership,
    "op2_toxicity_cnn": op2_toxicity_cnn,
    "op3_seekable_warc": op3_seekable_warc,
    "op4_gumbel_topk": op4_gumbel_topk,
    "op5_decontamination": op5_decontamination,
    "op6_line_dedup": op6_line_dedup,
    "op7_longest_match_counts": op7_longest_match_counts,
    "op8_simhash_multi_index": op8_simhash_multi_index,
    "op9_pstable_embeddings": op9_pstable_embeddings,
    "op10_role_repair": op10_role_repair,
    "op11_license_rules": op11_license_rules,
    "op12_structure_repair": op12_structure_repair,
    "op13_dual_tree_search": op13_dual_tree_search,
    "pipeline": pipeline,
}


