"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from panelforge.llm import additive_ann, bloom_lm, bpe_tree, chat, fuzzy_lines, langid, packing, piece_rounds, prefix_trie, rare_digest, simhash_trie, suffix_dedup, token_links

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.rotate_perspectives(_table(spark, sf_dir, "conversations"))
    return out.withColumn("spans", chat.spans_text(F.col("spans"))).withColumnRenamed("spans", "mask")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.dedup_passages(docs).drop("text")


def op3_additive_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return additive_ann.nearest(_table(spark, sf_dir, "embeddings"))


def op4_rare_feature_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rare_digest.digests(_table(spark, sf_dir, "documents"))


def op5_log_frequency_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score_documents(_table(spark, sf_dir, "documents"))


def op6_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = langid.identify(docs, docs.where(~langid.held_out()))
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


def op7_bpe_segment_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.encode_digest(_table(spark, sf_dir, "documents"), TOKENIZER)


def op8_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER)


def op9_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fuzzy_lines.dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op11_piece_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_rounds.piece_digest(_table(spark, sf_dir, "documents"), PIECES)


def op12_diagonal_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_links.align_corpus(_table(spark, sf_dir, "documents"), BYTES, PIECES)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_perspective_rotation, op2_suffix_dedup, op3_additive_quantisation, op4_rare_feature_digest, op5_log_frequency_bloom_lm, op6_language_spans, op7_bpe_segment_tree, op8_cost_balanced_packing, op9_simhash_trie, op10_fuzzy_lines, op11_piece_rounds, op12_diagonal_alignment, op13_prefix_trie)}


def oracle_sql() -> dict[str, str]:
    return {"op1_perspective_rotation": chat.ORACLE_SQL, "op13_prefix_trie": prefix_trie.ORACLE_SQL}
