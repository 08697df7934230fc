"""Corpus cleaning pipeline: language ID, line dedup, near-dedup, repeated passages, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import fuzzy_lines, langid, packing, simhash_trie, suffix_dedup
from panelforge.llm.scratch import discard, materialize_alone

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the model learns from all labelled ones."""
    return langid.keep_identified(docs, docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that near-equal earlier ones."""
    return _as_documents(fuzzy_lines.dedup_lines(docs), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate group."""
    return simhash_trie.keep_one(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat."""
    return _as_documents(suffix_dedup.dedup_passages(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of the kept texts."""
    return packing.pack(docs, TOKENIZER)


def _as_documents(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with n_chars, where there is one, counted anew."""
    out = changed.select(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", passage_dedup),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next; a stage's own tables go with it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        kept = materialize_alone(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL expresses neither the language model nor the packing; the tests compare each stage with brute force.
ORACLE_SQL = None
