"""From raw documents to token ids: language, lines, near-duplicates, benchmarks, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from headrace.llm import bpe, contamination, frames, language, line_dedup, simhash

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a known language go."""
    return language.accepted(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines like earlier ones go, and documents that lose all their lines."""
    return line_dedup.clean(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return contamination.clean(docs, frames.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of what is left, with digests of ids and decoded text."""
    return bpe.digests(docs, WORD_BPE, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("decontamination", decontaminate),
    ("bpe", encode),
]

# Kernel machines, 64-bit word values and BPE are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is stored and read by the next."""
    docs = frames.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = frames.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
