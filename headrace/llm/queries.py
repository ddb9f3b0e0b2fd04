"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from headrace import session
from headrace.llm import (
    alignment, bpe, centroids, contamination, frames, language, licenses, line_dedup, quality, simhash,
    substring_dedup, suffix_dedup, token_blocks, token_counts,
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


@query
def op2_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session.fresh_dir(spark, "llm-token-blocks")
    token_blocks.write(frames.table(spark, sf_dir, "documents"), path, WORD_BPE)
    return token_blocks.digests(spark, path)


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(frames.table(spark, sf_dir, "documents"), WORD_BPE)


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(frames.table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.rate(frames.table(spark, sf_dir, "documents"))
    return rated.drop("votes")


@query
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(frames.table(spark, sf_dir, "documents"))


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.classify(frames.table(spark, sf_dir, "documents"))


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(frames.table(spark, sf_dir, "documents"))


@query
def op4_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = frames.table(spark, sf_dir, "documents")
    return contamination.report(documents, frames.table(spark, sf_dir, "benchmark"))


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.spans(frames.table(spark, sf_dir, "documents"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(frames.table(spark, sf_dir, "documents"))


@query
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(frames.table(spark, sf_dir, "embeddings"))


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(frames.table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


@query
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(frames.table(spark, sf_dir, "documents"))
