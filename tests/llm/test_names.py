"""Columns of odd names, and several rows without an id, pass every operator that keeps rows."""

from __future__ import annotations

import edge
import public_tokenizers
import pytest

import corpus_pipeline
from headrace.llm import bpe, contamination, frames, language, line_dedup, simhash, substring_dedup, suffix_dedup

SCHEMA = "doc_id long, text string, lang string, `my col` int, `a-b` string, `_row` int, `decoded` string"
TEXTS = [
    (1, edge.PROSE), (2, "another short text of its own"), (None, "first text without any id at all"),
    (None, "second text, it has no id either"), (None, "third one of these texts without id"), (3, None), (4, ""),
]


@pytest.fixture
def odd(spark):
    rows = [(i, t, "en", k, "x", k, "d") for k, (i, t) in enumerate(TEXTS)]
    return frames.tune(spark).createDataFrame(rows, SCHEMA)


def known(frame):
    return sorted((r["my col"], r["a-b"], r["_row"]) for r in frame.collect())


ALL = [(k, "x", k) for k in range(len(TEXTS))]


@pytest.mark.parametrize("operator", [substring_dedup.clean, line_dedup.clean, simhash.representatives])
def test_cleaning_keeps_them(odd, operator):
    kept = operator(odd)
    assert kept.columns == odd.columns and set(known(kept)) <= set(ALL)
    assert {0, 1, 2, 3, 4} <= {k for k, _, _ in known(kept)}


def test_the_others_keep_them(spark, odd):
    benchmark = spark.createDataFrame([("i", "words that stand in no text")], "item_id string, text string")
    clean = contamination.clean(odd, benchmark)
    assert clean.columns == odd.columns and known(clean) == ALL
    assert set(known(language.accepted(odd))) <= set(ALL)
    assert known(suffix_dedup.kept(odd)) == ALL


def test_decoding_keeps_them(odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = odd.join(bpe.encode(odd.where("doc_id is not null"), path).select("doc_id", "ids"), "doc_id", "left")
    out = bpe.decode(encoded, path)
    assert out.columns == [c for c in encoded.columns if c != "decoded"] + ["decoded"] and known(out) == ALL
    assert {r["decoded"] for r in out.where("doc_id = 2").collect()} == {"another</w> short</w> text</w> of</w> its</w> own</w>"}


def test_pipeline_stages_keep_them(spark, odd, tmp_path):
    spark.createDataFrame([("i", "words that stand in no text")], "item_id string, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.columns == odd.columns
