"""The pipeline's stages over a small table, each judged on its own input."""

from __future__ import annotations

import edge
from test_contamination import brute as contaminated
from test_line_dedup import brute as removed_lines
from test_simhash import plain, roots

import __spark_entry__ as entry
import corpus_pipeline
from headrace.llm import frames, simhash

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = frames.table(spark, SMALL, "documents")
    columns, held = docs.dtypes, {}
    items = [tuple(r) for r in frames.table(spark, SMALL, "benchmark").select("item_id", "text").collect()]
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = frames.stored(stage(spark, docs, SMALL), f"test-{name}")
        if name == "bpe":
            break
        assert docs.dtypes == columns
        after = held[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "language_id":
            assert after == {i: t for i, t in before.items() if any(c.isalpha() for c in t or "")}
        if name == "line_dedup":
            gone = removed_lines(list(before.items()))
            want = {}
            for i, text in before.items():
                lines = [s for k, s in enumerate(text.split("\n")) if k not in gone[i]]
                if any(edge.spaced(s) for s in lines):
                    want[i] = "\n".join(lines)
            assert after == want
        if name == "simhash_near_dedup":
            ids = sorted(before)
            root = roots([plain(before[i]) for i in ids])
            assert sorted(after) == [i for k, i in enumerate(ids) if root[k] == k]
        if name == "decontamination":
            bad = {r[0] for r in contaminated(list(before.items()), items) if r[5]}
            assert set(after) == set(before) - bad and bad
        before = after
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} == set(before)


def test_run_is_registered(spark):
    assert entry.queries()["pipeline"](spark, SMALL).columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sum(n.startswith("op") for n in entry.queries()) == 13


def test_edges(spark, edges, empty, tmp_path):
    """Every stage takes whatever the edge documents hold, and nothing at all."""
    benchmark = spark.createDataFrame([(1, edge.PROSE)], "item_id long, text string")
    folder = tmp_path.as_uri()
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    for given in (edges, empty):
        docs = given
        for name, stage in corpus_pipeline.STAGES:
            docs = frames.stored(stage(spark, docs, folder), f"test-{name}")
            assert name == "bpe" or docs.columns == given.columns
        docs.count()


def test_near_duplicates_broadcast_no_keys(spark, monkeypatch):
    """The join of the keys, of which a document has a hundred, is a shuffled one in the pipeline too."""
    plans, components = [], simhash.components

    def seen(edges, *given):
        plans.append(edges._jdf.queryExecution().executedPlan().toString())
        return components(edges, *given)

    monkeypatch.setattr(simhash, "components", seen)
    docs = frames.table(spark, SMALL, "documents")
    assert corpus_pipeline.dedup_documents(spark, docs, SMALL).columns == docs.columns
    assert plans and all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)
