from __future__ import annotations

import zlib

import edge
import numpy as np

from headrace.llm import frames, language

SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    documents = frames.table(spark, SMALL, "documents")
    got = language.classify(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == documents.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_kernel_counts_shared_runs():
    a, b = language.present("abc abd"), language.present("ABC!")
    plain = {x for n in (1, 2, 3) for x in ("abc abd"[i : i + n] for i in range(8 - n)) if x.strip()}
    assert len(a) == len(plain)
    shared = {"a", "b", "c", "ab", "bc", "abc", "c ", "bc "}  # the sign counts as a space
    assert np.isclose(language._kernel([a], [b])[0, 0], len(shared) / np.sqrt(len(a) * len(b)))


def test_batched_products_give_the_ridge_machines():
    draw = np.random.default_rng(3)
    texts = [("a", "".join(draw.choice(list("abc "), 40))) for _ in range(20)]
    texts += [("b", "".join(draw.choice(list("xyz "), 40))) for _ in range(20)]
    model = language.fit_sample([(lang, language.present(t)) for lang, t in texts])
    for lang, letters in (("a", "cab bca"), ("b", "zyx xzy")):
        values = model.values([language.present(letters)])[0]
        assert model.languages[int(values.argmax())] == lang


def test_edges(spark, edges, empty):
    got = edge.by_id(language.classify(edges))
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for rows in got.values() for r in rows)  # no label
    labelled = [(100 + i, edge.PROSE[i:], "en") for i in range(9)] + [(200 + i, "der die das und nicht " * 3, "de") for i in range(9)]
    rows = edge.rows(edge.TEXTS) + [r for i, t, lang in labelled for r in edge.rows([(i, t)], lang)]
    frame = spark.createDataFrame(rows, edge.SCHEMA)
    got = edge.by_id(language.classify(frame))
    assert sum(map(len, got.values())) == len(rows)
    assert [got[i][0]["lang_pred"] for i in (0, 1, 2, 7)] == ["und"] * 4
    assert {r["lang_pred"] for r in got[4]} == {"en"} and len(got[4]) == 2
    assert got[None][0]["lang_pred"] == "en" and got[None][0]["held_out"] is False
    kept = language.accepted(frame)
    assert kept.columns == frame.columns
    assert {0, 1, 2, 7}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert language.classify(empty).count() == 0
