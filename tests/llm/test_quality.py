from __future__ import annotations

import math
from collections import Counter

import edge
import pytest

from headrace.llm import frames, quality

SMALL = "/root/testdata/sf0.01"


def brute(text: str | None):
    words = edge.spaced(text)
    lines = [s for s in (text or "").split("\n") if edge.spaced(s)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text or ""),
        len(lines) - len(set(lines)), len(covered),
    )


def check(frame, texts):
    rows = quality.rate(frame).collect()
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = sorted((tuple(r[n] for n in names) for r in rows), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t in texts), key=repr)
    for r in rows:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["posterior"] >= 0.5)
    return rows


def estimate(patterns: list[tuple[list[int], float]]) -> list[float]:
    """The same estimation in plain Python."""
    k = len(quality.RULES)
    prior, good, bad = quality.PRIOR, [quality.RIGHT_ON_GOOD] * k, [quality.RIGHT_ON_BAD] * k

    def share(votes):
        odds = math.log(prior / (1 - prior))
        for j, v in enumerate(votes):
            odds += math.log(good[j] / (1 - bad[j])) if v == 1 else math.log((1 - good[j]) / bad[j]) if v == 0 else 0
        return 1 / (1 + math.exp(-odds))

    for _ in range(quality.ROUNDS):
        q, s = [share(v) for v, _ in patterns], quality.SMOOTHING

        def right(vote, weight):
            return [
                (s / 2 + sum(n * w for (v, n), w in zip(patterns, weight) if v[j] == vote))
                / (s + sum(n * w for (v, n), w in zip(patterns, weight) if v[j] >= 0))
                for j in range(k)
            ]

        good, bad, prior = (
            right(1, q), right(0, [1 - x for x in q]),
            (s / 2 + sum(n * x for (_, n), x in zip(patterns, q))) / (s + sum(n for _, n in patterns)),
        )
    return [share(v) for v, _ in patterns]


def test_small_table(spark):
    documents = frames.table(spark, SMALL, "documents")
    rows = check(documents, [(r["doc_id"], r["text"]) for r in documents.collect()])
    patterns = [(list(v), float(n)) for v, n in sorted(Counter(tuple(r["votes"]) for r in rows).items())]
    want = {tuple(v): p for (v, _), p in zip(patterns, estimate(patterns))}
    assert all(r["posterior"] == pytest.approx(want[tuple(r["votes"])], rel=1e-6, abs=1e-12) for r in rows)


def test_clean_documents_stay_and_junk_goes(spark):
    documents, labels = (frames.table(spark, SMALL, n) for n in ("documents", "labels"))
    got = quality.rate(documents).join(labels.select("doc_id", "quality"), "doc_id").where("not base_failed").collect()
    clean, junk = ([r for r in got if r["quality"] == q] for q in (1, 0))
    assert sum(r["kept"] for r in clean) >= 0.98 * len(clean)
    assert sum(not r["kept"] for r in junk) >= 0.9 * len(junk)


def test_edges(spark, edges, empty):
    rows = check(edges, edge.TEXTS)
    assert [set(r["votes"]) for r in rows if r["n_words"] == 0] == [{-1}] * 3
    assert quality.rate(empty).count() == 0
