from __future__ import annotations

import hashlib
import random

import edge
import pytest
from compare import expected, normal

from headrace.llm import contamination, oracles, queries

SMALL = "/root/testdata/sf0.001"


def brute(texts, items):
    out = []
    for i, text in texts:
        w = edge.alnum(text)
        hit, found = set(), set()
        for item, t in items:
            b = edge.alnum(t)
            n = min(13, len(b))
            windows = {tuple(b[k : k + n]) for k in range(len(b) - n + 1)} if n else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.fixture
def cases():
    draw = random.Random(5)
    vocabulary = ["ab", "cd", "ef", "gh"]
    texts = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 60)))) for i in range(80)]
    items = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 20)))) for i in range(12)]
    items += [(3, "AB-cd"), (None, texts[7][1]), (99, None), (98, "..."), (97, " ".join(w for _, t in texts[:4] for w in t.split()))]
    return texts + edge.TEXTS + [(300, "Pre " + edge.PROSE + " post")], items + [(96, edge.PROSE.upper())]


def test_against_brute_force(spark, cases):
    texts, items = cases
    frame = spark.createDataFrame(edge.rows(texts), edge.SCHEMA)
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, row int")
    want = brute(texts, items)
    assert sorted((tuple(r) for r in contamination.report(frame, benchmark).collect()), key=repr) == want
    bad = {(w[0], w[1]) for w in want if w[5]}
    cleaned = contamination.clean(frame, benchmark)
    assert cleaned.columns == frame.columns
    assert cleaned.count() == sum(not w[5] for w in want) and bad


def test_blocks_of_the_benchmark_give_the_same(spark, cases, monkeypatch):
    texts, items = cases
    frame = spark.createDataFrame(edge.rows(texts), edge.SCHEMA)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(contamination, "BLOCK_BYTES", 400)
    assert sorted((tuple(r) for r in contamination.report(frame, benchmark).collect()), key=repr) == brute(texts, items)


def test_longest_matches(spark, docs):
    item = [f"i{k}" for k in range(40)]
    text = ["x"] * 5 + item[3:33] + ["y"] * 4 + item[20:40]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id int, text string")
    got = {tuple(r) for r in contamination.matches(docs(" ".join(text)), benchmark).collect()}
    assert got == {(0, "1", 5, 3, 30), (0, "1", 39, 20, 20)}


def test_empty(spark, edges, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination.report(empty, none).count() == 0
    rows = contamination.report(edges, none).collect()
    assert len(rows) == len(edge.TEXTS) and not any(r["contaminated"] or r["n_hit"] for r in rows)


def test_query(spark):
    got = queries.all_queries()["op4_contamination"](spark, SMALL)
    names, rows = expected(SMALL, oracles.all_oracles()["op4_contamination"])
    assert normal(got.columns, [tuple(r) for r in got.collect()]) == normal(names, rows)
