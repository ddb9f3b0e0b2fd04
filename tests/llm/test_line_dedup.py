from __future__ import annotations

import random
from collections import Counter, defaultdict

import edge
import pytest
from pyspark.sql import functions as F

from headrace.llm import frames, line_dedup

SMALL = "/root/testdata/sf0.001"


def _sets(texts):
    """Word sets of the lines of each document, in order of doc_id (null last)."""
    for i, text in sorted(texts, key=lambda t: (t[0] is None, t[0] or 0)):
        lines = enumerate((text or "").split("\n"))
        yield i, [(k, w) for k, line in lines if (w := frozenset(edge.spaced(edge.lower(line))))]


def brute(texts):
    """Numbers of removed lines of each document, in order of doc_id (null last)."""
    seen, sets, holding, out = set(), [], defaultdict(list), {}
    for i, lines in _sets(texts):
        gone = []
        for k, words in lines:
            shared = Counter(j for w in words for j in holding[w])
            if words in seen or any(9 * n >= 4 * (len(words) + len(sets[j])) for j, n in shared.items()):
                gone.append(k)
            if words not in seen:
                seen.add(words)
                for w in words:
                    holding[w].append(len(sets))
                sets.append(words)
        out[i] = gone
    return out


def brute_links(texts):
    """For each document the first place of each different line and its number of links."""
    found = list(_sets(texts))
    holding, links = defaultdict(set), {}
    for words in {w for _, lines in found for _, w in lines}:
        shared = Counter(other for w in words for other in holding[w])
        alike = [o for o, n in shared.items() if 9 * n >= 4 * (len(words) + len(o))]
        links[words] = len(alike)
        for o in alike:
            links[o] += 1
        for w in words:
            holding[w].add(words)
    out = {}
    for i, lines in found:
        first = {}
        for k, words in lines:
            first.setdefault(words, k)
        out[i] = sorted((k, links[w]) for w, k in first.items())
    return out, links


def check(frame, texts):
    rows = line_dedup.report(frame).collect()
    got = {r["doc_id"]: list(r["removed_lines"]) for r in rows}
    assert got == brute(texts)
    linked, links = brute_links(texts)
    assert {r["doc_id"]: [(c["line"], c["links"]) for c in r["classes"]] for r in rows} == linked
    assert all(r["n_links"] == sum(c["links"] for c in r["classes"]) for r in rows)
    assert len({c["class"] for r in rows for c in r["classes"]}) == len(links)
    return got


@pytest.fixture
def alike():
    draw = random.Random(2)
    rare = [f"w{i}" for i in range(300)]
    base = [draw.sample(rare, draw.randint(1, 30)) for _ in range(60)]
    base += [draw.sample(rare, draw.randint(90, 250)) for _ in range(6)]
    texts: list[tuple[int, str]] = []
    for i in range(60):
        lines = []
        for _ in range(draw.randint(0, 8)):
            line = list(draw.choice(base))
            for _ in range(draw.randint(0, 4)):
                line[draw.randrange(len(line))] = draw.choice(rare)
            lines.append(" ".join(line))
        texts.append((i, "\n".join(lines)))
    return texts


def test_against_brute_force(spark, alike):
    frame = spark.createDataFrame(edge.rows(alike), edge.SCHEMA)
    got = check(frame, alike)
    kept = line_dedup.clean(frame)
    assert kept.columns == frame.columns
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    for i, text in alike:
        lines = [s for k, s in enumerate(text.split("\n")) if k not in got[i]]
        if text and not any(edge.spaced(s) for s in lines):
            assert i not in texts
        else:
            assert texts[i] == "\n".join(lines)


@pytest.mark.parametrize(("block", "held", "compared"), [(4, 1 << 18, 1 << 20), (1, 8, 3), (1 << 16, 1, 1)])
def test_split_words_lose_no_pair(spark, alike, monkeypatch, block, held, compared):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    monkeypatch.setattr(line_dedup, "HELD_ROWS", held)
    monkeypatch.setattr(line_dedup, "COMPARED", compared)
    check(spark.createDataFrame(edge.rows(alike), edge.SCHEMA), alike)


def test_many_partners_of_one_line(spark):
    """Some thousand links at a few words: every one is found, with its earlier line first."""
    base = [f"w{k}" for k in range(20)]
    texts = [(i, " ".join([*base, f"own{i}"])) for i in range(60)]
    frame = spark.createDataFrame(edge.rows(texts), edge.SCHEMA)
    check(frame, texts)
    pairs = {(r["line_a"]["doc_id"], r["line_b"]["doc_id"]) for r in line_dedup.links(frame).collect()}
    assert pairs == {(i, j) for j in range(60) for i in range(j)}


def test_documents_without_an_id_or_of_one_id(spark):
    """They differ by their texts; rows equal in both are copies of one document."""
    line = "the very same line of seven words"
    texts = [(None, f"{line}\nnumber {k} alone") for k in "abc"] + [(None, f"{line}\nnumber a alone")]
    frame = spark.createDataFrame(edge.rows(texts), edge.SCHEMA)
    rows = line_dedup.report(frame).collect()
    assert sorted(r["n_removed"] for r in rows) == [0, 1, 1]
    kept = [r["text"] for r in line_dedup.clean(frame).collect()]
    assert len(kept) == 4 and sum(line in text for text in kept) in (1, 2)
    assert len({text for text in kept if line in text}) == 1
    texts = [(1, "a b c d e f"), (1, "a b c d e f\nand more of it")]
    frame = spark.createDataFrame(edge.rows(texts), edge.SCHEMA)
    assert sum(r["n_removed"] for r in line_dedup.report(frame).collect()) == 1


def test_shuffled_join_of_wanted_lines(spark, alike, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    check(spark.createDataFrame(edge.rows(alike), edge.SCHEMA), alike)


def test_small_table(spark):
    documents = frames.table(spark, SMALL, "documents")
    check(documents, [(r["doc_id"], r["text"]) for r in documents.collect()])


def test_edges(spark, edges, empty):
    texts = [t for k, t in enumerate(edge.TEXTS) if t[0] != 4 or edge.TEXTS[k - 1][0] != 4]
    got = {r["doc_id"]: r for r in line_dedup.report(edges).collect()}
    want = brute(texts)
    assert {i: sorted(set(r["removed_lines"])) for i, r in got.items()} == want
    assert got[1]["n_lines"] == got[0]["n_lines"] == 0 and got[10]["n_removed"] == 10
    kept = edge.by_id(line_dedup.clean(edges))
    assert 4 not in kept and kept[1][0]["text"] is None and kept[0][0]["text"] == ""
    assert line_dedup.report(empty).count() == line_dedup.clean(empty).count() == 0


def _families():
    """Two families of near copies, one of them with a part of its own, and lines at their edges."""
    draw = random.Random(3)
    pool = [f"w{i}" for i in range(400)]
    base = draw.sample(pool, 40)
    other = base[:32] + draw.sample(pool, 8)
    texts = []
    for i in range(260):
        line = list(base if i % 3 else other)
        for _ in range(draw.choice([0, 1, 2, 3, 4, 5, 8])):
            line[draw.randrange(len(line))] = draw.choice([*pool, f"own{i}"])
        texts.append((i, " ".join(line)))
    return texts


@pytest.mark.parametrize(("family", "block"), [(32, 1 << 16), (2, 1 << 16), (4, 16)])
def test_families_of_near_copies(spark, monkeypatch, family, block):
    monkeypatch.setattr(line_dedup, "FAMILY", family)
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    texts = _families()
    frame = spark.createDataFrame(edge.rows(texts), edge.SCHEMA)
    check(frame, texts)
    pairs = [(r["line_a"]["doc_id"], r["line_b"]["doc_id"]) for r in line_dedup.links(frame).collect()]
    links = sum(brute_links(texts)[1].values()) // 2
    assert len(pairs) == len(set(pairs)) == links and all(a < b for a, b in pairs)


def test_links_of_near_copies_are_not_made_one_by_one(spark):
    """Five times the copies make no more than some ten times the rows of links."""
    found = []
    for n in (100, 500):
        texts = [(i, " ".join([*(f"w{k}" for k in range(30)), f"own{i}"])) for i in range(n)]
        frame = spark.createDataFrame(edge.rows(texts), edge.SCHEMA)
        with frames.scratch(spark) as store:
            found.append(line_dedup._found(frame, store)[2].count())
        rows = line_dedup.report(frame).collect()
        assert {r["n_links"] for r in rows} == {n - 1} and sum(r["n_removed"] for r in rows) == n - 1
    assert found[0] < 100 and found[1] < 10 * max(found[0], 50)
