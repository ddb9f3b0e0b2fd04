from __future__ import annotations

import random
import re

import edge
import pytest

from headrace.llm import frames, queries, substring_dedup

SMALL = "/root/testdata/sf0.001"
N = substring_dedup.UNIT_WORDS


def units(text: str, line_words: int):
    found = list(re.finditer(r"[^\x20\x09-\x0D]+", text))
    lowered = [edge.lower(m.group()) for m in found]
    places = {(i, i + N) for i in range(len(found) - N + 1)}
    at = 0
    for line in text.split("\n"):
        n = len(edge.spaced(line))
        if n >= line_words:
            places.add((at, at + n))
        at += n
    return [(a, b, tuple(lowered[a:b]), found[a].start(), found[b - 1].end()) for a, b in sorted(places)]


def brute(texts, line_words=1):
    """Merged spans that are removed, for documents with ids of their own."""
    keeper, out = {}, []
    for i, text in sorted(texts, key=lambda t: (t[0] is None, t[0] or 0)):
        here, cut = {}, []
        for a, b, key, low, high in units(text or "", line_words):
            if key in here and a < here[key]:
                continue
            if key in here or keeper.setdefault(key, i) != i:
                cut.append((low, high))
            here.setdefault(key, b)
        merged = []
        for low, high in sorted(cut):
            if merged and low <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], high)
            else:
                merged.append([low, high])
        out += [(i, *m) for m in merged]
    return sorted(out, key=repr)


def check(frame, texts, line_words=1):
    got = [(r["doc_id"], r["from"], r["until"]) for r in substring_dedup.spans(frame, line_words).collect()]
    assert sorted(got, key=repr) == brute(texts, line_words)
    return got


@pytest.mark.parametrize("line_words", [1, N])
def test_small_table(spark, line_words):
    documents = frames.table(spark, SMALL, "documents")
    assert check(documents, [(r["doc_id"], r["text"]) for r in documents.collect()], line_words)


def test_passages_inside_lines_are_cut_and_offsets_are_those_of_the_text(spark, docs):
    draw = random.Random(7)
    fresh = lambda n: " ".join(f"w{draw.randrange(10**9)}" for _ in range(n))
    passages = [fresh(55) for _ in range(20)]
    texts = [f"é {fresh(9)} {p} {fresh(5)}\n{fresh(30)}" for p in passages]
    texts += [f"ü{fresh(3)}\n{fresh(4)} {p.upper()} {fresh(2)}" for p in passages]
    texts += [fresh(100) for _ in range(20)]
    frame = docs(*texts)
    found = check(frame, list(enumerate(texts)), N)
    assert {i for i, _, _ in found} == set(range(20, 40))
    for i, low, high in found:
        assert texts[i][low:high].lower() in passages[i - 20]
    assert sum(high - low for _, low, high in found) > 0.6 * sum(map(len, passages))
    kept = {r["doc_id"]: r["text"] for r in substring_dedup.clean(frame, N).collect()}
    for i, text in enumerate(texts):
        for _, low, high in sorted((f for f in found if f[0] == i), reverse=True):
            text = text[:low] + text[high:]
        assert kept[i] == text


def test_edges(spark, edges, empty):
    texts = [t for k, t in enumerate(edge.TEXTS) if t[0] != 4 or edge.TEXTS[k - 1][0] != 4]
    got = {(r["doc_id"], r["from"], r["until"]) for r in substring_dedup.spans(edges).collect()}
    assert got == set(brute(texts))
    assert {4, 5, 6, 11} <= {i for i, _, _ in got}
    kept = substring_dedup.clean(edges)
    assert kept.columns == edges.columns and kept.count() == len(edge.TEXTS)
    assert {r["text"] for r in kept.where("doc_id = 4").collect()} == {""}
    assert kept.where("doc_id = 1 and text is null").count() == 1
    assert substring_dedup.spans(empty).count() == substring_dedup.clean(empty).count() == 0


def test_every_repeated_passage_is_cut_whole(spark, docs):
    """Also passages of few distinct words, down to the length of a unit, at their exact ends."""
    draw = random.Random(8)
    fresh = lambda n: " ".join(f"w{draw.randrange(10**9)}" for _ in range(n))
    passages = [fresh(n) for n in (16, 17, 20, 30) for _ in range(10)]
    passages += [" ".join(draw.choice([f"{k}a", f"{k}b", f"{k}c"]) for _ in range(40)) for k in range(10)]
    texts = [f"{fresh(5)} {p} {fresh(5)}" for p in passages] + [f"{fresh(7)} {p} {fresh(3)}" for p in passages]
    n = len(passages)
    got = [(r["doc_id"], r["from"], r["until"]) for r in substring_dedup.spans(docs(*texts)).collect()]
    want = [(n + i, at, at + len(p)) for i, p in enumerate(passages) for at in [texts[n + i].index(p)]]
    assert sorted(g for g in got if g[0] >= n) == want


def test_short_lines_are_units_of_the_query(spark, tmp_path):
    texts = ["a title\nfirst text", "other\nA  Title", "x\n\nother\nend"]
    path = tmp_path.as_uri()
    spark.createDataFrame(edge.rows(list(enumerate(texts))), edge.SCHEMA).write.parquet(f"{path}/documents.parquet")
    got = queries.all_queries()["op1_substring_dedup"](spark, path).collect()
    assert sorted((r["doc_id"], r["from"], r["until"], r["kept_doc_id"]) for r in got) == [(1, 6, 14, 0), (2, 3, 8, 1)]


def test_texts_that_share_an_id_or_have_none_are_documents_of_their_own(spark):
    draw = random.Random(9)
    fresh = lambda n: " ".join(f"w{draw.randrange(10**9)}" for _ in range(n))
    one, two = fresh(30), fresh(30)
    texts = [(None, f"{fresh(k)} {one} {fresh(3)}") for k in (1, 5, 9)] + [(None, fresh(60))]
    texts += [(7, f"{fresh(2)} {two}"), (7, f"{fresh(6)} {two} {fresh(40)}")]
    frame = spark.createDataFrame(edge.rows(texts), edge.SCHEMA)
    kept = [r["text"] for r in substring_dedup.clean(frame).collect()]
    assert sum(one in t for t in kept) == sum(two in t for t in kept) == 1
    cut = {t for _, t in texts} | {t.replace(p, "") for _, t in texts for p in (one, two)}
    assert len(kept) == len(texts) and set(kept) <= cut
    spans = substring_dedup.spans(frame).collect()
    assert len(spans) == 3 and len({r["text_hash"] for r in spans}) == 3
