from __future__ import annotations

import random
import textwrap

import edge
from compare import expected, normal

from headrace.llm import licenses, oracles, queries

SMALL = "/root/testdata/sf0.001"


def brute(text: str | None):
    words = edge.alnum(text)
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    added, share = set(), 0.0
    lines = (text or "").split("\n")
    for k in range(len(lines)):
        block = set(edge.alnum("\n".join(lines[k : k + licenses.WRAPPED])))
        for label, notice in licenses.NOTICES.items():
            want = set(notice.split())
            if 100 * len(want & block) >= licenses.PERCENT * len(want):
                added.add(label)
                share = max(share, len(want & block) / len(want))
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | added)), 1.0 if places else share,
    )


def check(frame, texts):
    got = sorted((tuple(r) for r in licenses.scan(frame).collect()), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t in texts), key=repr)
    return got


def test_notices_with_words_missing_and_added(spark, docs):
    draw = random.Random(4)
    texts = ["cc by cc by", "CC-BY", "cc by general public license all rights reserved cc", "rights reserved all"]
    for notice in licenses.NOTICES.values():
        for drop in (0, 1, 2):
            words = notice.split()
            for _ in range(drop):
                words.pop(draw.randrange(len(words)))
            words += ["Filler"] * draw.randint(0, 5)
            draw.shuffle(words)
            texts.append("before\n" + " - ".join(words).upper() + "\nthe the of and")
    got = check(docs(*texts), list(enumerate(texts)))
    assert sum(r[6] != r[5] for r in got) >= 10


def test_notices_as_they_are_written(spark, docs):
    """Wrapped at several widths, commented, begun in the middle of a line."""
    texts, labels = [], []
    for label, notice in licenses.NOTICES.items():
        for width in (50, 72, 100):
            for mark in ("# ", " * ", ""):
                lines = textwrap.wrap("Copyright 2020 The Authors. " + notice.capitalize() + ". More text.", width)
                texts.append("\n".join(["import os", "", *(mark + line for line in lines), "", "x = 1"]))
                labels.append(label)
    texts.append("\n".join([*licenses.NOTICES["bsd"].split()[:7], *["x"] * 4, *licenses.NOTICES["bsd"].split()[7:]]))
    got = check(docs(*texts), list(enumerate(texts)))
    by_id = {r[0]: r[6].split(",") for r in got}
    assert all(label in by_id[k] for k, label in enumerate(labels)) and by_id[len(labels)] == [""]


def test_edges(spark, edges, empty):
    check(edges, edge.TEXTS)
    assert licenses.scan(empty).count() == 0


def test_query(spark):
    got = queries.all_queries()["op7_licenses"](spark, SMALL)
    names, rows = expected(SMALL, oracles.all_oracles()["op7_licenses"])
    assert normal(got.columns, [tuple(r) for r in got.collect()]) == normal(names, rows)
