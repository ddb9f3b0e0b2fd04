from __future__ import annotations

import hashlib
import random

import edge
import numpy as np
import pytest

from headrace import session
from headrace.llm import frames, runindex, suffix_dedup

SMALL = "/root/testdata/sf0.001"
L = suffix_dedup.LENGTH
NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def brute(texts):
    first: dict[bytes, int] = {}
    for i, text in texts:
        raw = (text or "").encode()
        for k in range(len(raw) - L + 1 if i is not None else 0):
            first[raw[k : k + L]] = min(first.get(raw[k : k + L], i), i)
    out = []
    for i, text in texts:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 2, np.int8)
        for k in range(len(raw) - L + 1 if i is not None else 0):
            if first[raw[k : k + L]] < i:
                gone[k + 1 : k + 1 + L] = 1
        left = bytes(b for b, g in zip(raw, gone[1:-1]) if not g)
        out.append((i, len(raw), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def check(frame, texts):
    found = suffix_dedup.report(frame)
    assert found.columns == NAMES
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == brute(texts)
    return got


def test_small_table(spark):
    documents = frames.table(spark, SMALL, "documents")
    got = check(documents, [(r["doc_id"], r["text"]) for r in documents.collect()])
    assert sum(r[2] for r in got) > 0


@pytest.fixture(scope="module")
def repetitive():
    """Texts of few passages, cut and edited, so that most strings stand in several documents."""
    draw = random.Random(7)
    passages = ["".join(draw.choices("abcdefgh \né", k=draw.randint(20, 300))) for _ in range(12)]
    texts: list[tuple[int | None, str]] = []
    for i in range(120):
        parts = []
        for _ in range(draw.randint(0, 5)):
            p = draw.choice(passages)
            low = draw.randint(0, len(p) // 2)
            p = p[low : low + draw.randint(0, len(p))]
            if p and draw.random() < 0.4:
                k = draw.randrange(len(p))
                p = p[:k] + draw.choice("xyz\x00") + p[k + draw.randint(0, 1) :]
            parts.append(p)
        texts.append((draw.choice([i, i, i, i // 2, None]), "".join(parts)))
    return texts


def test_repetitive(spark, repetitive):
    check(frames.tune(spark).createDataFrame(edge.rows(repetitive), edge.SCHEMA).repartition(5), repetitive)


def test_hot_values_take_another_way(spark, repetitive):
    frame = frames.tune(spark).createDataFrame(edge.rows(repetitive), edge.SCHEMA)
    both = [
        sorted(((r[0], r[1], [tuple(s) for s in r[2]]) for r in suffix_dedup.spans(frame, hot).collect()))
        for hot in (0, 1 << 30)
    ]
    assert both[0] == both[1] and both[0]


def test_bytes_are_gone_before_the_last_shuffles(spark, repetitive, monkeypatch):
    frame = frames.tune(spark).createDataFrame(edge.rows(repetitive), edge.SCHEMA)
    root, cuts, seen = f"{session.shared_root(spark)}/headrace", suffix_dedup._cuts, []
    before = set(session.names(spark, root))

    def last(places, known):
        seen.extend(set(session.names(spark, root)) - before)
        assert known.where("first is null").isEmpty()
        return cuts(places, known)

    monkeypatch.setattr(suffix_dedup, "_cuts", last)
    assert suffix_dedup.spans(frame).count()
    assert sorted(name.rpartition("-")[0] for name in seen) == ["llm-segments", "llm-streamed"]


def test_strings_of_hot_values_are_shuffled_once(spark):
    """And without their bytes; a second shuffle brings the strings of a segment together."""
    row = (1, 2, 3, b"x" * (L + 5))
    variants = spark.createDataFrame([row, (1, 4, 5, b"y" + b"x" * L)], suffix_dedup.BYTES).repartition(3)
    found = suffix_dedup._by_strings(variants)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan
    got = {(r["value"], r["segment"]): [tuple(x) for x in r["runs"]] for r in found.collect()}
    assert got == {(1, 4): [(1, 2)]}
    text = found._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in text.split("== Initial Plan ==")[0].split("\n") if "Exchange hashpartitioning" in line]
    assert len(moved) == 2


def test_edges(edges, empty):
    check(edges, edge.TEXTS)
    found = {r["doc_id"]: r for r in suffix_dedup.kept(edges).collect() if r["doc_id"] not in (4, None)}
    assert found[1]["kept_bytes"] is None and found[0]["kept_bytes"] == b"" and found[3]["kept_bytes"] == edge.PROSE.encode()
    assert suffix_dedup.kept(edges).columns == [*edges.columns, "kept_bytes"]
    assert suffix_dedup.kept(empty).count() == suffix_dedup.report(empty).count() == 0


def test_borders(docs):
    unit = "".join(chr(97 + k % 23) + str(k) for k in range(40))
    texts = [unit[: L - 1], unit[: L - 1] + "!", unit[:L], "?" + unit[:L] + "?", unit[1 : L + 1], unit[:L] * 2, "é" * 30, "xé" + "é" * 30]
    check(docs(*texts), list(enumerate(texts)))


def test_text_of_a_short_period(docs):
    """One gram repeats without end, so strings of one value are more than a range holds."""
    draw = random.Random(11)
    units = ["x", "ab", "=" * 7 + "\n", "é ", *("".join(draw.choices("abcdefgh", k=k)) for k in (24, 26, 27, 28, 49, 51))]
    texts = ["x" * 1000, "x" * 1000, "x" * 400, "ab" * 300, "q" + "ab" * 200]
    texts += ["".join(draw.choice(units) * draw.randint(1, 40) for _ in range(3)) for _ in range(30)]
    check(docs(*texts), list(enumerate(texts)))


def test_odd_names(spark):
    frame = frames.tune(spark).createDataFrame(
        [(1, "x" * 60, 1), (2, "x" * 60, 2)], "doc_id long, text string, `my col` int"
    )
    got = {r["doc_id"]: (r["kept_bytes"], r["my col"]) for r in suffix_dedup.kept(frame).collect()}
    assert got == {1: (b"x" * 60, 1), 2: (b"", 2)}


@pytest.mark.parametrize("chunk", [64, 200, 1 << 20])
def test_every_string_lies_in_one_segment(monkeypatch, chunk):
    draw = random.Random(8)
    texts = [bytes(draw.choices(b"abc", k=draw.choice([0, 10, 49, 50, 51, 130, 500]))) for _ in range(40)]
    at = np.cumsum([0, *map(len, texts)])
    raw = np.frombuffer(b"".join(texts), np.uint8)
    whole = {p: v for p, v in _places(*suffix_dedup._runs(raw, at))}
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    value, text, start, n = suffix_dedup._runs(raw, at)
    places = list(_places(value, text, start, n))
    want = {at[t] + k for t, x in enumerate(texts) for k in range(len(x) - L + 1)}
    assert len(places) == len(want) and {p for p, _ in places} == want and dict(places) == whole
    by_string: dict[bytes, int] = {}
    for p, v in places:
        assert by_string.setdefault(raw[p : p + L].tobytes(), v) == v
    assert (at[text] <= start).all() and (start + n + L - 1 <= at[text + 1]).all()


def _places(value, text, start, n):
    for v, s, k in zip(value.tolist(), start.tolist(), n.tolist()):
        yield from ((s + j, v) for j in range(k))


def _packed(texts):
    size = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size) - size, size


@pytest.mark.parametrize("letters", [b"a", b"ab", b"abc\x00\xff"])
def test_matching_statistics(letters):
    draw = random.Random(9)

    def make():
        return bytes(draw.choices(letters, k=draw.randint(1, 40)))

    for _ in range(60):
        base = [make() for _ in range(draw.randint(1, 6))]
        base += [draw.choice(base) for _ in range(draw.randint(0, 4))]
        patterns = [make() for _ in range(draw.randint(1, 5))] + [draw.choice(base)[1:] + letters[:1]]
        want = []
        for p in patterns:
            for i in range(len(p)):
                k = 0
                while i + k < len(p) and any(p[i : i + k + 1] in t for t in base):
                    k += 1
                want.append(k)
        marks = np.array([draw.randint(0, 9) for _ in base])
        depth = draw.choice([1, 3, 8])
        index = runindex.RunIndex(*_packed(base), marks, depth)
        length, row = index.matches(*_packed(patterns))
        assert length.tolist() == want
        least, at = index.least_mark(row), 0
        for p in patterns:
            for i in range(len(p)):
                if length[at] >= depth:
                    assert least[at] == min(m for m, t in zip(marks, base) if p[i : i + depth] in t)
                at += 1


def test_runs_do_not_grow_with_copies():
    draw = random.Random(10)
    text = bytes(draw.choices(b"abcdefgh", k=70))
    index = runindex.RunIndex(*_packed([text] * 300), np.arange(300), 50)
    assert index.n_runs <= 2 * len(text)


def test_leading_bits_of_values_are_even():
    """The tables of bits go by them; the smallest of 27 hashes would fill a small part of one."""
    raw = np.frombuffer(bytes(random.Random(12).choices(b"abcdefgh", k=20_000)), np.uint8)
    value = suffix_dedup._runs(raw, np.array([0, len(raw)]))[0]
    assert 0.45 < (value >> np.uint64(63)).mean() < 0.55


def test_segments_of_one_document_are_not_kept(spark, repetitive, monkeypatch):
    """Neither stored beside the bytes nor shuffled with the places."""
    frame = frames.tune(spark).createDataFrame(edge.rows(repetitive), edge.SCHEMA)
    root, bytes_of, cuts = f"{session.shared_root(spark)}/headrace", suffix_dedup.segment_bytes, suffix_dedup._cuts
    before, stored, rows = set(session.names(spark, root)), [], []

    def held(docs, bits):
        stored.extend(name.rpartition("-")[0] for name in set(session.names(spark, root)) - before)
        return bytes_of(docs, bits)

    def last(places, known):
        # By the hash of the segment, which a few others share.
        rows.extend((places.count(), places.join(known, ["value", "segment"]).count()))
        return cuts(places, known)

    monkeypatch.setattr(suffix_dedup, "segment_bytes", held)
    monkeypatch.setattr(suffix_dedup, "_cuts", last)
    assert suffix_dedup.spans(frame).count()
    assert sorted(stored) == ["llm-segments", "llm-values-of-several"]
    assert rows[0] - rows[1] <= 2
