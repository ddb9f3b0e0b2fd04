from __future__ import annotations

import edge
import numpy as np
import pytest
import xxhash

from headrace.llm import frames, simhash

SMALL = "/root/testdata/sf0.01"


def plain(text: str | None) -> int:
    words = [w.lower() if w.isascii() else edge.lower(w) for w in edge.spaced(text)]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for k in range(64):
            counts[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * counts[k] > len(shingles))


def roots(fps: list[int]) -> list[int]:
    """For each place the first place that hangs together with it."""
    values = np.array(fps, np.uint64)
    label = np.arange(len(values))
    while True:
        new = label.copy()
        for i in range(len(values)):
            near = np.bitwise_count(values ^ values[i]) <= 4
            new[near] = np.minimum(new[near], label[near].min())
        if (new == label).all():
            return label.tolist()
        label = new


def test_code_covers_all_words_within_three_bits():
    table = simhash.nearest()
    code = np.zeros(1 << 12, np.int64)
    for word in np.flatnonzero(np.bincount(table, minlength=1 << 12) != 2048):
        raise AssertionError(word)
    draw = np.random.default_rng(1).integers(0, 1 << 23, 2000)
    for word in draw:  # neighbours of a word agree with it unless it is three bits away
        near = {int(table[word ^ (1 << k)]) for k in range(23)} | {int(table[word])}
        assert len(near) in (1, 6)
    assert len(code) == len(np.unique(table))


def test_segments_two_bits_apart_share_a_key():
    draw = np.random.default_rng(2)
    for width in (21, 22):
        a = draw.integers(0, 1 << width, 3000).astype(np.uint32)
        b = a.copy()
        for _ in range(2):
            b ^= (1 << draw.integers(0, width, 3000)).astype(np.uint32)
        (ka, _), (kb, _) = simhash.segment_keys(a, width), simhash.segment_keys(b, width)
        for x, y in zip(ka, kb):
            assert set(x[x >= 0]) & set(y[y >= 0])


def test_every_link_is_found_once(spark):
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**63, 150, dtype=np.int64)
    fps = set(base.tolist()) | {0, -1}
    for value in base:
        for _ in range(6):
            for _ in range(draw.integers(1, 6)):
                value ^= np.int64(-(2**63)) if (k := draw.integers(0, 64)) == 63 else np.int64(1 << int(k))
            fps.add(int(value))
    fps = sorted(fps)
    got = [tuple(r) for r in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()]
    want = {
        (a, b) for i, a in enumerate(fps) for b in fps[i + 1 :]
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 4
    }
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300


def test_chain_is_one_component(spark):
    order = np.random.default_rng(4).permutation(60).tolist()
    edges = [tuple(sorted((order[k], order[k + 1]))) for k in range(59)]
    frame = spark.createDataFrame([*edges, (100, 101)], "a long, b long")
    placed = {r["node"]: r["root"] for r in simhash.components(frame).collect()}
    assert len({placed[k] for k in range(60)}) == 1 and placed[100] == placed[101] != placed[0]


@pytest.mark.parametrize("step", [1, -1])
def test_an_ordered_path_takes_few_rounds(spark, step):
    frame = spark.range(999).selectExpr(f"{step} * id as x", f"{step} * (id + 1) as y").selectExpr("least(x, y) a", "greatest(x, y) b")
    rounds = []

    def store(step, name):
        rounds.append(name)
        return frames.stored(step, name)

    placed = {r["node"]: r["root"] for r in simhash.components(frame, store).collect()}
    assert len(placed) == 1000 and len(set(placed.values())) == 1
    assert rounds.count("steps") <= 20


def test_small_table(spark):
    documents = frames.table(spark, SMALL, "documents")
    rows = sorted((r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect())
    fps = [plain(t) for _, t in rows]
    root = roots(fps)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(documents).collect()}
    for (i, _), fp, r in zip(rows, fps, root):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{fp:016x}", rows[r][0])


def test_edges(spark, edges, empty):
    got = edge.by_id(simhash.near_duplicates(edges))
    for i, text in edge.TEXTS:
        assert {r["fingerprint"] for r in got[i]} == {f"{plain(text):016x}"}
    assert {got[i][0]["component_id"] for i in (0, 1, 2)} == {0}
    assert [r["component_id"] for r in got[4]] == [3, 3]
    kept = simhash.representatives(edges)
    assert kept.columns == edges.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {1, 2, 4}.isdisjoint(ids) and None in ids
    assert simhash.near_duplicates(empty).count() == simhash.representatives(empty).count() == 0


def test_representatives_are_rows_not_ids(spark):
    one, two, three = edge.PROSE, edge.LONG, "another text of its own with enough words to be far from the rest"
    texts = [(0, two), (1, one), (1, two), (None, three), (None, three), (None, three + " and more words follow here"), (None, "x y z")]
    frame = spark.createDataFrame(edge.rows(texts), edge.SCHEMA)
    got = sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in simhash.representatives(frame).collect())
    root = roots([plain(t) for _, t in texts])
    want = sorted((texts[k][0] is None, texts[k][0], texts[k][1]) for k in sorted(set(root)))
    assert got == want and (False, 1, one) in got and sum(g[0] for g in got) >= 2


def test_keys_are_not_broadcast(spark):
    """Fingerprints in a small file have a hundred times as many keys, which Spark does not see."""
    with frames.scratch(spark) as store:
        nodes = store(frames.tune(spark).range(2000).selectExpr("xxhash64(id) as fp"), "nodes")
        plan = simhash.links(nodes)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
