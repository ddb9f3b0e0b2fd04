from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from headrace.llm import centroids, frames

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, v string, distance long"


def brute(rows, k=16, rounds=3, dims=64):
    """Results by id, with whole numbers of any size."""
    kept = []
    for i, vector in rows:
        if vector is not None and len(vector) == dims and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((i, tuple(math.floor(64 * x) for x in vector)))
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in named[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds if centres else 0):
        members: dict[int, list] = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        centres = [
            tuple(sum(x) // len(members[n]) for x in zip(*members[n])) if n in members else c
            for n, c in enumerate(centres)
        ]
    placed = [(i, *nearest(v)[::-1]) for i, v in kept] if centres else []
    inertia: dict[int, int] = {}
    for _, n, d in placed:
        inertia[n] = inertia.get(n, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(
        ((i, n, d, inertia[n], sum(inertia.values()), digest[n]) for i, n, d in placed), key=lambda r: (r[0] is None, r)
    )


def check(frame, **how):
    rows = [(r["vec_id"], r["embedding"]) for r in frame.select("vec_id", "embedding").collect()]
    got = [tuple(r) for r in centroids.cluster(frame, **how).collect()]
    assert sorted(got, key=lambda r: (r[0] is None, r)) == brute(rows, **{k: v for k, v in how.items() if k != "seed"})
    return got


def test_small_table(spark):
    frame = frames.table(spark, SMALL, "embeddings")
    assert len(check(frame)) == 500


@pytest.fixture
def build(spark):
    def make(vectors, ids=None):
        ids = range(len(vectors)) if ids is None else ids
        rows = [(i, v, 0, 7, "v", 3) for i, v in zip(ids, vectors)]
        return frames.tune(spark).createDataFrame(rows, SCHEMA)

    return make


def test_what_is_kept(build):
    inf, nan = float("inf"), float("nan")
    bad = [None, [], [1.0], [1.0, 2.0, 3.0], [1.0, None], [inf, 0.0], [0.0, nan], [-inf, 0.0]]
    good = [[0.0, 0.0], [-0.01, 0.01], [1e-30, -1e-30], [2.0**20, -(2.0**20)], [3.5, -3.5]]
    got = check(build(bad + good), k=3, dims=2)
    assert sorted(r[0] for r in got) == list(range(len(bad), len(bad + good)))
    assert centroids.cluster(build([[1e30, 0.0], [1.0, 1.0]]), k=3, dims=2).count() == 1


def test_ties_repeats_and_ids(build):
    square = [[0.0, 0.0], [1.0, 0.0], [0.0, 1.0], [1.0, 1.0], [0.5, 0.5]] * 3
    check(build(square), k=4, dims=2)
    check(build(square, [None, 1, 1, 1, 2, 2, None, 3, 3, 4, 4, 5, 5, 6, None]), k=4, dims=2)
    check(build([[1.0, 2.0]] * 20), k=4, dims=2)
    check(build([[1.0, 2.0]] * 2, [None, None]), k=4, dims=2)


def test_few_or_no_rows(build, spark):
    check(build([[1.0, 2.0]]), k=4, dims=2)
    assert centroids.cluster(build([])).count() == centroids.cluster(build([None, [1.0]])).count() == 0
    assert centroids.cluster(build([])).columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256",
    ]


def test_tournament_is_the_smallest_nearest():
    draw = np.random.default_rng(4)
    for _ in range(50):
        centres, x = draw.integers(-3, 4, (9, 2)), draw.integers(-4, 5, (200, 2))
        squares = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
        play = centroids.Tournament(centres)
        winner = play.winners(x)
        assert (winner == squares.argmin(axis=1)).all()
        assert (play.distances(x, winner) == squares.min(axis=1)).all()
    far = np.array([[centroids.LIMIT] * 64, [-centroids.LIMIT] * 64])
    assert centroids.Tournament(far).distances(far, np.array([1, 0])).tolist() == [64 * (2 * centroids.LIMIT) ** 2] * 2
