"""Centroid clustering by a tournament of bisectors.

Vectors are turned into integers, ``floor(64 x)``. For centroids a and b the vectors nearer to
b are those with ``2 (b - a) · x > |b|² - |a|²``: an integer normal and an integer threshold,
computed once for every pair. A vector plays the centroids one after the other: the winner so
far meets the next one in one sign test, and zero favours the smaller number, so k - 1 tests
leave the nearest centroid of the smallest number. Its distance is then computed exactly.

Every task sums its vectors by cluster, so a round sends at most k rows a task, whatever share
of the rows one cluster holds; the driver gets k sums of as many components. The centroids are
their floored quotients, in whole numbers.

Kept are vectors of ``dims`` components, none null or not finite. Components whose integer goes
beyond ``LIMIT`` would give distances that a long can't hold; such vectors are left out. A null
``vec_id`` starts no centroid but is clustered. Rows that repeat are vectors of their own; of
equal ids the smaller vector starts a centroid first. With fewer kept vectors than centroids
there are as many centroids as vectors with an id; without any the result is empty.
Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm import arrow, frames

DIMS = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64
SEED = 1
LIMIT = 1 << 27  # squares of differences, over 64 components, stay below 2^62


def integers(vectors: DataFrame, dims: int = DIMS) -> DataFrame:
    """``vec_id`` and ``v``, the integers of every kept vector."""
    x = "CAST(x AS DOUBLE)"
    bound = LIMIT / SCALE
    given = vectors.select(F.col("vec_id").cast("bigint"), "embedding")
    # A component that is null gives null, one that is not a number is above every bound.
    return given.where(f"size(embedding) = {dims}").where(
        f"coalesce(forall(embedding, x -> coalesce(abs({x}) <= {bound}D, false)), false)"
    ).selectExpr("vec_id", f"transform(embedding, x -> floor({x} * {SCALE})) AS v")


def starts(kept: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id, in ascending order of the hash."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.where("vec_id is not null").withColumn("_name", name).orderBy("_name", "v").limit(k)
    return np.array([r["v"] for r in first.select("v").collect()], np.int64)


class Tournament:
    """Sign tests between integer centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.normal = 2 * (centroids[None, :, :] - centroids[:, None, :])
        square = (centroids * centroids).sum(axis=1)
        self.threshold = square[None, :] - square[:, None]

    def winners(self, x: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each row of integers."""
        best = np.zeros(len(x), np.int64)
        for rival in range(1, len(self.centroids)):
            side = np.einsum("ij,ij->i", self.normal[best, rival], x) - self.threshold[best, rival]
            best[side > 0] = rival
        return best

    def distances(self, x: np.ndarray, winner: np.ndarray) -> np.ndarray:
        """The squared distance of each row to its winner."""
        rest = x - self.centroids[winner]
        return np.einsum("ij,ij->i", rest, rest)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _sums(kept: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """How many vectors each cluster has, and the exact sums of their components."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        play = Tournament(centroids)
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                winner = play.winners(x)
                count += np.bincount(winner, minlength=k)
                np.add.at(total, winner, x)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(count[some]), pa.array(list(total[some]), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    parts = kept.select("v").mapInArrow(run, "cluster int, n long, sums array<long>")
    # At most k rows of each task; their sums are decimals, which no number of rows overflows.
    rows = (
        parts.select("cluster", "n", F.posexplode("sums").alias("at", "part"))
        .groupBy("cluster", "at")
        .agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
        .collect()
    )
    count, total = np.zeros(k, np.int64), [[0] * dims for _ in range(k)]
    for r in rows:
        count[r["cluster"]] = r["n"]
        total[r["cluster"]][r["at"]] = int(r["total"])
    return count, total


def fit(kept: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """The centroids after some rounds, one row each; an empty cluster keeps its centroid."""
    centroids = starts(kept, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        count, total = _sums(kept, centroids)
        moved = [[t // int(n) for t in row] if n else old.tolist() for n, row, old in zip(count, total, centroids)]
        centroids = np.array(moved, np.int64)
    return centroids


def assign(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster`` and squared ``distance`` of every vector."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        play, x = Tournament(centroids), _matrix(batch.column(1))
        winner = play.winners(x)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(winner.astype(np.int32)), pa.array(play.distances(x, winner))],
            names=["vec_id", "cluster", "distance"],
        )

    return arrow.map_batches(kept, "vec_id long, cluster int, distance long", make)


def cluster(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, seed: int = SEED
) -> DataFrame:
    """Every kept vector with its cluster, its distance, the inertia of its cluster and of all,
    and the hash of its centroid. An inertia beyond a long is null."""
    spark = vectors.sparkSession
    with frames.scratch(spark) as store:
        kept = store(integers(vectors, dims), "integers")
        centroids = fit(kept, k, rounds, seed)
        if not len(centroids):
            kept = kept.limit(0)
        placed = frames.stored(assign(kept, centroids), "clusters")
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"))
    inertia = {r["cluster"]: int(r["inertia"]) for r in sums.collect()}  # one row of each cluster
    whole = sum(inertia.values())
    rows = [
        (c, *(n if n < 1 << 63 else None for n in (part, whole)),
         hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
        for c, part in inertia.items()
    ]
    told = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
