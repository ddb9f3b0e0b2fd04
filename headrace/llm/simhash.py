"""SimHash near-duplicates, found by fuzzy hashing with the Golay code.

A fingerprint has 64 bits: bit k is set if it is set in over half the 64-bit hashes of the
text's shingles. Two fingerprints are linked if they differ in at most four bits; documents
that hang together by links form a component.

A fingerprint is cut into segments of 22, 21 and 21 bits, each a word of the 23-bit Golay
code. Every word of 23 bits lies within three bits of exactly one codeword. A segment's keys
are the codewords nearest to it and to the words one bit away, at most six. Segments that
differ in two bits or fewer share a word one bit from both, and so a key. Of three segments
that differ in four bits together, without the worst one each differs in at most two, and one
in at most one. So linked fingerprints share a key in two segments, and a join on pairs of
keys, three pairs of segments, finds every link; the bit distance is then checked. Each link
is taken at the pair of its two best segments only, and there at few of the shared keys.

Equal fingerprints are one row throughout, so a group of copies costs nothing. Components
come from contracting the link graph until no link is left; every step is stored in the
shared folder. Null or blank text has no shingle and the fingerprint zero, linked like any
other. Only ``doc_id`` and ``text`` are read. Rows that repeat, also with one ``doc_id``, each
give a row; a null ``doc_id`` is never the smallest unless a component has no other.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm import arrow, frames

SHINGLE = 4
SEED = 42
MAX_BITS = 4

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
PAIRS = ((0, 1), (0, 2), (1, 2))
MOST_KEYS = 6
GENERATOR = 0b101011100011  # of the cyclic (23, 12) Golay code
HASHED = 1 << 16  # shingles whose bits are counted at a time


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer."""
    joined = b" ".join(text.encode().lower().split())
    if not joined:
        return 0
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    starts = np.concatenate([[0], spaces + 1])
    ends = np.concatenate([spaces, [len(joined)]])
    n = max(len(starts) - shingle + 1, 1)
    starts, ends = starts[:n], ends[min(shingle, len(ends)) - 1 :]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for low in range(0, n, HASHED):
        runs = zip(starts[low : low + HASHED].tolist(), ends[low : low + HASHED].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in runs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``fp`` of every document."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [fingerprint(t or "", shingle) for t in batch.column(1).to_pylist()]
        columns = [batch.column(0), batch.column(2), pa.array(found, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "fp"])

    given = frames.texts(docs).withColumn("text_hash", F.xxhash64("text"))
    return arrow.map_batches(given, "doc_id long, text_hash long, fp long", make)


_nearest: list[np.ndarray] = []


def nearest() -> np.ndarray:
    """For each 23-bit word the number of the one codeword within three bits."""
    if not _nearest:
        numbers = np.arange(1 << 12, dtype=np.uint32)
        code = np.zeros(1 << 12, np.uint32)
        for k in range(12):
            code ^= np.where(numbers >> np.uint32(k) & np.uint32(1), np.uint32(GENERATOR << k), np.uint32(0))
        one = np.uint32(1) << np.arange(23, dtype=np.uint32)
        two = np.unique((one[:, None] ^ one).ravel())
        errors = np.unique(np.concatenate([[0], one, two, (two[:, None] ^ one).ravel()]).astype(np.uint32))
        errors = errors[np.bitwise_count(errors) <= 3]
        table = np.zeros(1 << 23, np.uint16)
        for error in errors:
            table[code ^ error] = numbers
        _nearest.append(table)
    return _nearest[0]


def segment_keys(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of segments, one row each, padded with -1; and the key of each word itself."""
    flips = np.concatenate([[0], 1 << np.arange(width)]).astype(np.uint32)
    keys = nearest()[words[:, None] ^ flips].astype(np.int32)
    own = keys[:, 0].copy()
    keys.sort(axis=1)
    keys[:, 1:][keys[:, 1:] == keys[:, :-1]] = -1
    return -np.sort(-keys, axis=1)[:, :MOST_KEYS], own


def _keys(nodes: DataFrame) -> DataFrame:
    """``key``, ``fp`` and ``own``: whether the key's halves are the segments' own (bits 0, 1)."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        signed = batch.column(0).to_numpy(zero_copy_only=False)
        fps = signed.view(np.uint64)
        cut = [
            ((fps >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.uint32) for at, width in SEGMENTS
        ]
        found = [segment_keys(c, width) for c, (_, width) in zip(cut, SEGMENTS)]
        for number, (i, j) in enumerate(PAIRS):
            (a, own_a), (b, own_b) = found[i], found[j]
            valid = (a[:, :, None] >= 0) & (b[:, None, :] >= 0)
            key = (number << 24 | a[:, :, None] << 12) | b[:, None, :]
            own = (a == own_a[:, None])[:, :, None] | (b == own_b[:, None])[:, None, :].astype(np.int8) << 1
            row = np.broadcast_to(np.arange(len(fps))[:, None, None], valid.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[valid], pa.int32()), pa.array(signed[row[valid]], pa.int64()),
                 pa.array(own[valid].astype(np.int8), pa.int8())],
                names=["key", "fp", "own"],
            )

    return arrow.map_batches(nodes, "key int, fp long, own byte", make)


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a`` < ``b``: all pairs of different fingerprints within ``max_bits`` bits.

    ``nodes`` has each fingerprint once, in ``fp``. The keys are complete up to four bits.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"the keys find links of up to {MAX_BITS} bits")
    keys = _keys(nodes.select("fp"))
    masks = [((1 << width) - 1) << at for at, width in SEGMENTS]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    e = [f"bit_count((a.fp ^ b.fp) & {m}L)" for m in signed]
    # The segment that is left out has the most differing bits, of equals the last one.
    best = {
        0: f"{e[2]} >= {e[0]} and {e[2]} >= {e[1]}",
        1: f"{e[1]} > {e[2]} and {e[1]} >= {e[0]}",
        2: f"{e[0]} > {e[1]} and {e[0]} > {e[2]}",
    }
    # A segment with at most one differing bit is met at the key of the smaller fingerprint.
    at = [
        f"shiftright(a.key, 24) = {n} and {best[n]} and ({e[i]} > 1 or a.own & 1 = 1) and ({e[j]} > 1 or a.own & 2 = 2)"
        for n, (i, j) in enumerate(PAIRS)
    ]
    near = F.expr(f"a.fp < b.fp and bit_count(a.fp ^ b.fp) <= {max_bits} and ({' or '.join(f'({x})' for x in at)})")
    # Spark takes the keys for as many rows as there are fingerprints and would broadcast them; there
    # are up to 108 of each.
    return (
        keys.alias("a")
        .join(keys.alias("b").hint("merge"), (F.col("a.key") == F.col("b.key")) & near)
        .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
        .distinct()
    )


def components(edges: DataFrame, store: frames.Store = frames.stored) -> DataFrame:
    """``node`` and ``root`` of every node that has a link ``a``–``b``; roots are shared.

    Each round gives the nodes another order by a hash, moves every node to its least neighbour, if
    that is less, and keeps the links between different places. No shape of links is slow in most
    orders: a path of any length loses a part of its nodes each round.
    """
    edges = store(edges, "links")
    nodes = edges.selectExpr("a as node").union(edges.selectExpr("b as node")).distinct()
    placed = store(nodes.selectExpr("node", "node as root"), "roots")
    for turn in itertools.count():
        if edges.isEmpty():
            return placed
        both = edges.union(edges.selectExpr("b as a", "a as b"))
        least = both.groupBy("a").agg(F.expr(f"min(struct(xxhash64(b, {turn}) as h, b as node)) as b"))
        step = store(
            least.selectExpr("a as at", f"least(struct(xxhash64(a, {turn}) as h, a as node), b).node as to"), "steps"
        )
        placed = store(
            placed.join(step, F.col("root") == F.col("at"), "left").selectExpr("node", "coalesce(to, root) as root"),
            "roots",
        )
        edges = store(
            edges.join(step.selectExpr("at as a", "to as to_a"), "a")
            .join(step.selectExpr("at as b", "to as to_b"), "b")
            .where("to_a != to_b")
            .selectExpr("least(to_a, to_b) as a", "greatest(to_a, to_b) as b")
            .distinct(),
            "links",
        )


def _classes(order: DataFrame, store: frames.Store, max_bits: int) -> DataFrame:
    """``fp`` and ``first``, the least ``first`` in the component of each fingerprint.

    ``order`` has each fingerprint once, with the least of its rows in ``first``.
    """
    nodes = store(order, "nodes")
    placed = components(links(nodes, max_bits), store)
    rooted = nodes.join(placed, F.col("fp") == F.col("node"), "left").selectExpr(
        "fp", "first", "coalesce(root, fp) as root"
    )
    rooted = store(rooted, "rooted")
    smallest = store(rooted.groupBy("root").agg(F.min("first").alias("least")), "components")
    return store(rooted.join(smallest, "root").selectExpr("fp", "least as first"), "classes")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hexadecimal) and ``component_id`` of every document."""
    with frames.scratch(docs.sparkSession) as store:
        printed = store(fingerprints(docs, shingle), "fingerprints")
        order = printed.groupBy("fp").agg(F.min("doc_id").alias("first"))
        classes = _classes(order, store, max_bits).withColumnRenamed("first", "component_id")
        found = printed.join(classes, "fp").select(
            "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
        )
        return frames.stored(found, "near-duplicates")


def representatives(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component with all its columns: the one with the smallest ``doc_id``, null
    last, and of those that share it the one whose text has the smallest hash.
    """
    row = F.struct("*").alias("row")
    text_hash = F.xxhash64(F.col("text").cast("string"))
    least = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    with frames.scratch(docs.sparkSession) as store:
        printed = store(fingerprints(docs, shingle), "fingerprints")
        order = printed.groupBy("fp").agg(F.min(least).alias("first"))
        classes = _classes(order, store, max_bits)
        kept = classes.select(F.col("first.doc_id").alias("kept"), F.col("first.text_hash").alias("kept_hash"))
        kept = frames.stored(kept.distinct(), "representatives")
    rows = docs.select(row, F.col("doc_id").cast("bigint").alias("id"), text_hash.alias("h"))
    # The hash leads: it spreads rows without an id. Rows equal in both are combined in their tasks.
    on = (F.col("h") == F.col("kept_hash")) & F.col("id").eqNullSafe(F.col("kept"))
    found = rows.join(kept, on, "left_semi")
    return found.groupBy("id", "h").agg(F.first("row").alias("row")).select("row.*")
