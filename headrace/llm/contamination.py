"""Benchmark decontamination with suffix arrays of the documents.

The documents of a slice of a task are a shard. Its suffix array holds the places whose words
may begin a window of the benchmark, in the order of the words that follow. Every suffix of
every benchmark item is looked up in it by binary search; equal neighbours are the places of
a verbatim match. Matches that go on together are joined to the longest ones.

A window is 13 consecutive words of an item; an item of fewer words, but not none, is one
window. A document's word inside a place where a window stands is hit, and a document is
contaminated if at least one word in twenty is hit.

The benchmark reaches the executors in blocks of at most ``BLOCK_BYTES`` of text (or one
item); with several blocks each one is a pass over the documents, stored in between. Windows
are compared by 64-bit values of their words.

Null text has no words, a document without words is clean. Items that share an id count once;
a null id counts as the empty string. Repeated documents give repeated results, an empty
benchmark hits nothing, and columns of any name are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm import arrow, frames, words

WINDOW = 13
HIT_SHARE = 20
BLOCK_BYTES = 32 << 20
SHARD_BYTES = 2 << 20

_KEY = np.dtype((np.void, 4 * WINDOW))


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort like them."""
    return np.ascontiguousarray(rows.astype(">u4")).view(_KEY).ravel()


@dataclass
class Index:
    """A block of benchmark items."""

    ids: list[str]
    vocabulary: np.ndarray  # values of the items' words, ascending; their numbers begin at 1
    low: np.ndarray  # keys of the different windows, padded with the least and
    high: np.ndarray  # with the greatest number
    size: np.ndarray  # words of each window
    first: np.ndarray  # uses of window i: first[i]:first[i+1]
    item: np.ndarray  # of each use
    at: np.ndarray  # where in the item
    begins_one: np.ndarray  # by word number: begins a window of one word
    begins_pair: np.ndarray  # first two words of the longer windows, as one number, ascending


def index(items: list[tuple[str, str]]) -> Index:
    w = words.words(pa.array([t for _, t in items], pa.large_string()), words.ALNUM)
    vocabulary, number = np.unique(w.value, return_inverse=True)
    rows, size, item, at = [], [], [], []
    for k in range(len(items)):
        ids = number[w.first[k] : w.first[k + 1]] + 1
        n = min(len(ids), WINDOW)
        for start in range(len(ids) - n + 1 if n else 0):
            rows.append(np.pad(ids[start : start + n], (0, WINDOW - n)))
            size.append(n)
            item.append(k)
            at.append(start)
    rows = np.array(rows, np.uint32).reshape(len(rows), WINDOW)
    size, item, at = (np.array(x, np.int64) for x in (size, item, at))
    order = np.lexsort((at, item, *rows.T[::-1]))
    rows, size, item, at = rows[order], size[order], item[order], at[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    first = np.append(np.flatnonzero(new), len(rows))
    rows, size = rows[new], size[new]
    high = np.where(np.arange(WINDOW) < size[:, None], rows, np.uint32(0xFFFFFFFF))
    one = np.zeros(len(vocabulary) + 1, bool)
    one[rows[size == 1, 0]] = True
    pair = rows[size > 1, 0].astype(np.uint64) << np.uint64(32) | rows[size > 1, 1]
    return Index([i for i, _ in items], vocabulary, _keys(rows), _keys(high), size, first, item, at, one, np.unique(pair))


def _within(ascending: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where values stand in an ascending array, and whether they do."""
    if len(ascending) == 0:
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)
    return at, ascending[at] == values


def search(ix: Index, w: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """Places in a shard where windows stand: the word's number, and the window's."""
    place, known = _within(ix.vocabulary, w.value)
    text = np.repeat(np.arange(len(w.at) - 1), np.diff(w.first))
    # A zero between texts, which no window holds, and enough of them at the end.
    numbers = np.zeros(len(place) + len(w.at) + WINDOW, np.uint32)
    spread = np.arange(len(place)) + text
    numbers[spread] = np.where(known, place + 1, 0)
    start = np.flatnonzero(known)
    here = numbers[spread[start]]
    pair = here.astype(np.uint64) << np.uint64(32) | numbers[spread[start] + 1]
    start = start[ix.begins_one[here] | _within(ix.begins_pair, pair)[1]]
    keys = _keys(numbers[spread[start][:, None] + np.arange(WINDOW)])
    order = np.argsort(keys, kind="stable")
    keys, start = keys[order], start[order]  # the suffix array
    low = np.searchsorted(keys, ix.low, "left")
    count = np.searchsorted(keys, ix.high, "right") - low
    window = np.repeat(np.arange(len(low)), count)
    nth = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
    return start[low[window] + nth], window


def _blocks(benchmark: DataFrame) -> Iterator[Index]:
    """The benchmark in blocks; the driver holds one at a time."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.col("text").cast("string").alias("text"),
    ).where("text is not null")
    held, size = [], 0
    for row in items.toLocalIterator():
        if held and size + len(row["text"].encode()) > BLOCK_BYTES:
            yield index(held)
            held, size = [], 0
        held.append((row["item_id"], row["text"]))
        size += len(row["text"].encode())
    yield index(held)


def _mark(state: DataFrame, ix: Index) -> DataFrame:
    """Adds the spans that a block hits, and its items, to those found so far."""
    shared = state.sparkSession.sparkContext.broadcast(ix)
    span = pa.struct([("from", pa.int64()), ("until", pa.int64())])

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for part in words.slices(batch, "text", SHARD_BYTES):
            w = words.words(part.column(part.schema.get_field_index("text")), words.ALNUM)
            at, window = search(block, w)
            edge = np.zeros(len(w.start) + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + block.size[window], -1)
            hit = np.diff(np.concatenate([[0], (np.cumsum(edge)[:-1] > 0).astype(np.int8), [0]]))
            begin, until = np.flatnonzero(hit == 1), np.flatnonzero(hit == -1)
            of = np.searchsorted(w.first, at, "right") - 1
            uses = block.first[window + 1] - block.first[window]
            use = np.repeat(block.first[window], uses) + np.arange(uses.sum()) - np.repeat(np.cumsum(uses) - uses, uses)
            pairs = np.unique(np.stack([np.repeat(of, uses), block.item[use]]), axis=1)
            found: list[list[dict]] = [[] for _ in range(part.num_rows)]
            for b, u in zip(begin.tolist(), until.tolist()):
                row = int(np.searchsorted(w.first, b, "right") - 1)
                while b < u:  # neighbours in the buffer may both be hit at their border
                    end = min(u, int(w.first[row + 1]))
                    if b < end:
                        found[row].append({"from": b - int(w.first[row]), "until": end - int(w.first[row])})
                    b, row = end, row + 1
            ids: list[list[str]] = [[] for _ in range(part.num_rows)]
            for row, item in pairs.T.tolist():
                ids[row].append(block.ids[item])
            before = part.column(part.schema.get_field_index("spans")).to_pylist()
            known = part.column(part.schema.get_field_index("items")).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(np.diff(w.first), pa.int64()),
                 pa.array([a + b for a, b in zip(before, found)], pa.list_(span)),
                 pa.array([a + b for a, b in zip(known, ids)], pa.list_(pa.string()))],
                names=["row", "text", "n_words", "spans", "items"],
            )

    return arrow.map_batches(state, state.schema, make)


def judge(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``row`` (the document's columns), its words, hit words, items found and the verdict."""
    state = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text")).selectExpr(
        "row", "text", "0L as n_words",
        "cast(array() as array<struct<from: bigint, until: bigint>>) as spans",
        "cast(array() as array<string>) as items",
    )
    blocks = _blocks(benchmark)
    state = _mark(state, next(blocks))
    for block in blocks:
        state = _mark(frames.stored(state, "contamination"), block)
    hit = (
        "aggregate(array_sort(spans), named_struct('n', 0L, 'until', 0L), (a, x) -> named_struct("
        "'n', a.n + greatest(0L, x.until - greatest(a.until, x.from)), 'until', greatest(a.until, x.until)), a -> a.n)"
    )
    return state.selectExpr(
        "row", "n_words", f"{hit} as n_hit", "array_sort(array_distinct(items)) as items", "spans"
    ).selectExpr("*", f"n_hit > 0 and {HIT_SHARE} * n_hit >= n_words as contaminated")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The verdict on every document with a digest of the items found in it."""
    return judge(frames.texts(docs), benchmark).selectExpr(
        "row.doc_id as doc_id", "n_words", "n_hit", "cast(size(items) as long) as n_items",
        "sha2(array_join(items, ','), 256) as items_sha256", "contaminated",
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    return judge(docs, benchmark).where("not contaminated").select("row.*")


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The longest verbatim matches: which words of which item stand where in a document."""
    spark, out = docs.sparkSession, None
    schema = "doc_id long, item_id string, doc_word long, item_word long, n_words long"

    def finder(shared):
        def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ix = shared.value
            for part in words.slices(batch, "text", SHARD_BYTES):
                w = words.words(part.column(1), words.ALNUM)
                at, window = search(ix, w)
                uses = ix.first[window + 1] - ix.first[window]
                use = np.repeat(ix.first[window], uses) + np.arange(uses.sum()) - np.repeat(np.cumsum(uses) - uses, uses)
                place, size = np.repeat(at, uses), np.repeat(ix.size[window], uses)
                row = np.searchsorted(w.first, place, "right") - 1
                item, inside = ix.item[use], ix.at[use]
                order = np.lexsort((place, place - inside, item, row))
                row, item, place, inside, size = (x[order] for x in (row, item, place, inside, size))
                new = np.ones(len(row), bool)
                new[1:] = (
                    (row[1:] != row[:-1]) | (item[1:] != item[:-1])
                    | (place[1:] != place[:-1] + 1) | (inside[1:] != inside[:-1] + 1)
                )
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(row))[: len(head)] - 1
                ids = part.column(0).take(pa.array(row[head]))
                arrays = [
                    ids, pa.array([ix.ids[i] for i in item[head]], pa.string()),
                    pa.array(place[head] - w.first[row[head]], pa.int64()), pa.array(inside[head], pa.int64()),
                    pa.array(place[tail] - place[head] + size[tail], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in schema.split(", ")])

        return make

    for block in _blocks(benchmark):
        found = arrow.map_batches(frames.texts(docs), schema, finder(spark.sparkContext.broadcast(block)))
        out = found if out is None else out.union(found)
    return out
