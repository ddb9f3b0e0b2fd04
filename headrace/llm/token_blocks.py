"""Token ids in patched frame-of-reference blocks.

A table of pages, written in ascending ``doc_id`` order, holds the ids of whole documents.
A page's payload is a row of blocks of 128 ids each:

    minimum (4 bytes) | width (1) | exceptions (1) | packed low bits | places | high parts

The minimum is subtracted, what remains is packed at the width that holds nine tenths of
the block, and ids that need more keep their low bits there and their high parts in the
exception list. ``block_at`` indexes the block starts, so any run of ids is read by decoding
the blocks that hold it. Pages are rows of Parquet, so writing is committed and lost tasks
are repeated as for any Spark table.

Pages count ids from the start of their shard (the task that wrote them); a second table
has one row per shard with the ids before it. Null text is empty: only the end id. Rows that
share a ``doc_id`` follow each other in the order of their texts; a null ``doc_id`` comes
first. An empty table gives empty files.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headrace.llm import arrow, frames, vocabulary, words

BLOCK = 128
PERCENTILE = 90
HEADER = 6
PAGE_IDS = 1 << 16

PAGES = (
    "shard int, page int, start long, n_ids long, doc_ids array<long>, sizes array<int>, "
    "block_at array<int>, payload binary"
)


def pack(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The starts of the blocks of an id array, and their bytes."""
    n_blocks = -(-len(ids) // BLOCK)
    if n_blocks == 0:
        return np.zeros(0, np.int32), b""
    padded = np.empty(n_blocks * BLOCK, np.uint32)
    padded[: len(ids)] = ids
    padded[len(ids) :] = ids[-1]
    blocks = padded.reshape(n_blocks, BLOCK)
    low = blocks.min(axis=1)
    rest = blocks - low[:, None]
    at = BLOCK * PERCENTILE // 100
    usual = np.partition(rest, at, axis=1)[:, at]
    width = np.ceil(np.log2(usual.astype(np.float64) + 1)).astype(np.int64)
    odd = rest >> width[:, None].astype(np.uint64) != 0
    n_odd = odd.sum(axis=1)
    size = HEADER + width * (BLOCK // 8) + n_odd * 5
    starts = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(starts[-1], np.uint8)
    head = starts[:-1]
    out[head[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    out[head + 4], out[head + 5] = width, n_odd
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        bits = (rest[rows][:, :, None] >> np.arange(w, dtype=np.uint32)) & np.uint32(1)
        packed = np.packbits(bits.astype(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")
        out[head[rows][:, None] + HEADER + np.arange(packed.shape[1])] = packed
    row, place = np.nonzero(odd)
    nth = np.arange(len(row)) - np.concatenate([[0], np.cumsum(n_odd)])[row]
    lists = head + HEADER + width * (BLOCK // 8)
    out[lists[row] + nth] = place
    high = (rest[row, place] >> width[row].astype(np.uint64)).astype("<u4").view(np.uint8).reshape(-1, 4)
    out[(lists[row] + n_odd[row] + 4 * nth)[:, None] + np.arange(4)] = high
    return starts[:-1].astype(np.int32), out.tobytes()


def unpack(block_at: np.ndarray, payload: bytes) -> np.ndarray:
    """The ids of the blocks that begin at ``block_at``; the last block may be padded."""
    raw, head = np.frombuffer(payload, np.uint8), np.asarray(block_at, np.int64)
    if len(head) == 0:
        return np.zeros(0, np.uint32)
    low = np.ascontiguousarray(raw[head[:, None] + np.arange(4)]).view("<u4").ravel()
    width, n_odd = raw[head + 4].astype(np.int64), raw[head + 5].astype(np.int64)
    rest = np.zeros((len(head), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        packed = raw[head[rows][:, None] + HEADER + np.arange(w * (BLOCK // 8))]
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(rows), BLOCK, w)
        value = np.zeros((len(rows), BLOCK), np.uint32)
        for k in range(w):
            value |= bits[:, :, k].astype(np.uint32) << np.uint32(k)
        rest[rows] = value
    row = np.repeat(np.arange(len(head)), n_odd)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n_odd) - n_odd, n_odd)
    lists = head + HEADER + width * (BLOCK // 8)
    place = raw[lists[row] + nth]
    high = raw[(lists[row] + n_odd[row] + 4 * nth)[:, None] + np.arange(4)]
    high = np.ascontiguousarray(high).view("<u4").ravel()
    rest[row, place] |= high << width[row].astype(np.uint32)
    return (rest + low[:, None]).ravel()


SLICE_BYTES = 4 << 20
CACHED_WORDS = 1_500_000


class Known:
    """Ids of words met by a worker, by the value of the word (``words.py``)."""

    def __init__(self) -> None:
        self.value, self.first = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def add(self, value: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Add words, ascending, that are not known yet; beyond the limit earlier ones go."""
        if len(self.value) + len(value) > CACHED_WORDS:
            self.__init__()
        first = np.cumsum(size) - size + len(self.ids)
        at = np.searchsorted(self.value, value)
        self.first = np.insert(self.first, at, first)
        self.size = np.insert(self.size, at, size)
        self.value = np.insert(self.value, at, value)
        self.ids = np.concatenate([self.ids, ids])


_known: dict[vocabulary.Vocabulary, Known] = {}


def _library(vocab: vocabulary.Vocabulary, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts as the library gives them, one behind the other, and their numbers."""
    found = [e.ids for e in vocab.library.encode_batch_fast(texts, add_special_tokens=False)]
    size = np.fromiter(map(len, found), np.int64, len(found))
    return size, np.fromiter((i for ids in found for i in ids), np.uint32, int(size.sum()))


def _ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, …, ``size[0]`` of them, then from first[1] on."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def encode(vocab: vocabulary.Vocabulary, column: pa.Array, end_id: int) -> list[np.ndarray]:
    """The ids of whole texts, each with the end id behind them.

    Where the vocabulary drops white space and letter case, the library encodes each distinct
    word once while it is kept. Texts that hold a special token go to it whole, as do all
    texts with other vocabularies.
    """
    if not vocab.lowers:
        size, flat = _library(vocab, [t or "" for t in column.to_pylist()])
        ends = np.cumsum(size)
        return [np.append(flat[e - s : e], np.uint32(end_id)) for s, e in zip(size.tolist(), ends.tolist())]
    odd: dict[int, str] = {}
    buffer = words.buffers(column)[0].tobytes()
    if any(s.encode() in buffer for s in vocab.special):
        texts = column.to_pylist()
        odd = {k: t for k, t in enumerate(texts) if t and any(s in t for s in vocab.special)}
        column = pa.array(["" if k in odd else t for k, t in enumerate(texts)], pa.string())
    known, w = _known.setdefault(vocab, Known()), words.words(column, words.SPACED)
    at = np.searchsorted(known.value, w.value)
    at[at == len(known.value)] = 0
    miss = known.value[at] != w.value if len(known.value) else np.ones(len(at), bool)
    value, where = np.unique(w.value[miss], return_index=True)
    where = np.flatnonzero(miss)[where]
    runs = zip(w.start[where].tolist(), w.end[where].tolist())
    size, ids = _library(vocab, [w.raw[a:b].tobytes().decode() for a, b in runs])
    # Known and new ids side by side; a word's place in the one or the other.
    first = np.empty(len(w.value), np.int64)
    count = np.empty(len(w.value), np.int64)
    hit = ~miss
    first[hit], count[hit] = known.first[at[hit]], known.size[at[hit]]
    new = np.searchsorted(value, w.value[miss])
    first[miss], count[miss] = (np.cumsum(size) - size)[new] + len(known.ids), size[new]
    flat = np.concatenate([known.ids, ids])[_ragged(first, count)]
    known.add(value, size, ids)
    until = np.append(0, np.cumsum(count))[w.first]
    out = [np.append(flat[a:b], np.uint32(end_id)) for a, b in zip(until[:-1].tolist(), until[1:].tolist())]
    for k, text in odd.items():
        out[k] = np.append(_library(vocab, [text])[1], np.uint32(end_id))
    return out


def write(docs: DataFrame, path: str, vocab_path: str, end_id: int = 2) -> None:
    """Encode every document, append the end id, and write pages and shards below ``path``."""
    shared = vocabulary.share(docs.sparkSession, vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        shard, vocab = TaskContext.get().partitionId(), vocabulary.load(shared, "blocks")
        start = page = held = 0
        waiting: list[tuple[int | None, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            ids = np.concatenate([w[1] for w in waiting])
            block_at, payload = pack(ids)
            values = [
                [shard], [page], [start], [len(ids)], [[w[0] for w in waiting]],
                [[len(w[1]) for w in waiting]], [block_at], [payload],
            ]
            types = [
                pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
                pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(),
            ]
            names = [f.split()[0] for f in PAGES.split(", ")]
            arrays = [pa.array(v, t) for v, t in zip(values, types)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for part in words.slices(batch, "text", SLICE_BYTES):
                ids = encode(vocab, part.column(1), end_id)
                for doc_id, some in zip(part.column(0).to_pylist(), ids):
                    waiting.append((doc_id, some))
                    held += len(some)
                    if held >= PAGE_IDS:
                        yield flush()
                        start, page, held, waiting = start + held, page + 1, 0, []
        if waiting:
            yield flush()

    ordered = frames.texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, PAGES).write.parquet(f"{path}/pages")
    pages = docs.sparkSession.read.schema(PAGES).parquet(f"{path}/pages")
    # One row per writing task, so the window's single partition stays small.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    pages.groupBy("shard").agg(F.sum("n_ids").alias("n_ids")).select(
        "shard", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("shard_start")
    ).write.parquet(f"{path}/shards")


def pages(spark: SparkSession, path: str) -> DataFrame:
    """All pages, with ``start`` counted from the first id of the whole output."""
    schema = "shard int, n_ids long, shard_start long"
    shards = spark.read.schema(schema).parquet(f"{path}/shards").drop("n_ids")
    stored = spark.read.schema(PAGES).parquet(f"{path}/pages")
    return (
        stored.join(F.broadcast(shards), "shard")
        .withColumn("start", F.col("start") + F.col("shard_start"))
        .drop("shard_start")
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` and ``ids`` of every document, from the files."""

    def make(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            ids = unpack(row["block_at"], row["payload"])[: row["n_ids"]]
            ends = np.cumsum(row["sizes"])
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.view(np.int32))
            )
            starts = pa.array(row["start"] + ends - row["sizes"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), starts, lists], names=["doc_id", "start", "ids"]
            )

    return arrow.map_batches(pages(spark, path), "doc_id long, start long, ids array<int>", make)


def read_run(spark: SparkSession, path: str, start: int, length: int) -> DataFrame:
    """``start`` and ``ids`` of the pages' parts inside ``start … start + length``.

    Only pages that overlap the run are decoded, and of those only the blocks it needs.
    """

    def make(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            low = max(start - row["start"], 0)
            high = min(start + length - row["start"], row["n_ids"])
            blocks = row["block_at"][low // BLOCK : -(-high // BLOCK)]
            ids = unpack(blocks, row["payload"])[low % BLOCK :][: high - low]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["start"] + low]), pa.array([ids.view(np.int32)], pa.list_(pa.int32()))],
                names=["start", "ids"],
            )

    overlaps = (F.col("start") < start + length) & (F.col("start") + F.col("n_ids") > start)
    return arrow.map_batches(pages(spark, path).where(overlaps), "start long, ids array<int>", make)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document its place, size and the CRC-32 of its ids, all read from the files."""

    def make(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            raw = unpack(row["block_at"], row["payload"])[: row["n_ids"]].astype("<u4").tobytes()
            sizes = np.asarray(row["sizes"], np.int64)
            ends = np.cumsum(sizes)
            sums = [zlib.crc32(raw[4 * (e - s) : 4 * e]) for s, e in zip(sizes.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - sizes, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return arrow.map_batches(pages(spark, path), schema, make)
