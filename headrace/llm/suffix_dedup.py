"""Passages that also stand in an earlier document, found with run-length suffix indexes.

A byte is removed if it lies in a string of ``LENGTH`` bytes that also starts in a document with
a smaller ``doc_id``. Texts are judged as given, as UTF-8 bytes, and matches end with their
document.

Equal strings are brought together by content. The grams of ``GRAM`` bytes in a string have
hashes; the smallest one, mixed so that its leading bits are even, is the string's value, which
equal strings share. Neighbouring strings of one value make a segment, at most ``STARTS`` of them: text that repeats itself within a gram
gives one value to strings without end, which are several segments then. Three scans of the texts:

1. Values only, packed by their leading bits, to find those that stand in two documents. They
   set bits in a table of ``1 << BITS`` bits; when it fills up more pass, and nothing is lost.
2. Segments with such a value, named by value and hash, without their bytes. The smallest
   ``doc_id`` of each different segment is found by an aggregation, combined in the tasks. Every
   occurrence in a later document goes whole. What one document has alone is not kept.
3. Bytes of segments whose value belongs to two different segments, once for each of them and
   task. They differ, but parts of them may be equal: a passage and its surroundings. These
   are spread by value. A task builds a run-length index (``runindex``) of the segments of some
   values, but for those of a value's last document, and streams through it all segments but
   those of a value's first document. A position whose longest match has ``LENGTH`` bytes or
   more begins a string that is removed if the earliest document of the match is an earlier one.

At last the places of segments of which something goes are made again, known by a second table of
bits, and each document's are put together.

A value with more than ``HOT`` different segments, such as a phrase of which every document
makes something else, would be one task's work: its segments are cut into single strings, which
are grouped by value and hash. So no group of equal or of like strings is collected anywhere.

A document without ``doc_id`` is neither smaller nor greater than another: it keeps all bytes and
removes none. Documents that share an id do not remove from each other. Null text is empty;
an empty table gives an empty result. Rows equal in id and text get the same spans. Cut text may
end inside a character; ``kept_bytes`` is binary. Further columns of any name are kept as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headrace.llm import arrow, frames, words
from headrace.llm.runindex import RunIndex

LENGTH = 50
GRAM = 24
STARTS = LENGTH - GRAM + 1  # of a segment at most, below 256; a gram lies in as many strings
BITS = 28  # of the tables of values
SENT = 24  # bits of a value that are sent beside those of its bucket
BUCKET_BYTES = 1 << 21  # text whose values are compared at a time
HELD_VALUES = 1 << 21  # values that are packed together
HELD_BYTES = 1 << 20  # segments whose bytes are held by a task
CHUNK = 1 << 20  # bytes of one text that are worked on at a time
HOT = 4096
# Odd multipliers of the gram hash, taken from words.
ODD = (words.BASE, words.MIX_1, words.MIX_2)

SEGMENTS = "value long, segment long, doc_id long, text_hash long, start int, n int"
BYTES = "value long, segment long, doc_id long, bytes binary"
FOUND = "value long, segment long, runs array<struct<from:int,until:int>>"


def _grams(raw: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position on."""
    n = len(raw) - GRAM + 1
    eights = np.ndarray(len(raw) - 7, "<u8", raw.tobytes(), strides=(1,))
    h = np.zeros(n, np.uint64)
    shifted = np.empty(n, np.uint64)
    for j, odd in zip(range(0, GRAM, 8), ODD):
        np.bitwise_xor(h, eights[j : j + n], out=h)
        np.multiply(h, np.uint64(odd), out=h)
        np.right_shift(h, np.uint64(31), out=shifted)
        np.bitwise_xor(h, shifted, out=h)
    np.multiply(h, np.uint64(ODD[0]), out=h)
    return h


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: len(h) - (width - size)], h[width - size :]) if size < width else h


def _runs(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Value, text, first start and number of starts of each segment, places in ``raw``."""
    found = [np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3]
    parts = [found]
    for low in range(0, len(raw), CHUNK):
        piece = raw[low : low + CHUNK + LENGTH - 1]
        if len(piece) < LENGTH:
            break
        value = _smallest(_grams(piece), LENGTH - GRAM + 1)
        n = len(value)
        first = np.searchsorted(at, low, "right") - 1  # the text in which the piece begins
        last = np.searchsorted(at, low + n, "left")
        begin = np.maximum(at[first:last] - low, 0)
        # Starts of a text, from its begin, or the piece's, to where a string still fits.
        stop = np.minimum(at[first + 1 : last + 1] - LENGTH + 1 - low, n)
        full = stop > begin
        begin, stop, number = begin[full], stop[full], np.flatnonzero(full) + first
        new = np.append(True, value[1:] != value[:-1])
        new[begin] = True
        start = np.flatnonzero(new)
        owner = np.searchsorted(begin, start, "right") - 1
        inside = (owner >= 0) & (start < stop[np.maximum(owner, 0)]) if len(begin) else np.zeros(len(start), bool)
        end = np.append(start[1:], n)
        start, end, owner = start[inside], end[inside], owner[inside]
        size = np.minimum(end, stop[owner]) - start
        # A value that goes on, in text of a short period, is cut; its strings keep the value.
        many = -(-size // STARTS)
        run = np.repeat(np.arange(len(size)), many)
        skip = STARTS * _ranges(np.zeros_like(many), many)
        first_of = start[run] + skip
        # The smallest of many hashes is small; its leading bits would fill a corner of the tables.
        parts.append([words.mix(value[first_of]), number[owner][run], first_of + low, np.minimum(size[run] - skip, STARTS)])
    return tuple(np.concatenate(c) for c in zip(*parts))


def _keyed(docs: DataFrame) -> DataFrame:
    return frames.texts(docs).withColumn("text_hash", F.xxhash64("text"))


def _table(frame: DataFrame, size: int) -> np.ndarray:
    """The table of bits, eight to a byte, in which every value packed twice has one.

    ``frame`` has packs of values by bucket, see ``_packed``; ``size`` is the number of buckets.
    """
    lead = size.bit_length() - 1

    def compare(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        value = np.sort(np.concatenate([_unpacked(d.as_py()) for d in table.column("packed")]))
        twice = value[1:][value[1:] == value[:-1]]
        bits = np.zeros(1 << BITS - lead, bool)
        bits[twice >> np.uint32(SENT - BITS + lead)] = True
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "bits": pa.array([np.packbits(bits).tobytes()])})

    found = frame.groupBy("bucket").applyInArrow(compare, "bucket int, bits binary").toArrow()
    out = np.zeros((1 << lead, 1 << BITS - 3 - lead), np.uint8)
    for bucket, bits in zip(found.column("bucket").to_pylist(), found.column("bits")):
        out[bucket] = np.frombuffer(bits.as_py(), np.uint8)
    return out.ravel()


def _packed(value: np.ndarray, lead: int) -> pa.RecordBatch:
    """Values by their leading bits, ``SENT`` further bits of each; the rest is not sent, so that
    a few more pass. Two of a kind tell as much as more. The upper bytes of sorted values are
    runs, which the shuffle compresses to little."""
    value = np.sort(value >> np.uint64(64 - SENT - lead))
    use = np.ones(len(value), bool)
    use[2:] = value[2:] != value[:-2]
    value = value[use]
    bucket, at = np.unique(value >> np.uint64(SENT), return_index=True)
    upper, lower = (value >> np.uint64(16)).astype(np.uint8), value.astype(np.uint16)
    parts = [u.tobytes() + v.tobytes() for u, v in zip(np.split(upper, at[1:]), np.split(lower, at[1:]))]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket.astype(np.int32)), pa.array(parts, pa.binary())], names=["bucket", "packed"]
    )


def _unpacked(packed: bytes) -> np.ndarray:
    """Values of three bytes: all upper bytes, then the two lower ones of each."""
    n = len(packed) // 3
    return np.frombuffer(packed, np.uint8, n).astype(np.uint32) << np.uint32(16) | np.frombuffer(packed, "<u2", n, n)


def _buckets(size: int) -> int:
    return 1 << min(max((size // BUCKET_BYTES).bit_length(), 10), BITS - 3)


def _in_two_documents(docs: DataFrame) -> np.ndarray:
    """The table of values that stand in two documents."""
    size = _buckets(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    lead = size.bit_length() - 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for part in words.slices(batch, "text") if batch.num_rows else ():
                value, text, _, _ = _runs(*words.buffers(part.column(0)))
                order = np.lexsort((text, value))
                value, text = value[order], text[order]
                new = np.append(True, (value[1:] != value[:-1]) | (text[1:] != text[:-1]))[: len(value)]
                if len(value):
                    held.append(value[new])
                if sum(map(len, held)) >= HELD_VALUES:
                    yield _packed(np.concatenate(held), lead)
                    held = []
        if held:
            yield _packed(np.concatenate(held), lead)

    known = docs.where("doc_id is not null").select("text")
    return _table(known.mapInArrow(pack, "bucket int, packed binary"), size)


def _has(bits: np.ndarray, value: np.ndarray) -> np.ndarray:
    slot = (value >> np.uint64(64 - BITS)).astype(np.int64)
    return (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)


def _segments(part: pa.RecordBatch, bits: np.ndarray) -> tuple[np.ndarray, ...]:
    """The segments of a batch whose value is in the table: bytes, value, hash, text, start, starts."""
    raw, at = words.buffers(part.column(part.schema.get_field_index("text")))
    value, text, start, n = _runs(raw, at)
    use = _has(bits, value)
    value, text, start, n = value[use], text[use], start[use], n[use]
    # Two sums of the bytes, each by powers of an odd number, folded to 64 bits.
    segment = words.runs(words.mix(raw.astype(np.uint64) + np.uint64(1)), start, start + n + LENGTH - 1)
    return raw, at, value, segment, text, start, n


def segments(docs: DataFrame, bits: Broadcast, marks: Broadcast | None = None) -> DataFrame:
    """The segments of all documents whose value is in the table, and whose hash is in ``marks`` if given."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in words.slices(batch, "text"):
            _, at, *found = _segments(part, bits.value)
            if marks is not None:
                use = _has(marks.value, found[1])
                found = [column[use] for column in found]
            value, segment, text, start, n = found
            row = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(value.view(np.int64)), pa.array(segment.view(np.int64)), part.column(0).take(row),
                 part.column(2).take(row), pa.array((start - at[text]).astype(np.int32)), pa.array(n.astype(np.int32))],
                names=[c.split()[0] for c in SEGMENTS.split(", ")],
            )

    return arrow.map_batches(docs.where("doc_id is not null"), SEGMENTS, make)


def segment_bytes(docs: DataFrame, bits: Broadcast) -> DataFrame:
    """The bytes of each segment whose value is in the table, with the smallest ``doc_id`` of those
    that a task holds together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text") if batch.num_rows else ():
                raw, _, value, segment, text, start, n = _segments(part, bits.value)
                doc_id = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)[text]
                order = np.lexsort((doc_id, segment, value))
                new = np.ones(len(order), bool)
                new[1:] = (value[order][1:] != value[order][:-1]) | (segment[order][1:] != segment[order][:-1])
                use = order[new]
                data = raw.tobytes()
                parts = [data[s : s + k + LENGTH - 1] for s, k in zip(start[use].tolist(), n[use].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[use].view(np.int64)), pa.array(segment[use].view(np.int64)),
                     pa.array(doc_id[use]), pa.array(parts, pa.binary())],
                    names=[c.split()[0] for c in BYTES.split(", ")],
                )

    return docs.where("doc_id is not null").mapInArrow(run, BYTES)


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    size = high - low
    return np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _streamed(table: pa.Table) -> pa.RecordBatch:
    """Of whole values, the runs of starts in each segment that an earlier document has too."""
    value = table.column("value").to_numpy()
    doc_id = table.column("doc_id").to_numpy()
    order = np.lexsort((doc_id, value))
    value, doc_id = value[order], doc_id[order]
    data, at = words.buffers_of_bytes(table.column("bytes").combine_chunks())
    start, size = at[:-1][order], np.diff(at)[order]
    offset = np.cumsum(size) - size
    hit = np.zeros(int(size.sum()), bool)
    head = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    copies = np.diff(np.append(head, len(value)))
    left = np.flatnonzero(doc_id < np.repeat(doc_id[head + copies - 1], copies))
    right = np.flatnonzero(doc_id > np.repeat(doc_id[head], copies))
    if len(left):
        index = RunIndex(data, start[left], size[left], doc_id[left], LENGTH)
        length, row = index.matches(data, start[right], size[right])
        # A string has its value's segments only, so what matches belongs to the same value.
        own = np.repeat(doc_id[right], size[right])
        long = length >= LENGTH
        hit[_ranges(offset[right], offset[right] + size[right])] = long & (index.least_mark(row) < own)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]])))
    low, high = edge[0::2], edge[1::2]
    # A string of LENGTH bytes never begins at the last bytes of a segment, so runs do not touch.
    owner = np.searchsorted(offset, low, "right") - 1
    some, first = np.unique(owner, return_index=True)
    offsets = np.append(first, len(owner)).astype(np.int32)
    runs = pa.StructArray.from_arrays(
        [pa.array((low - offset[owner]).astype(np.int32)), pa.array((high - offset[owner]).astype(np.int32))],
        names=["from", "until"],
    )
    kept = pa.array(order[some])
    return pa.RecordBatch.from_arrays(
        [table.column("value").combine_chunks().take(kept), table.column("segment").combine_chunks().take(kept),
         pa.ListArray.from_arrays(pa.array(offsets), runs)],
        names=["value", "segment", "runs"],
    )


def _in_tasks(variants: DataFrame) -> DataFrame:
    """``_streamed`` over the segments of a task, some whole values at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n_held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            value = batch.column(0).to_numpy()
            cut = int(np.searchsorted(value, value[-1]))  # the last value may go on
            if n_held >= HELD_BYTES and cut:
                yield _streamed(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held, n_held, batch = [], 0, batch.slice(cut)
            held.append(batch)
            n_held += batch.nbytes
        if held:
            yield _streamed(pa.Table.from_batches(held))

    return variants.repartition("value").sortWithinPartitions("value").mapInArrow(run, FOUND)


def _by_strings(variants: DataFrame) -> DataFrame:
    """The same for the segments of hot values: each single string looks for its first document.

    Strings are named by their value and a hash, as segments are, and shuffled once, without
    their bytes.
    """
    string = F.expr(f"xxhash64(substring(bytes, at + 1, {LENGTH}))")
    strings = variants.select(
        "value", "segment", "doc_id", F.expr(f"explode(sequence(0, length(bytes) - {LENGTH}))").alias("at"), "bytes"
    ).select("value", string.alias("string"), "segment", "doc_id", "at")
    least = F.min("doc_id").over(Window.partitionBy("value", "string"))
    gone = strings.withColumn("least", least).where("least < doc_id")
    return gone.groupBy("value", "segment").agg(
        F.array_sort(F.collect_list(F.struct(F.col("at").alias("from"), (F.col("at") + 1).alias("until")))).alias("runs")
    )


def spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``doc_id``, ``text_hash`` and the removed byte ranges ``spans`` of every document with some."""
    docs, spark = _keyed(docs), docs.sparkSession
    shared = spark.sparkContext.broadcast(_in_two_documents(docs))
    with frames.scratch(spark) as store:
        # The bytes take more room than the rest, and are not needed beside the last shuffles.
        with frames.scratch(spark) as step:
            with frames.scratch(spark) as early:
                ids = F.min("doc_id").alias("first"), (F.max("doc_id") > F.min("doc_id")).alias("again")
                first = early(segments(docs, shared).groupBy("value", "segment").agg(*ids), "segments-of-values")
                several = first.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
                several = step(several, "values-of-several")
                again = store(first.where("again").drop("again"), "segments")
                del first
            bits = spark.sparkContext.broadcast(_marked(several, "value"))
            variants = (
                segment_bytes(docs, bits)
                .groupBy("value", "segment")
                .agg(F.min("doc_id").alias("doc_id"), F.first("bytes").alias("bytes"))
            )
            variants = step(variants, "segment-bytes")
            # At most one value for every ``hot`` segments.
            often = F.broadcast(several.where(F.col("n") > hot).select("value"))
            found = _in_tasks(variants.join(often, "value", "left_anti")).unionByName(
                _by_strings(variants.join(often, "value", "left_semi"))
            )
            found = store(found, "streamed")
            del variants, several, often
        # Segments that one document has and nothing of which is removed take part no more. No
        # document comes after the only one that has a segment.
        both = again.select("segment").unionByName(found.select("segment"))
        marks = spark.sparkContext.broadcast(_marked(both, "segment"))
        known = again.join(found, ["value", "segment"], "full").fillna({"first": (1 << 63) - 1})
        cut = frames.stored(_cuts(segments(docs, shared, marks), known), "removed-bytes")
    for table in (shared, bits, marks):
        table.destroy()
    return cut


def _marked(hashes: DataFrame, name: str) -> np.ndarray:
    """The table of the values in a column, at most as many bits as slots."""
    slot = f"shiftrightunsigned({name}, {64 - BITS})"
    lead = 10
    rows = hashes.selectExpr(f"CAST(shiftright({slot}, {BITS - lead}) AS INT) AS bucket",
                              f"CAST({slot} & {(1 << BITS - lead) - 1} AS INT) AS at")

    def mark(table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << BITS - lead, bool)
        bits[table.column("at").to_numpy()] = True
        return pa.table({"bucket": table.column("bucket")[:1], "bits": pa.array([np.packbits(bits).tobytes()])})

    found = rows.distinct().groupBy("bucket").applyInArrow(mark, "bucket int, bits binary").toArrow()
    out = np.zeros((1 << lead, 1 << BITS - 3 - lead), np.uint8)
    for bucket, bits in zip(found.column("bucket").to_pylist(), found.column("bits")):
        out[bucket] = np.frombuffer(bits.as_py(), np.uint8)
    return out.ravel()


def _cuts(places: DataFrame, known: DataFrame) -> DataFrame:
    """The removed ranges of each document, from its segments and what is known of them."""
    gone = places.join(known, ["value", "segment"]).where("doc_id > first or runs is not null")
    # First and end of the starts that are removed, in one number; a segment's are few.
    whole = "array(struct(0 as from, n as until))"
    rows = gone.selectExpr("doc_id", "text_hash", "start", f"explode(if(doc_id > first, {whole}, runs)) as run")
    range_ = "shiftleft(CAST(start + run.from AS BIGINT), 8) | (run.until - run.from) as range"
    listed = rows.selectExpr("doc_id", "text_hash", range_).groupBy("doc_id", "text_hash")

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = batch.column(2)
        of = np.repeat(np.arange(len(found)), found.value_lengths().to_numpy(zero_copy_only=False))
        value = found.flatten().to_numpy(zero_copy_only=False)
        order = np.lexsort((value, of))
        of, value = of[order], value[order]
        low = value >> 8
        high = low + (value & 255) + LENGTH - 1
        # Ranges of one document that overlap or touch become one.
        shift = of.astype(np.int64) << 32
        reach = np.maximum.accumulate(high + shift)
        head = np.flatnonzero(np.append(True, (low + shift)[1:] > reach[:-1])[: len(low)])
        tail = np.append(head[1:], len(low))[: len(head)] - 1
        spans = pa.StructArray.from_arrays(
            [pa.array(low[head].astype(np.int32)), pa.array((reach[tail] - shift[tail]).astype(np.int32))],
            names=["from", "until"],
        )
        first = np.searchsorted(of[head], np.arange(len(found) + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(first), spans)],
            names=["doc_id", "text_hash", "spans"],
        )

    schema = "doc_id long, text_hash long, spans array<struct<from:int,until:int>>"
    return arrow.map_batches(listed.agg(F.collect_set("range").alias("ranges")), schema, make)


def _with_spans(docs: DataFrame) -> DataFrame:
    """``row``, ``text`` and ``spans``, null where nothing is removed, of every document."""
    text = F.col("text").cast("string")
    rows = docs.select(F.struct("*").alias("row"), text.alias("text"), F.xxhash64(text).alias("hash"))
    gone = spans(docs).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans")
    frames.release(docs.sparkSession)
    # The hash leads: it spreads rows that share an id.
    on = (F.col("hash") == F.col("_hash")) & (F.col("row.doc_id").cast("bigint") == F.col("_id"))
    return rows.join(gone, on, "left").select("row", "text", "spans")


def _rest(text: str | None, cuts: list[dict] | None) -> tuple[bytes, int]:
    raw, at, kept = (text or "").encode(), 0, []
    for cut in cuts or ():
        kept.append(raw[at : cut["from"]])
        at = cut["until"]
    kept.append(raw[at:])
    return b"".join(kept), len(raw)


def kept(docs: DataFrame) -> DataFrame:
    """All columns of the documents, and their remaining bytes as ``kept_bytes``, null for null
    text, in place of a column of that name."""
    made = _with_spans(docs)

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        row, texts = batch.column(0), batch.column(1).to_pylist()
        left = [None if t is None else _rest(t, c)[0] for t, c in zip(texts, batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([row, pa.array(left, pa.binary())], names=["row", "_kept"])

    schema = made.select("row").schema.add("_kept", "binary")
    out = arrow.map_batches(made, schema, make)
    return out.select("row.*", "_kept").drop("kept_bytes").withColumnRenamed("_kept", "kept_bytes")


def report(docs: DataFrame) -> DataFrame:
    """Per document its bytes, the removed ones, their runs, and a hash of what is left."""
    made = _with_spans(docs.select("doc_id", "text"))

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for text, cuts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            left, n = _rest(text, cuts)
            rows.append((n, n - len(left), len(cuts or ()), hashlib.sha256(left).hexdigest()))
        n, removed, runs, digest = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).field(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(runs, pa.int64()), pa.array(digest)],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )

    return arrow.map_batches(made, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", make)
