"""Repeated lines and passages, removed but for their earliest occurrence.

Units are hashed after normalising: words between white space, A-Z lower-cased. A unit is a
line of at least ``line_words`` words, 1 if not given, or any ``UNIT_WORDS`` consecutive words, inside a line
or over several. So every repeated passage of ``UNIT_WORDS`` words or more is covered from its
first word to its last, and every repeated line of enough words whatever its length.

Digests, of 64 bits, are grouped globally. The occurrence in the smallest ``doc_id`` (null
last, texts under one id by their hash), there the first one, is kept; every other one is
removed. In one document, only occurrences behind the end of its first one count. Removed
units that touch form one span, which carries its offsets in the original text, in code points.

Most units occur once. A first pass sends nothing but digests, ``SENT`` bits of each beside those
of its bucket, to find those that occur twice; they set bits in a table of ``1 << BITS`` bits, and only units
whose bit is set go on. The table has a fixed size: when many units repeat more of the others
pass, and nothing is lost. A document's repeats of its own units are found within its row.
Across documents only the smallest row of each digest is needed, combined before the shuffle.
The digests that stand in two documents set bits in a second table of that size, and a third
pass sends only units that it lets through, to be joined with their digests.

A document is a ``doc_id`` and a text, named by ``text_hash``: different texts under one id,
or without one, are different documents. Rows equal in both are copies of one document, which
are cut alike. Null and blank text has no units; an empty table gives an empty result; the
spans need only ``doc_id`` and ``text``, and cleaning keeps columns of any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm import arrow, frames, words

UNIT_WORDS = 16
LINE_FEED = 10
NO_ID = (1 << 63) - 1  # stands for a null doc_id

BITS = 28  # of the table of repeated digests
SENT = 24  # bits of a digest that are sent beside those of its bucket
BUCKET_CHARS = 1 << 21  # text whose digests are compared at a time
HELD_DIGESTS = 1 << 21  # digests that are packed together

UNITS = "doc_id long, text_hash long, digest long, from int, until int, again boolean"
SPANS = "doc_id long, text_hash long, from long, until long, n_units long, kept_doc_id long"


def _units(w: words.Words, line_words: int) -> tuple[np.ndarray, ...]:
    """Text, digest, first word and end word of every unit."""
    n = len(w.start)
    text = np.repeat(np.arange(len(w.at) - 1), np.diff(w.first))
    line = np.cumsum(w.raw == LINE_FEED)[w.start] + text  # grows with each line and each text
    head = np.ones(n, bool)
    head[1:] = line[1:] != line[:-1]
    first = np.flatnonzero(head)
    last = np.append(first[1:], n)[: len(first)]
    whole = last - first >= line_words
    chosen = np.flatnonzero(np.arange(n) + UNIT_WORDS <= w.first[1:][text])
    begin = np.concatenate([first[whole], chosen])
    end = np.concatenate([last[whole], chosen + UNIT_WORDS])
    return text[begin], words.runs(w.value, begin, end), begin, end


def _slot(digest: np.ndarray) -> np.ndarray:
    return (digest >> np.uint64(64 - BITS)).astype(np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    return frames.texts(docs).withColumn("text_hash", F.xxhash64("text"))


def _unpacked(packed: bytes) -> np.ndarray:
    """Values of three bytes: all upper bytes, then the two lower ones of each."""
    n = len(packed) // 3
    return np.frombuffer(packed, np.uint8, n).astype(np.uint32) << np.uint32(16) | np.frombuffer(packed, "<u2", n, n)


def _repeated(docs: DataFrame, line_words: int) -> np.ndarray:
    """The table of bits, eight to a byte, in which every digest that occurs twice has one."""
    size = docs.agg(F.sum(F.char_length("text"))).first()[0] or 0
    lead = min(max((size // BUCKET_CHARS).bit_length(), 10), BITS - 3)
    rest = np.uint64(64 - SENT - lead)  # bits that are not sent; without them a few units more pass

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def packed() -> pa.RecordBatch:
            digest = np.sort(np.concatenate(held) >> rest)
            use = np.ones(len(digest), bool)
            use[2:] = digest[2:] != digest[:-2]  # two of a kind tell as much as more
            digest = digest[use]
            bucket, at = np.unique(digest >> np.uint64(SENT), return_index=True)
            # The upper bytes of sorted values are runs, which the shuffle compresses to little.
            upper, lower = (digest >> np.uint64(16)).astype(np.uint8), digest.astype(np.uint16)
            parts = [u.tobytes() + v.tobytes() for u, v in zip(np.split(upper, at[1:]), np.split(lower, at[1:]))]
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket.astype(np.int32)), pa.array(parts, pa.binary())], names=["bucket", "digests"]
            )

        for batch in batches:
            for part in words.slices(batch, "text") if batch.num_rows else ():
                found = _units(words.words(part.column(1), words.SPACED), line_words)[1]
                if len(found):
                    held.append(found)
                if sum(map(len, held)) >= HELD_DIGESTS:
                    yield packed()
                    held = []
        if held:
            yield packed()

    def compare(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        digest = np.sort(np.concatenate([_unpacked(d.as_py()) for d in table.column("digests")]))
        twice = digest[1:][digest[1:] == digest[:-1]]
        bits = np.zeros(1 << BITS - lead, bool)
        bits[twice >> np.uint32(SENT - BITS + lead)] = True
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "bits": pa.array([np.packbits(bits).tobytes()])})

    packs = docs.select("doc_id", "text").mapInArrow(pack, "bucket int, digests binary")
    found = packs.groupBy("bucket").applyInArrow(compare, "bucket int, bits binary").toArrow()
    out = np.zeros((1 << lead, 1 << BITS - 3 - lead), np.uint8)
    for bucket, bits in zip(found.column("bucket").to_pylist(), found.column("bits")):
        out[bucket] = np.frombuffer(bits.as_py(), np.uint8)
    return out.ravel()


def _marked(repeated: DataFrame) -> np.ndarray:
    """The table of bits of these digests."""
    lead = 10
    slot, within = f"shiftrightunsigned(digest, {64 - BITS})", BITS - lead
    slots = repeated.selectExpr(
        f"CAST(shiftright({slot}, {within}) AS INT) AS bucket", f"CAST({slot} & {(1 << within) - 1} AS INT) AS at"
    ).distinct()

    def mark(table: pa.Table) -> pa.Table:
        bits = np.zeros(1 << within, bool)
        bits[table.column("at").to_numpy()] = True
        return pa.table({"bucket": table.column("bucket")[:1], "bits": pa.array([np.packbits(bits).tobytes()])})

    found = slots.groupBy("bucket").applyInArrow(mark, "bucket int, bits binary").toArrow()
    out = np.zeros((1 << lead, 1 << within - 3), np.uint8)
    for bucket, bits in zip(found.column("bucket").to_pylist(), found.column("bits")):
        out[bucket] = np.frombuffer(bits.as_py(), np.uint8)
    return out.ravel()


def units(docs: DataFrame, line_words: int, bits: Broadcast, across: Broadcast | None = None) -> DataFrame:
    """The units of each document that may stand elsewhere too, by the table ``bits``: ``again``
    tells repeats within it from first occurrences. With the table ``across`` first occurrences
    go on only if their digest may stand in two documents."""

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in words.slices(batch, "text"):
            w = words.words(part.column(1), words.SPACED)
            text, digest, begin, end = _units(w, line_words)
            slot = _slot(digest)
            use = np.flatnonzero(bits.value[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1)
            use = use[np.lexsort((begin[use], digest[use], text[use]))]
            text, digest, begin, end = text[use], digest[use], begin[use], end[use]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (digest[1:] != digest[:-1])
            kept_end = end[np.flatnonzero(new)][np.cumsum(new) - 1]
            use = new | (begin >= kept_end)
            if across is not None:
                slot = _slot(digest)
                use &= ~new | (across.value[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)
            text, digest, begin, end, new = text[use], digest[use], begin[use], end[use], new[use]
            chars = words.char_offsets(w.raw)
            offset = chars[w.at[text]]
            columns = [
                part.column(0).take(pa.array(text)),
                part.column(2).take(pa.array(text)),
                pa.array(digest.view(np.int64)),
                pa.array((chars[w.start[begin]] - offset).astype(np.int32)),
                pa.array((chars[w.end[end - 1]] - offset).astype(np.int32)),
                pa.array(~new),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in UNITS.split(", ")])

    return arrow.map_batches(docs, UNITS, make)


def spans(docs: DataFrame, line_words: int = 1) -> DataFrame:
    """The removed spans: ``doc_id``, ``text_hash``, ``from``, ``until``, and the document that
    keeps the text. Lines of fewer than ``line_words`` words are no units of their own."""
    spark, docs = docs.sparkSession, _keyed(docs)
    bits = spark.sparkContext.broadcast(_repeated(docs, line_words))

    def found(across: Broadcast | None = None) -> DataFrame:
        return units(docs, line_words, bits, across).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))

    row = F.struct("doc_id", "text_hash")
    repeated = (
        found().where("not again")
        .groupBy("digest")
        .agg(F.min(row).alias("kept"), F.max(row).alias("last"))
        .where("kept < last")
        .select("digest", F.col("kept.doc_id").alias("kept"), F.col("kept.text_hash").alias("kept_hash"))
    )
    with frames.scratch(spark) as store:
        repeated = store(repeated, "repeated-units")
        across = spark.sparkContext.broadcast(_marked(repeated))
        cut = frames.stored(_spans(found(across), repeated), "repeated-spans")
    for table in (bits, across):
        table.destroy()
    return cut


def _spans(found: DataFrame, repeated: DataFrame) -> DataFrame:
    """The spans of units that are not the kept occurrence of their digest."""
    removed = (
        found.join(repeated, "digest", "left")
        .withColumn("kept", F.coalesce("kept", "doc_id"))
        .where("again or doc_id != kept or text_hash != kept_hash")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("from", "until", "kept")).alias("units"))
    )

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for doc_id, text_hash, listed in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(2)):
            values = listed.values.flatten()
            begin, until, kept = (v.to_numpy(zero_copy_only=False).astype(np.int64) for v in values)
            order = np.lexsort((until, begin))
            begin, until, kept = begin[order], until[order], kept[order]
            reach = np.maximum.accumulate(until)
            head = np.flatnonzero(np.append(True, begin[1:] > reach[:-1]))
            tail = np.append(head[1:], len(begin)) - 1
            low = np.minimum.reduceat(kept, head)
            for h, t, k in zip(head.tolist(), tail.tolist(), low.tolist()):
                rows.append(
                    (None if doc_id == NO_ID else doc_id, text_hash, int(begin[h]), int(reach[t]), t - h + 1,
                     None if k == NO_ID else k)
                )
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SPANS.split(", ")])

    return arrow.map_batches(removed, SPANS, make)


def clean(docs: DataFrame, line_words: int = 1) -> DataFrame:
    """The documents without their removed spans, with all their columns."""
    cuts = spans(docs, line_words).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    cuts = cuts.agg(F.collect_list(F.struct("from", "until")).alias("cuts"))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(F.col("text").cast("string")).alias("hash"))
    # The hash leads: it spreads rows without an id.
    on = (F.col("hash") == F.col("_hash")) & F.col("row.doc_id").cast("bigint").eqNullSafe(F.col("_id"))
    joined = rows.join(cuts, on, "left")
    text = next(k for k, name in enumerate(docs.columns) if name.lower() == "text")

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        row = batch.column(0)
        columns = list(row.flatten())
        texts = columns[text].to_pylist()
        for k, cut in enumerate(batch.column(1).to_pylist()):
            for span in sorted(cut or [], key=lambda c: -c["from"]):
                texts[k] = texts[k][: span["from"]] + texts[k][span["until"] :]
        columns[text] = pa.array(texts, columns[text].type)
        yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in row.type])

    return arrow.map_batches(joined.select("row", "cuts"), docs.schema, make)
