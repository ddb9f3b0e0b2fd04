"""Lines without earlier lines like them: an exact set-similarity join.

A line is the set of its words (between white space, A-Z lower-cased). Two lines are alike
if the Jaccard similarity of their sets is at least 4/5; a line is removed if an earlier one
(by ``doc_id``, null last, then by the hash of the text, then by place) is like it, removed
itself or not.

Lines of equal sets form a class, of which the first one stands for all, so a line costs the
same however many copies it has. Words are ordered by rarity: by how often they stand in all
documents, counted in ``BUCKETS`` hashed buckets, so that the counts have a fixed size. Alike
sets share one of the first n - ceil(4n/5) + 1 words of each. Rows of these prefixes are
brought together by word, and at each word every two classes are compared that pass the
filters on lengths, on what is left behind the shared word, and on a 128-bit parity of the
sets (which differs in no more bits than the sets do in words). Pairs that pass are verified by
the whole sets. All links between different classes are found: ``links`` returns them, and
``report`` tells the class of each line and how many others it is linked to.

Near copies of one line are many links, which are counted without making a row of each. Classes
that share a key of their rarest words with ``FAMILY`` or more form families; the centre of one
is the set of the words that over half of its classes have. Two sets of n and m words that differ
from one centre in d and e words differ from each other in d + e at most, and are alike if they
differ in no more than (n + m) / 9. So two classes of a family whose ``slack`` 9d - n and 9e - m sum to
0 or less are alike, whatever their words are: how many each class has of those, and which begins
first, follows from the numbers of classes by slack. Such pairs are left out of the comparison,
and every other pair goes through it. Families only decide which way a link is found.

A word with more than ``BLOCK`` prefix rows is split: its rows are dealt into blocks, and each
two blocks meet in a task of their own. Words are compared by their 64-bit values. Lines without
a word are kept. Null text has no lines. Rows equal in id and text are copies of one document,
which has one row in the report and of which each copy loses the same lines; rows of one id, or
without an id, that differ in text are different documents. An empty table gives an empty result;
``lines``, ``links`` and ``report`` need only ``doc_id`` and ``text``, and cleaning keeps columns
of any name.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headrace.llm import arrow, frames, words

BUCKETS = 1 << 19
LINE_FEED = 10
BROADCAST_LINES = 500_000  # of some 40 bytes
BLOCK = 1 << 16  # prefix rows of a word that are compared in one task
HELD_ROWS = 1 << 18  # prefix rows that are worked on together
HELD_WORDS = 1 << 20  # words of the classes of a family that are worked on together
COMPARED = 1 << 20  # pairs that are compared at once
FAMILY = 32  # classes of a key that make it a family
KEYS = 4  # of a class; near copies share most of them
ROUNDS = 2  # in which families that share classes become one
NO_SLACK = 1 << 30  # of a class without a family

# Alike: shared / union >= 4/5, or 9 * shared >= 4 * (n_a + n_b).
ALIKE = "9 * size(array_intersect(words_a, words_b)) >= 4 * (size(words_a) + size(words_b))"

# A document: its id, null last, and the hash of its text.
DOC = ("no_id", "doc_id", "key")
LINES = (
    "no_id boolean, doc_id long, key long, digest long, line int, repeats array<int>, n int, "
    "parity long, parity_2 long, prefix array<int>"
)


def _order(of: np.ndarray, rarity: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The order by line, then by rarity (8 bits), then by value.

    One key of 64 bits sorts several times faster than three; where it does not tell two
    words apart, the three are used.
    """
    if len(of) and of[-1] < 1 << 16:
        key = of.astype(np.uint64) << np.uint64(48) | rarity << np.uint64(40) | value >> np.uint64(24)
        order = np.argsort(key)
        key, sorted_ = key[order], value[order]
        if not ((key[1:] == key[:-1]) & (sorted_[1:] != sorted_[:-1])).any():
            return order
    return np.lexsort((value, rarity, of))


def _sets(w: words.Words, rarity: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Text and number of each line that has words, and its distinct words, in runs.

    The words of a line are in order of rarity, by the class of their bucket, if it is given.
    """
    text = np.repeat(np.arange(len(w.at) - 1), np.diff(w.first))
    feeds = np.cumsum(w.raw == LINE_FEED, dtype=np.int32)
    number = feeds[w.start] - np.append(np.int32(0), feeds)[w.at[text]]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (number[1:] != number[:-1])
    of = np.cumsum(new) - 1
    rank = np.zeros(len(of), np.uint64) if rarity is None else rarity[_bucket(w.value)].astype(np.uint64)
    order = _order(of, rank, w.value)
    of_word, value = of[order], w.value[order]
    use = np.ones(len(of_word), bool)
    use[1:] = (of_word[1:] != of_word[:-1]) | (value[1:] != value[:-1])
    return text[new], number[new], of_word[use], value[use]


def _bucket(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(45)).astype(np.int64)


def _lists(values: np.ndarray, first: np.ndarray, size: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The runs of values that begin at ``first`` as lists."""
    offsets = np.append(0, np.cumsum(size)).astype(np.int32)
    at = np.repeat(first - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[at], kind))


def _parities(of: np.ndarray, value: np.ndarray, n_lines: int) -> tuple[np.ndarray, np.ndarray]:
    """For two times 64 classes of words whether a set has an odd number of them."""
    if not n_lines:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    head = np.searchsorted(of, np.arange(n_lines))
    bit = np.uint64(1) << (value >> np.uint64(20) & np.uint64(63))
    second = value >> np.uint64(26) & np.uint64(1)
    halves = bit * (np.uint64(1) - second), bit * second
    return tuple(np.bitwise_xor.reduceat(h, head).view(np.int64) for h in halves)


def _digests(of: np.ndarray, value: np.ndarray, n_lines: int) -> np.ndarray:
    """A value of each set, whatever the order of its words."""
    head = np.searchsorted(of, np.arange(n_lines))
    return np.add.reduceat(words.mix(value), head) if n_lines else np.zeros(0, np.uint64)


def _rarity(docs: DataFrame) -> np.ndarray:
    """For each bucket of words a class of how often they stand in all documents.

    The number of rows and of classes is fixed; a class holds counts that differ by an eighth.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in words.slices(batch, "text"):
                found = _bucket(words.words(part.column(0), words.SPACED).value)
                total += np.bincount(found, minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["bucket", "n"]
        )

    counted = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()
    out = np.zeros(BUCKETS, np.uint64)
    n = rows.column("n").to_numpy()
    out[rows.column("bucket").to_numpy()] = np.minimum(6 * np.log2(n), 255).astype(np.uint64)
    return out.astype(np.uint8)


def _documents(docs: DataFrame) -> DataFrame:
    """The text and what tells documents apart; an id that is null reads as 0 behind ``no_id``."""
    return frames.texts(docs).select("text", *_named())


def _named(row: str = "") -> list[Column]:
    doc_id, text = F.col(f"{row}doc_id").cast("bigint"), F.col(f"{row}text").cast("string")
    values = doc_id.isNull(), F.coalesce(doc_id, F.lit(0).cast("bigint")), F.xxhash64(text)
    return [value.alias(name) for value, name in zip(values, DOC)]


def lines(docs: DataFrame) -> DataFrame:
    """The different lines of each document, with the numbers of their repeats there.

    A document without lines has one row without a digest.
    """
    docs = _documents(docs)
    rarity: Broadcast = docs.sparkSession.sparkContext.broadcast(_rarity(docs))

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in words.slices(batch, "text"):
            text, number, of, value = _sets(words.words(part.column(0), words.SPACED), rarity.value)
            digest = _digests(of, value, len(text))
            n = np.bincount(of, minlength=len(text))
            parity, parity_2 = _parities(of, value, len(text))
            # The rarest words of each line, by half their value, which is enough to meet;
            # three words or fewer are like equal sets only.
            ranked = (value >> np.uint64(32)).astype(np.uint32).view(np.int32)
            begin = np.cumsum(n) - n
            size = np.where(n > 3, n - -(-4 * n // 5) + 1, 0)
            # Lines of equal sets in one document become one row.
            by = np.lexsort((number, digest, text))
            new = np.ones(len(by), bool)
            new[1:] = (text[by][1:] != text[by][:-1]) | (digest[by][1:] != digest[by][:-1])
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(by))[: len(head)]
            first = by[head]
            empty = np.setdiff1d(np.arange(part.num_rows), text)
            none = len(empty)

            def column(values: pa.Array) -> pa.Array:
                return pa.concat_arrays([values, pa.nulls(none, values.type)])

            columns = [
                *(part.column(k).take(pa.array(np.concatenate([text[first], empty]))) for k in (1, 2, 3)),
                column(pa.array(digest[first].view(np.int64))),
                column(pa.array(number[first].astype(np.int32))),
                column(_lists(number[by].astype(np.int32), head + 1, tail - head - 1, pa.int32())),
                column(pa.array(n[first].astype(np.int32))),
                column(pa.array(parity[first])),
                column(pa.array(parity_2[first])),
                column(_lists(ranked, begin[first], size[first], pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in LINES.split(", ")])

    return arrow.map_batches(docs, LINES, make)


def _keyed(classes: DataFrame) -> DataFrame:
    """Class and key: each key is made of the least hashes of two kinds in the prefix.

    Sets of fewer than nine words have no slack, unless they are the centre themselves.
    """

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        size = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
        head = np.cumsum(size) - size
        word = batch.column(1).flatten().to_numpy().view(np.uint32).astype(np.uint64)
        for kind in range(KEYS):
            mixed = words.mix(word | np.uint64(kind << 32))
            upper = np.minimum.reduceat(mixed >> np.uint64(32), head)
            lower = np.minimum.reduceat(mixed & np.uint64(0xFFFFFFFF), head)
            key = words.mix(upper << np.uint64(32) | lower)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(key.view(np.int64))], names=["digest", "key"])

    return arrow.map_batches(classes.where("n >= 9").select("digest", "prefix"), "digest long, key long", make)


def _families(classes: DataFrame, store: frames.Store) -> DataFrame | None:
    """The ``family`` of each class that shares a key with many, None if there is no such key.

    A class takes the largest of its keys. In each round a key takes the family that most of its
    classes have, and a class the largest family of its keys.
    """
    keys = _keyed(classes)
    many = store(keys.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") >= FAMILY), "line-keys")
    if many.isEmpty():
        return None
    held = store(keys.join(many, "key"), "line-keys-held")
    largest = F.max(F.struct("size", "family")).alias("most")
    chosen = held.withColumn("family", F.col("key")).groupBy("digest").agg(largest).select("digest", "most.*")
    for _ in range(ROUNDS):
        chosen = store(chosen, "line-families")
        of_key = held.select("key", "digest").join(chosen, "digest").groupBy("key", "family", "size").count()
        of_key = of_key.groupBy("key").agg(F.max(F.struct("count", "size", "family")).alias("most"))
        of_key = of_key.select("key", "most.size", "most.family")
        chosen = held.select("key", "digest").join(of_key, "key").groupBy("digest").agg(largest).select("digest", "most.*")
    return store(chosen.select("digest", "family"), "line-families")


def _measured(rows: pa.Table, known: tuple[int, np.ndarray]) -> tuple[np.ndarray, tuple[int, np.ndarray]]:
    """The slack of each row, and the last family with its centre.

    Rows are in order of family. A family that goes on from ``known`` keeps its centre.
    """
    family = rows.column("family").to_numpy()
    sets = rows.column("words").combine_chunks()
    n = sets.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    value = sets.flatten().to_numpy()
    new = np.append(True, family[1:] != family[:-1])
    of = np.repeat(np.cumsum(new) - 1, n)
    order = np.lexsort((value, of))
    first = np.ones(len(order), bool)
    first[1:] = (of[order][1:] != of[order][:-1]) | (value[order][1:] != value[order][:-1])
    head = np.flatnonzero(first)
    often = 2 * np.diff(np.append(head, len(order))) > np.bincount(np.cumsum(new) - 1)[of[order][head]]
    centre = np.bincount(of[order][head][often], minlength=int(new.sum()))
    inside = np.empty(len(order), bool)
    inside[order] = often[np.cumsum(first) - 1]
    if known[0] == family[0]:
        inside[of == 0] = np.isin(value[of == 0], known[1])
        centre[0] = len(known[1])
    shared = np.add.reduceat(inside, np.cumsum(n) - n, dtype=np.int64)
    slack = 9 * (n + centre[np.cumsum(new) - 1] - 2 * shared) - n
    if known[0] != family[-1]:
        last = often & (of[order][head] == of[-1])
        known = int(family[-1]), value[order][head][last]
    return slack.astype(np.int32), known


def _slacks(docs: DataFrame, classes: DataFrame, store: frames.Store) -> DataFrame | None:
    """``family``, ``slack`` and first place of the classes of families.

    A family's classes go through one task, which holds ``HELD_WORDS`` of them; the centre of one
    with more is that of those it holds first.
    """
    families = _families(classes, store)
    if families is None:
        return None
    names = ["digest", "family", "slack", *DOC, "line"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        known = (0, np.zeros(0, np.int64))

        def measured(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal known
            slack, known = _measured(rows, known)
            rows = rows.append_column("slack", pa.array(slack)).select(names)
            yield from rows.to_batches()

        n_held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n_held += len(batch.column(batch.schema.get_field_index("words")).flatten())
            if n_held < HELD_WORDS:
                continue
            rows = pa.Table.from_batches(held)
            family = rows.column("family").to_numpy()
            cut = int(np.searchsorted(family, family[-1])) or len(family)  # the last family may go on
            yield from measured(rows.slice(0, cut))
            held = rows.slice(cut).to_batches()
            n_held = sum(len(b.column(b.schema.get_field_index("words")).flatten()) for b in held)
        if held:
            yield from measured(pa.Table.from_batches(held))

    sets = _word_rows(docs, classes.join(families, "digest"), store)
    schema = "digest long, family long, slack int, no_id boolean, doc_id long, key long, line int"
    found = sets.repartition("family").sortWithinPartitions("family").mapInArrow(run, schema)
    found = found.dropDuplicates(["digest"]).select("digest", "family", "slack", F.struct(*DOC, "line").alias("first"))
    return store(found, "line-slacks")


def _counted(slacks: DataFrame) -> DataFrame:
    """For each class its ``links`` inside its family that follow from the slacks alone, and whether
    one of those begins earlier.

    The classes of a family are put together by slack, of which there are few.
    """
    by_slack = slacks.groupBy("family", "slack").agg(F.count("*").alias("n"), F.min("first").alias("first"))
    listed = by_slack.groupBy("family").agg(F.collect_list(F.struct("slack", "n", "first")).alias("listed"))
    fits = "filter(listed, o -> o.slack + a.slack <= 0)"
    sums = listed.selectExpr(
        "family",
        f"inline(transform(listed, a -> struct(a.slack as slack, aggregate({fits}, 0L, (s, o) -> s + o.n) as links, "
        f"array_min(transform({fits}, o -> o.first)) as earliest)))",
    )
    return slacks.join(sums, ["family", "slack"]).selectExpr(
        "digest", "links - if(slack <= 0, 1, 0) as links", "coalesce(earliest < first, false) as later"
    )


_ROW = ("word", "digest", "place", "n", "parity", "parity_2", "family", "slack")
PAIRS = "digest_a long, digest_b long"


def _passes(rows: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that pass the filters on lengths, on words left behind the shared one and on
    parity, and are not counted by their slack."""
    both = rows["n"][a] + rows["n"][b]
    need = -(-4 * both // 9)
    ok = np.minimum(rows["left"][a], rows["left"][b]) >= need
    ok &= rows["digest"][a] != rows["digest"][b]
    ok &= (rows["family"][a] != rows["family"][b]) | (rows["slack"][a] + rows["slack"][b] > 0)
    a, b, most = a[ok], b[ok], (both - 2 * need)[ok]
    for parity in ("parity", "parity_2"):
        differing = np.bitwise_count((rows[parity][a] ^ rows[parity][b]).view(np.uint64))
        ok = differing <= most
        a, b, most = a[ok], b[ok], most[ok] - differing[ok]
    return a, b


def _pairs(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each of ``a`` with all places from its ``low`` to its ``high``, some at a time."""
    size = np.maximum(high - low, 0)
    done = np.append(0, np.cumsum(size))
    begin = 0
    while begin < len(a):
        end = max(begin + 1, int(np.searchsorted(done, done[begin] + COMPARED, "right")) - 1)
        n = size[begin:end]
        first = np.repeat(low[begin:end] - done[begin:end] + done[begin], n)
        yield np.repeat(a[begin:end], n), first + np.arange(len(first))
        begin = end


def _compared(rows: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one word that pass, some at a time.

    Each row is compared with those before it in the order of word and length, from the first
    one that is long enough. Rows of one family with a slack of 0 or less need no comparison among
    each other: they come last, and are compared with the others of fitting length, and with
    those of the families before theirs.
    """
    run = np.cumsum(np.append(0, rows["word"][1:] != rows["word"][:-1])) << 32
    inner = rows["slack"] <= 0
    outer = len(inner) - int(inner.sum())
    if outer == len(inner):
        order = np.argsort(run | rows["n"])
    else:
        order = np.lexsort((rows["n"], np.where(inner, rows["family"], 0), run, inner))
    rows, run = {c: v[order] for c, v in rows.items()}, run[order]
    rows["left"] = rows["n"] - rows["place"]
    length, places = run[:outer] | rows["n"][:outer], np.arange(len(run))

    def longer(of: slice) -> np.ndarray:
        return np.searchsorted(length, run[of] | -(-4 * rows["n"][of] // 5))

    some, rest = slice(0, outer), slice(outer, None)
    new = np.ones(len(run) - outer, bool)
    new[1:] = (run[rest][1:] != run[rest][:-1]) | (rows["family"][rest][1:] != rows["family"][rest][:-1])
    begin = places[rest][new][np.cumsum(new) - 1]
    meetings = (
        (places[some], longer(some), places[some]),
        (places[rest], longer(rest), np.searchsorted(length, run[rest] | 5 * rows["n"][rest] // 4, "right")),
        (places[rest], outer + np.searchsorted(run[rest], run[rest]), begin),
    )
    for meeting in meetings:
        for a, b in _pairs(*meeting):
            a, b = _passes(rows, a, b)
            if len(a):
                yield rows["digest"][a], rows["digest"][b]


def _candidates(classes: DataFrame, store: frames.Store) -> DataFrame:
    """All pairs of classes that pass at a word of both prefixes, each pair once."""
    prefixes = classes.select(F.posexplode("prefix").alias("place", "word"), *_ROW[1:2], *_ROW[3:]).select(*_ROW)
    many = (
        prefixes.groupBy(F.expr("shiftrightunsigned(word, 13)").alias("bucket"))
        .agg(F.count("*").alias("n_bucket"))
        .where(F.col("n_bucket") > BLOCK)
        .select("bucket", F.ceil(F.col("n_bucket") / BLOCK).cast("int").alias("blocks"))
    )
    many = store(many, "line-words")
    if not many.isEmpty():
        prefixes = _split(prefixes, many)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n_held = 0

        def pairs() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            rows = {c: table.column(c).to_numpy() for c in _ROW}
            rows |= {c: rows[c].astype(np.int64) for c in ("place", "n", "slack")}
            for a, b in _compared(rows):
                sides = [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))]
                yield pa.RecordBatch.from_arrays(sides, names=["digest_a", "digest_b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            word = batch.column(0).to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(word, word[-1]))  # the last word may go on
            if cut and n_held + cut >= HELD_ROWS:
                held.append(batch.slice(0, cut))
                yield from pairs()
                held, n_held, batch = [], 0, batch.slice(cut)
            held.append(batch)
            n_held += batch.num_rows
        if held:
            yield from pairs()

    # One integer key sorts fastest; the rows of a word are put in order where they are compared.
    together = prefixes.repartition("word").sortWithinPartitions("word")
    return store(together.mapInArrow(run, PAIRS).distinct(), "line-pairs")


def _split(prefixes: DataFrame, many: DataFrame) -> DataFrame:
    """Prefix rows in which words of crowded buckets are replaced by pairs of blocks.

    A row goes to the pairs that hold its block, so each two rows of a word meet. ``many`` has
    at most a row for each of the 2^19 buckets. Words that get the same value by chance only
    give pairs that are not confirmed.
    """
    return (
        prefixes.join(F.broadcast(many), F.expr("shiftrightunsigned(word, 13) = bucket"), "left")
        .withColumn("block", F.expr("if(blocks is null, 0, pmod(xxhash64(digest), blocks))"))
        .withColumn("other", F.explode(F.expr("sequence(0, coalesce(blocks, 1) - 1)")))
        .withColumn(
            "word",
            F.expr("if(blocks is null, word, hash(word, least(block, other), greatest(block, other)))"),
        )
        .select(*_ROW)
    )


def _word_rows(docs: DataFrame, classes: DataFrame, store: frames.Store) -> DataFrame:
    """The words of the given classes, and where they stand first, read from the texts again.

    Copies of a document each have the rows.
    """
    wanted = store(
        classes.groupBy(*DOC).agg(F.collect_list(F.struct("line", "digest", "family")).alias("wanted")),
        "lines-wanted",
    )
    size = wanted.agg(F.sum(F.size("wanted"))).first()[0] or 0
    side = F.broadcast(wanted) if size <= BROADCAST_LINES else wanted
    chosen = _documents(docs).join(side, list(DOC)).select("text", *DOC, "wanted")

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in words.slices(batch, "text"):
            text, number, of_word, value = _sets(words.words(part.column(0), words.SPACED))
            n = np.bincount(of_word, minlength=len(text))
            asked = part.column(4).flatten()
            sizes = part.column(4).value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(part.num_rows), sizes)
            line = asked.field("line").to_numpy(zero_copy_only=False)
            at = np.searchsorted(text.astype(np.int64) << 32 | number, row.astype(np.int64) << 32 | line)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(k).take(pa.array(row)) for k in (1, 2, 3)), asked.field("line"),
                 asked.field("digest"), asked.field("family"),
                 _lists(value.view(np.int64), (np.cumsum(n) - n)[at], n[at], pa.int64())],
                names=[*DOC, "line", "digest", "family", "words"],
            )

    schema = "no_id boolean, doc_id long, key long, line int, digest long, family long, words array<long>"
    return arrow.map_batches(chosen, schema, make)


def _links(docs: DataFrame, classes: DataFrame, slacks: DataFrame | None, store: frames.Store) -> DataFrame:
    """Each two classes whose sets are alike, once, and which of them begins later.

    Those that are counted by their slack are left out.
    """
    if slacks is None:
        grouped = classes.selectExpr("*", "0L as family", f"{NO_SLACK} as slack")
    else:
        grouped = classes.join(slacks.drop("first"), "digest", "left").fillna({"family": 0, "slack": NO_SLACK})
    pairs = _candidates(grouped, store)
    asked = pairs.selectExpr("explode(array(digest_a, digest_b)) as digest").distinct()
    # The copies of a document differ in nothing, so any of them stands for all. Both sides of the
    # join need the same columns, and their shuffle is made once.
    sets = _word_rows(docs, grouped.join(asked, "digest", "left_semi"), store).groupBy("digest").agg(
        F.first(F.struct(*DOC, "line")).alias("first"), F.first("words").alias("words")
    )

    def named(side: str) -> DataFrame:
        return sets.select(*(F.col(c).alias(f"{c}_{side}") for c in sets.columns))

    found = pairs.join(named("a"), "digest_a").join(named("b"), "digest_b").where(ALIKE)
    return found.selectExpr("digest_a", "digest_b", "first_a > first_b as a_later")


def _found(docs: DataFrame, store: frames.Store) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """Lines, classes, links one by one, and the slacks that tell the other ones."""
    found = store(lines(docs), "lines")
    classes = (
        found.where("digest is not null")
        .groupBy("digest")
        .agg(F.min(F.struct(*DOC, "line", "n", "parity", "parity_2", "prefix")).alias("first"))
        .select("digest", "first.*")
    )
    classes = store(classes, "line-classes")
    slacks = _slacks(docs, classes, store)
    return found, classes, store(_links(docs, classes, slacks, store), "line-links"), slacks


def _outcome(docs: DataFrame, store: frames.Store) -> DataFrame:
    """Rows of ``lines`` with ``kept``, ``near`` and ``links``: whether the first one of the row stays,
    whether it goes for a line that is alike but not equal, and to how many classes its own is linked."""
    found, classes, links, slacks = _found(docs, store)
    linked = links.selectExpr("inline(array(struct(digest_a as digest, 1L as links, a_later as later), "
                              "struct(digest_b as digest, 1L as links, not a_later as later)))")  # fmt: skip
    if slacks is not None:
        linked = linked.unionByName(_counted(slacks))
    linked = linked.groupBy("digest").agg(F.sum("links").alias("links"), F.bool_or("later").alias("near"))
    classes = store(
        classes.select("digest", F.struct(*DOC).alias("first"))
        .join(linked, "digest", "left")
        .fillna({"links": 0, "near": False}),
        "line-outcome",
    )
    return (
        found.drop("parity", "parity_2", "prefix", "n")
        .join(classes, "digest", "left")
        .withColumn("kept", F.coalesce((F.col("first") == F.struct(*DOC)) & ~F.col("near"), F.lit(True)))
    )


def links(docs: DataFrame) -> DataFrame:
    """All links: each two classes of lines that are alike but not equal, once.

    ``line_a`` and ``line_b`` are the places of their first lines, the earlier one first.
    """
    with frames.scratch(docs.sparkSession) as store:
        _, classes, linked, slacks = _found(docs, store)
        if slacks is not None:
            near = {s: slacks.selectExpr(f"digest as digest_{s}", "family", f"slack as slack_{s}", f"first as first_{s}")
                    for s in "ab"}
            near = near["a"].join(near["b"], "family").where("slack_a + slack_b <= 0 and digest_a < digest_b")
            linked = linked.unionByName(near.selectExpr("digest_a", "digest_b", "first_a > first_b as a_later"))
        place = "struct(if(no_id, null, doc_id) as doc_id, line)"
        of = {s: classes.selectExpr(f"digest as digest_{s}", f"{place} as line_{s}") for s in "ab"}
        pairs = linked.selectExpr(
            "if(a_later, digest_b, digest_a) as digest_a", "if(a_later, digest_a, digest_b) as digest_b"
        )
        joined = pairs.join(of["a"], "digest_a").join(of["b"], "digest_b")
        return frames.stored(joined.select("digest_a", "line_a", "digest_b", "line_b"), "line-links")


def report(docs: DataFrame) -> DataFrame:
    """Per document its lines with words, the numbers (from 0) of those removed, and its ``classes``.

    Those have a row for each different line: where it stands first, its class, and how many
    other classes are alike.
    """
    gone = "if(digest is null, cast(array() as array<int>), if(kept, repeats, concat(array(line), repeats)))"
    with frames.scratch(docs.sparkSession) as store:
        found = _outcome(docs, store)
        rows = found.selectExpr(
            *DOC, "digest", "repeats", f"{gone} as gone", "not kept and near as near",
            "if(digest is null, null, struct(line, digest as class, links)) as class",
        )
        return frames.stored(_by_document(rows), "line-report")


def _by_document(rows: DataFrame) -> DataFrame:
    return (
        rows
        .groupBy(*DOC)
        .agg(
            # Copies of a document repeat its rows.
            F.collect_set(F.struct("digest", "repeats", "gone", "near", "class")).alias("rows"),
        )
        .select(
            F.expr("if(no_id, null, doc_id)").alias("doc_id"),
            F.expr("aggregate(rows, 0L, (s, r) -> s + if(r.digest is null, 0, 1 + size(r.repeats)))").alias("n_lines"),
            F.array_sort(F.flatten("rows.gone")).alias("removed_lines"),
            F.expr("cast(size(filter(rows, r -> r.near)) as long)").alias("n_near"),
            F.expr("array_sort(filter(rows.class, c -> c is not null))").alias("classes"),
        )
        .select(
            "doc_id", "n_lines", F.size("removed_lines").cast("long").alias("n_removed"), "n_near",
            F.expr("aggregate(classes, 0L, (s, c) -> s + c.links)").alias("n_links"), "removed_lines", "classes",
        )
    )


def clean(docs: DataFrame) -> DataFrame:
    """The documents without removed lines, with all their columns.

    A document that had words and has lost them all is dropped.
    """
    with frames.scratch(docs.sparkSession) as store:
        gone = _outcome(docs, store).where("not kept")
        gone = gone.groupBy(*(F.col(c).alias(f"_{c}") for c in DOC)).agg(F.collect_set("digest").alias("gone"))
        gone = frames.stored(gone, "lines-gone")
    joined = docs.select(F.struct("*").alias("row")).select("row", F.col("row.text").cast("string").alias("text"))
    same = [value == F.col(f"_{name}") for value, name in zip(_named("row."), DOC)]
    joined = joined.join(gone, functools.reduce(lambda x, y: x & y, same), "left")
    place = next(k for k, name in enumerate(docs.columns) if name.lower() == "text")

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in words.slices(batch, "text"):
            row, texts = part.column(0), part.column(1).to_pylist()
            text, number, of, value = _sets(words.words(part.column(1), words.SPACED))
            digest = _digests(of, value, len(text)).view(np.int64)
            stays = np.ones(part.num_rows, bool)
            for k, listed in enumerate(part.column(2).to_pylist()):
                low, high = np.searchsorted(text, [k, k + 1])
                seen, dropped = set(listed or ()), set()
                for d, at in zip(digest[low:high].tolist(), number[low:high].tolist()):
                    if d in seen:
                        dropped.add(at)
                    seen.add(d)
                if dropped:
                    kept = [s for at, s in enumerate(texts[k].split("\n")) if at not in dropped]
                    texts[k] = "\n".join(kept)
                    stays[k] = len(dropped) < high - low
            columns = list(row.flatten())
            columns[place] = pa.array(texts, columns[place].type)
            out = pa.RecordBatch.from_arrays(columns, names=[f.name for f in row.type])
            yield out.filter(pa.array(stays))

    return arrow.map_batches(joined.select("row", "text", "gone"), docs.schema, make)
