"""Alignment of two tokenizations of the same text, and how well they agree over the corpus.

A text is encoded with a byte-level vocabulary (A, a space put in front) and a sentence-piece one
(B, which adds that space itself). Special strings inside texts are plain text. Every token is
given its bytes; a text whose tokens of A or of B do not spell the space and the text, a null
and an empty one have no tokens.

The byte offsets where tokens of A and of B both end cut a text into groups. They are found by
divide and conquer: in an interval, the middle token end of A is looked up among the ends of B
by bisection, then those around it, in windows that double, until one is common; the interval
is cut there, and both halves are treated alike. An interval without a common end inside is a
group. All intervals of a batch of texts take their steps together, in numpy.

In a group of p and q tokens p + q - 1 pairs overlap: these are the links. The id pairs of a
document, each once with its number of links, are stored, counted by an aggregation that is
combined in the tasks, and the counts joined back to them. A pair's count is the number of
documents that hold it; the best partners of an id are those with its highest count. The counts
are broadcast only while they are at most ``BROADCAST_PAIRS`` rows of two numbers, otherwise both
sides are shuffled, where adaptive execution splits the frequent pairs.

Rows that repeat are documents of their own, also with one ``doc_id`` or none. An empty table
gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace.llm import arrow, frames, vocabulary, words

BROADCAST_PAIRS = 1 << 20
SPACE_MARK = "▁"  # fixed value: a space in sentence pieces
ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<int>, times array<int>"
)
SLICE_BYTES = 1 << 18


# Texts of signs whose classes all versions of Unicode agree on, without very long runs: the
# two libraries for byte-level vocabularies split them alike.
SETTLED = re.compile("[\\x00-\u024f\u2010-\u2027]*")
LONG_RUN = re.compile(r"\s{500}|\S{500}")


class Pieces:
    """A sentence-piece model: ids of texts, and the bytes of each id."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [self._spelled(i, name) for i, name in enumerate(names)]

    def _spelled(self, i: int, name: str) -> bytes:
        return bytes([int(name[1:-1], 16)]) if self.model.is_byte(i) else name.replace(SPACE_MARK, " ").encode()

    def encode(self, text: str) -> tuple[np.ndarray, bytes]:
        """Ids and their bytes, of a text with a space in front, which the model puts there itself."""
        ids = self.model.encode(text[1:], num_threads=1)
        return np.array(ids, np.int64), b"".join([self.bytes[i] for i in ids])


class Plain:
    """A byte-level vocabulary that takes special strings as plain text."""

    def __init__(self, text: str):
        self.vocab = vocabulary.Vocabulary(text)
        self.vocab.special = {}
        byte = {letter: b for b, letter in vocabulary._SHOWN.items()}
        size = max(self.vocab.strings) + 1
        spelled = [self.vocab.strings.get(i, "") for i in range(size)]
        plain = [all(c in byte for c in s) for s in spelled]
        self.bytes = [bytes(byte[c] for c in s) if p else s.encode() for s, p in zip(spelled, plain)]
        data = json.loads(text)
        merges = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        made = [data["model"]["vocab"][a + b] for a, b in merges]
        extra = {t["content"] for t in data["added_tokens"]}
        ranks = {self.bytes[i]: i for s, i in data["model"]["vocab"].items() if s not in extra}
        # Where ids are the order of the merges, ranks alone give the ids.
        self.fast = None
        if made == list(range(len(ranks) - len(made), len(ranks))):
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    def encode(self, text: str) -> tuple[np.ndarray, bytes]:
        if self.fast is not None and SETTLED.fullmatch(text) and not LONG_RUN.search(text):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.vocab.ids(text)
        return np.array(ids, np.int64), b"".join([self.bytes[i] for i in ids])


_loaded: dict[str, "Aligner"] = {}


def _load(shared: tuple[Broadcast, Broadcast]) -> "Aligner":
    """The tokenizers in this worker."""
    key = hashlib.sha256(shared[0].value + shared[1].value).hexdigest()
    if key not in _loaded:
        _loaded[key] = Aligner(Plain(shared[0].value.decode()), Pieces(shared[1].value))
    return _loaded[key]


def _share(spark: SparkSession, path: str) -> Broadcast:
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def cuts(end_a: np.ndarray, end_b: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The tokens of A whose end is an end of B, by divide and conquer.

    ``end_a`` and ``end_b`` grow from text to text, ``first`` is the first token of A of each
    text and, at last, their number. The last token of a text is always a cut.
    """
    low, high = first[:-1], first[1:]  # tokens of an interval; the end of its last one is a cut
    some = high > low
    low, high = low[some], high[some]
    out = [high - 1]

    def common(token: np.ndarray) -> np.ndarray:
        at = np.searchsorted(end_b, end_a[token])
        return end_b[np.minimum(at, len(end_b) - 1)] == end_a[token]

    while len(low):
        wide = high - low > 1
        low, high = low[wide], high[wide]
        inner = high - 1  # tokens from low to before inner may be cuts
        middle = (low + inner) >> 1
        cut = np.where(common(middle), middle, -1) if len(low) else middle
        reach, open_ = 1, np.flatnonzero(cut < 0)
        seen = np.zeros(len(low), np.int64)  # reach that was looked at
        while len(open_):
            # The tokens on both sides that were not looked at, nearest first.
            size = np.minimum(reach, np.maximum(middle[open_] - low[open_], inner[open_] - 1 - middle[open_]))
            step = size - seen[open_]
            owner = np.repeat(np.arange(len(open_)), step)
            away = np.arange(len(owner)) - np.repeat(np.cumsum(step) - step, step) + 1 + seen[open_][owner]
            best = np.full(len(open_), np.iinfo(np.int64).max)
            for side in (-1, 1):
                token = middle[open_][owner] + side * away
                use = np.flatnonzero((token >= low[open_][owner]) & (token < inner[open_][owner]))
                hit = use[common(token[use])]
                np.minimum.at(best, owner[hit], 2 * away[hit] + (side > 0))
            got = best < np.iinfo(np.int64).max
            distance = (best[got] >> 1) * np.where(best[got] & 1, 1, -1)
            cut[open_[got]] = middle[open_[got]] + distance
            done = ~got & (size < reach)  # every token was looked at
            seen[open_] = size
            open_ = open_[~got & ~done]
            reach *= 2
        split = cut >= 0
        low, high, cut = low[split], high[split], cut[split]
        out.append(cut)
        low, high = np.concatenate([low, cut + 1]), np.concatenate([cut + 1, high])
    return np.sort(np.concatenate(out))


def _joined(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    first = np.cumsum([0, *map(len, ids)])
    return np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64), first


def _signs(table: list[bytes], within: str, last: str) -> list[str]:
    return [f"{i}{within}" for i in range(len(table))] + [f"{i}{last}" for i in range(len(table))]


class Aligner:
    def __init__(self, a: Plain, b: Pieces):
        self.a, self.b = a, b
        self.size_a = np.array([len(x) for x in a.bytes], np.int64)
        self.size_b = np.array([len(x) for x in b.bytes], np.int64)
        # How a token is written, inside its group and at the end of its side of the group.
        self.signs = _signs(a.bytes, ",", "|") + _signs(b.bytes, ",", ";")

    def _ids(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        none = np.zeros(0, np.int64)
        out = [none] * len(texts), [none] * len(texts)
        for k, text in enumerate(texts):
            if not text:
                continue
            given = " " + text
            raw = given.encode()
            (a, spelled_a), (b, spelled_b) = self.a.encode(given), self.b.encode(given)
            if spelled_a == raw and spelled_b == raw:
                out[0][k], out[1][k] = a, b
        return out

    def align(self, texts: list[str | None]) -> dict[str, object]:
        """For each text its tokens, groups and links, and its id pairs."""
        ids_a, ids_b = self._ids(texts)
        (a, first_a), (b, first_b) = _joined(ids_a), _joined(ids_b)
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        cut_a = cuts(end_a, end_b, first_a)
        cut_b = np.searchsorted(end_b, end_a[cut_a])
        n_groups = np.diff(np.searchsorted(cut_a, first_a))
        # Links: the tokens of B from the one that a token of A begins in to the one it ends in.
        until = np.searchsorted(end_b, end_a)
        both = np.zeros(len(a), np.int64)
        both[cut_a] = 1
        low = np.append(0, until + both)[:-1][: len(a)]
        size = until + 1 - low
        text = np.repeat(np.arange(len(texts)), np.diff(first_a))
        to = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
        key = np.repeat(text << 32 | a << 16, size) | b[to]
        pair, times = np.unique(key, return_counts=True)
        return {
            "n_a": np.diff(first_a),
            "n_b": np.diff(first_b),
            "n_groups": n_groups,
            "n_links": np.bincount(pair >> 32, weights=times, minlength=len(texts)).astype(np.int64),
            "groups": self._written(a, b, cut_a, cut_b, first_a, first_b),
            "pairs": (pair & 0xFFFFFFFF).astype(np.uint32).view(np.int32),
            "times": times.astype(np.int32),
            "of": np.searchsorted(pair >> 32, np.arange(len(texts) + 1)),
        }

    def _written(self, a, b, cut_a, cut_b, first_a, first_b) -> list[str]:
        """The groups of each text: ids of A, a bar, ids of B; groups apart by semicolons."""
        n_a, n_b = len(self.size_a), len(self.size_b)
        sign_a, sign_b = a.copy(), b + 2 * n_a
        sign_a[cut_a] += n_a
        sign_b[cut_b] += n_b
        group_a = np.repeat(np.arange(len(cut_a)), np.diff(cut_a, prepend=-1))
        group_b = np.repeat(np.arange(len(cut_b)), np.diff(cut_b, prepend=-1))
        order = np.empty(len(a) + len(b), np.int64)
        # In front of a token of A are the tokens of B of earlier groups, and the other way round.
        order[np.arange(len(a)) + np.append(0, cut_b + 1)[group_a]] = sign_a
        order[np.arange(len(b)) + (cut_a + 1)[group_b]] = sign_b
        signs, first = self.signs, first_a + first_b
        return [
            "".join([signs[s] for s in order[low:high].tolist()])[:-1] for low, high in zip(first[:-1], first[1:])
        ]


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Every document with its numbers of tokens, groups and links and its id pairs (A's id in the
    upper 16 bits), each with the number of its links."""
    shared = _share(docs.sparkSession, path_a), _share(docs.sparkSession, path_b)

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        aligner = _load(shared)
        for part in words.slices(batch, "text", SLICE_BYTES):
            found = aligner.align(part.column(1).to_pylist())
            of = pa.array(found["of"].astype(np.int32))
            columns = [part.column(0)]
            columns += [pa.array(found[c].astype(np.int64)) for c in ("n_a", "n_b", "n_groups", "n_links")]
            columns += [
                pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found["groups"]]),
                pa.ListArray.from_arrays(of, pa.array(found["pairs"])),
                pa.ListArray.from_arrays(of, pa.array(found["times"])),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ALIGNED.split(", ")])

    return arrow.map_batches(frames.texts(docs), ALIGNED, make)


def pair_counts(stored: DataFrame) -> DataFrame:
    """``pair``, the number of documents that hold it, and whether no pair of its id of A has more."""
    counts = stored.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count"))
    a = "shiftrightunsigned(pair, 16)"
    # An id of A has at most as many partners as B has ids.
    most = counts.groupBy(F.expr(a).alias("a")).agg(F.max("count").alias("most"))
    return counts.withColumn("a", F.expr(a)).join(most, "a").selectExpr("pair", "count", "count = most as best")


def report(docs: DataFrame, path_a: str, path_b: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per document its tokens, groups and links, how many links are best, and the sum of counts."""
    with frames.scratch(docs.sparkSession) as store:
        rows = aligned(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id())
        rows = store(rows, "aligned")
        counts = store(pair_counts(rows), "pair-counts")
        side = F.broadcast(counts) if counts.count() <= broadcast_pairs else counts
        links = rows.select("row", F.expr("inline(arrays_zip(pairs, times))")).withColumnRenamed("pairs", "pair")
        sums = (
            links.join(side, "pair")
            .groupBy("row")
            .agg(
                F.sum(F.expr("if(best, times, 0)")).cast("long").alias("n_best"),
                F.sum(F.expr("times * count")).cast("long").alias("count_sum"),
            )
        )
        out = rows.drop("pairs", "times").join(sums, "row", "left")
        return frames.stored(
            out.selectExpr(
                "doc_id", "n_a", "n_b", "n_groups", "n_links", "coalesce(n_best, 0) as n_best",
                "coalesce(count_sum, 0) as count_sum", "groups_sha256",
            ),
            "alignment",
        )
