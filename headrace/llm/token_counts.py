"""Token counts of every prefix, without encoding a prefix again.

For each word the dynamic programme stores the last token of every prefix; the count of a
prefix is one more than that of what lies in front of its last token. A text's count is the
sum over its words. Null text is empty: no bytes, no tokens. Only ``doc_id`` and ``text``
are read; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from headrace.llm import arrow, frames, vocabulary

# Counts are small, so more of them are kept than of encoded pieces.
COUNTED_PIECES = 400_000
TESTED_PAIRS = 600_000


def prefix_counts(vocab: vocabulary.Vocabulary, word: str) -> list[int]:
    """The number of tokens of each prefix of a word given in byte letters."""
    counts = [0] * (len(word) + 1)
    for end, found in enumerate(vocab.last_tokens(word)):
        if found is not None:
            counts[end] = counts[end - found[1]] + 1
    return counts


def _piece_count(vocab: vocabulary.Vocabulary, piece: str) -> int:
    end = vocabulary.END if vocab.suffix else ""
    return sum(prefix_counts(vocab, word + end)[-1] for word in vocab.words(piece))


def text_count(vocab: vocabulary.Vocabulary, counts: dict[str, int], text: str) -> int:
    """The tokens of a whole text; ``counts`` keeps those of pieces met before."""
    total = 0
    for part, special in vocab.segments(text):
        if special is not None:
            total += 1
            continue
        pieces = vocab.pieces.findall(part)
        try:
            total += sum([counts[p] for p in pieces])
        except KeyError:
            if len(counts) >= COUNTED_PIECES:
                counts.clear()
            for piece in pieces:
                known = counts.get(piece)
                if known is None:
                    known = _piece_count(vocab, piece)
                    if len(piece) < 256:
                        counts[piece] = known
                total += known
    return total


def _words(vocab: vocabulary.Vocabulary, text: str) -> Iterator[tuple[str, bool]]:
    for part, special in vocab.segments(text):
        if special is not None:
            yield part, True
        else:
            for piece in vocab.pieces.findall(part):
                for word in vocab.words(piece):
                    yield word, False


def cut(vocab: vocabulary.Vocabulary, text: str, budget: int) -> int:
    """The bytes of the longest run of leading tokens of a text that stays in a budget.

    For byte-level vocabularies that keep white space, whose words together are the text.
    """
    used = size = 0
    for word, special in _words(vocab, text):
        if special:
            if used + 1 > budget:
                return size
            used, size = used + 1, size + len(word.encode())
            continue
        last = vocab.last_tokens(word)
        ends, at = [], len(word)
        while at:
            ends.append(at)
            at -= last[at][1]
        if used + len(ends) > budget:
            left = budget - used
            return size + (ends[::-1][left - 1] if left else 0)
        used, size = used + len(ends), size + len(word)
    return size


def truncate(docs: DataFrame, path: str, budget: int) -> DataFrame:
    """``doc_id``, ``n_bytes`` kept and the ``text`` cut to at most ``budget`` tokens.

    The cut lies at a token border and goes back to the last whole character.
    """
    shared = vocabulary.share(docs.sparkSession, path)

    def make(batch: pa.RecordBatch):
        vocab = vocabulary.load(shared, "truncate")
        kept = []
        for text in batch.column(1).to_pylist():
            raw = (text or "").encode()
            kept.append(raw[: cut(vocab, text or "", budget)].decode(errors="ignore"))
        sizes = pa.array([len(t.encode()) for t in kept], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), sizes, pa.array(kept, pa.string())], names=["doc_id", "n_bytes", "text"]
        )

    return arrow.map_batches(frames.texts(docs), "doc_id long, n_bytes long, text string", make)


def count(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """Bytes and tokens of every document, and whether the tokens exceed a limit."""
    shared = vocabulary.share(docs.sparkSession, path)
    known: dict[str, int] = {}

    def make(batch: pa.RecordBatch):
        vocab = vocabulary.load(shared, "count")
        vocab.most_pairs = TESTED_PAIRS
        sizes, counts = [], []
        for text in batch.column(1).to_pylist():
            sizes.append(len((text or "").encode()))
            counts.append(text_count(vocab, known, text or ""))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()),
             pa.array([c > limit for c in counts], pa.bool_())],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return arrow.map_batches(frames.texts(docs), schema, make)
