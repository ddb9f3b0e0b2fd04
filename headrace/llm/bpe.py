"""BPE encoding and decoding with a public vocabulary.

Encoding is the dynamic programme of ``vocabulary.py``. Decoding joins the vocabulary
strings of the ids the way the library does for the file. Null text is empty and has no
ids; repeated rows give repeated results; an empty table gives an empty one. Only
``doc_id`` and ``text`` are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace.llm import arrow, frames, vocabulary

SEPARATOR = b" "


def _make(vocab: vocabulary.Vocabulary):
    strings = {i: s.encode() for i, s in vocab.strings.items()}

    def value(ids: list[int]) -> tuple[bytes, bytes]:
        return np.array(ids, "<u4").tobytes(), SEPARATOR.join([strings[i] for i in ids])

    return value


def _encode_text(vocab: vocabulary.Vocabulary, make, text: str) -> tuple[bytes, bytes]:
    """The ids of a text as little-endian 32-bit integers, and the decoded text."""
    found: list[tuple[bytes, bytes]] = []
    for part, special in vocab.segments(text):
        if special is not None:
            found.append(make([special]))
        else:
            found += vocab.cached(vocab.pieces.findall(part), make)
    found = [f for f in found if f[0]]
    return b"".join([f[0] for f in found]), SEPARATOR.join([f[1] for f in found])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) and ``decoded`` of every document."""
    shared = vocabulary.share(docs.sparkSession, path)

    def make(batch: pa.RecordBatch):
        vocab = vocabulary.load(shared, "encode")
        value = _make(vocab)
        pairs = [_encode_text(vocab, value, t or "") for t in batch.column(1).to_pylist()]
        ids = [np.frombuffer(p[0], "<u4").astype(np.int32) for p in pairs]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([p[1].decode() for p in pairs])],
            names=["doc_id", "ids", "decoded"],
        )

    return arrow.map_batches(frames.texts(docs), "doc_id long, ids array<int>, decoded string", make)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``: the vocabulary strings of an id array joined by a space.

    An id outside the vocabulary has no string and is left out, as the library does. A null
    array gives an empty text. Columns keep their names; one called ``decoded`` is replaced.
    """
    spark = encoded.sparkSession
    vocab = vocabulary.Vocabulary(vocabulary.share(spark, path).value)
    rows = [(i, s) for i, s in vocab.strings.items()]  # as many as the vocabulary has
    strings = F.broadcast(spark.createDataFrame(rows, "id int, string string"))
    given = encoded.select(
        F.struct("*").alias("given"), F.col(ids).alias("ids"), F.monotonically_increasing_id().alias("number")
    )
    keyed = frames.stored(given, "decode")
    joined = (
        keyed.select("number", F.posexplode("ids").alias("at", "id"))
        .join(strings, "id")
        .groupBy("number")
        .agg(F.sort_array(F.collect_list(F.struct("at", "string"))).alias("parts"))
        .select("number", F.concat_ws(" ", F.col("parts.string")).alias("text"))
    )
    filled = F.coalesce(F.col("text"), F.lit("")).alias("text")
    out = keyed.join(joined, "number", "left").select("given", filled)
    kept = [F.col("given")[c].alias(c) for c in encoded.columns if c != "decoded"]
    return out.select(*kept, F.col("text").alias("decoded"))


def digests(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Per document the number of ids and the SHA-256 of the ids and of the decoded text.

    With ``with_ids`` the ids themselves follow, as an array.
    """
    shared = vocabulary.share(docs.sparkSession, path)

    def make(batch: pa.RecordBatch):
        vocab = vocabulary.load(shared, "digests")
        value = _make(vocab)
        counts, ids, decoded, lists = [], [], [], []
        for text in batch.column(1).to_pylist():
            raw, shown = _encode_text(vocab, value, text or "")
            counts.append(len(raw) // 4)
            ids.append(hashlib.sha256(raw).hexdigest())
            decoded.append(hashlib.sha256(shown).hexdigest())
            if with_ids:
                lists.append(np.frombuffer(raw, "<i4"))
        columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)]
        if with_ids:
            columns.append(pa.array(lists, pa.list_(pa.int32())))
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
        yield pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>"
    return arrow.map_batches(frames.texts(docs), schema, make)
