"""Language by string kernels: Nyström landmarks and one-versus-rest kernel ridge regression.

A text is the set of its letter runs of one, two and three letters (a blended spectrum, each
counted once). The kernel of two texts is the number of runs they share, divided by the
root of the product of their numbers of runs. Letters are folded to 64 symbols: a-z, 37
classes of the letters beyond, and one for all else, so there are at most 64 + 64² + 64³
runs and a text of any length has a bounded description.

Fitting uses a sample of at most ``PER_LANGUAGE`` labelled documents of each language, chosen
by a hash of the row; ``LANDMARKS`` of them are the landmarks. With C the kernel between
sample and landmarks and K that among landmarks, the Nyström features are C·K^(-1/2), and
ridge regression on them with targets +1 and -1 gives one machine per language. Prediction
covers every whole text: batches of texts become a 0/1 matrix over the landmarks' runs, and
two matrix products give the machines' values.

Null text and text without a letter is ``und`` with score 0, as is every text when nothing
labelled could be learned from. The score is the winning machine's value moved from -1…1 to
0…1. Equal values go to the alphabetically first language. Only ``doc_id``, ``text`` and, for
fitting, ``lang`` are read; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headrace.llm import arrow, frames, words

PER_LANGUAGE = 400
LANDMARKS = 50
RIDGE = 0.05
UNKNOWN = "und"

SYMBOLS = 64
RUNS = SYMBOLS + SYMBOLS**2 + SYMBOLS**3
ROWS = 64  # texts that are described at a time


def symbols(text: str) -> np.ndarray:
    """The folded letters of a text; 0 stands for everything that is no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    folded = np.zeros(len(points), np.int64)
    basic = (points >= 97) & (points <= 122)
    folded[basic] = points[basic] - 96
    # Beyond ASCII, everything but signs, marks and spaces of the first blocks.
    beyond = (points >= 0xC0) & (points != 0xD7) & (points != 0xF7) & ((points < 0x2000) | (points > 0x2BFF))
    folded[beyond] = 27 + points[beyond] % 37
    return folded


def present(text: str) -> np.ndarray:
    """The numbers of the runs of a text, each once, ascending."""
    s = symbols(text)
    seen = np.zeros(RUNS, bool)
    seen[s] = True
    seen[SYMBOLS + s[:-1] * SYMBOLS + s[1:]] = True
    seen[SYMBOLS + SYMBOLS**2 + (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]] = True
    seen[0] = seen[SYMBOLS] = seen[SYMBOLS + SYMBOLS**2] = False  # runs without a letter
    return np.flatnonzero(seen)


@dataclass
class Model:
    languages: list[str]
    runs: np.ndarray  # the landmarks' runs, ascending
    landmarks: np.ndarray  # runs × landmarks: 1/√n where a landmark has the run
    machines: np.ndarray  # landmarks × languages

    def values(self, found: list[np.ndarray]) -> np.ndarray:
        """The machines' values for texts given by their runs."""
        rows = np.zeros((len(found), len(self.runs)), np.float32)
        for row, ids in zip(rows, found):
            at = np.searchsorted(self.runs, ids)
            at = at[(at < len(self.runs))]
            at = at[np.isin(self.runs[at], ids, assume_unique=True)]
            row[at] = 1
        sizes = np.sqrt(np.array([max(len(f), 1) for f in found], np.float32))
        return (rows @ self.landmarks / sizes[:, None]) @ self.machines


def _kernel(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    runs = np.unique(np.concatenate([*a, *b]))

    def matrix(found: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(found), len(runs)), np.float32)
        for row, ids in zip(out, found):
            row[np.searchsorted(runs, ids)] = 1 / np.sqrt(max(len(ids), 1))
        return out

    return (matrix(a) @ matrix(b).T).astype(np.float64)


def fit_sample(sample: list[tuple[str, np.ndarray]]) -> Model | None:
    """A model from labelled texts given by their runs; the first of each language are landmarks."""
    sample = [s for s in sample if len(s[1])]
    languages = sorted({s[0] for s in sample})
    if not languages:
        return None
    chosen = [r for lang in languages for r in [s[1] for s in sample if s[0] == lang][:LANDMARKS]]
    among = _kernel(chosen, chosen)
    low, vectors = np.linalg.eigh(among)
    kept = low > 1e-6 * low.max()
    root = vectors[:, kept] / np.sqrt(low[kept])
    features = _kernel([s[1] for s in sample], chosen) @ root
    target = np.array([[1.0 if s[0] == lang else -1.0 for lang in languages] for s in sample])
    # Each language weighs the same, however many rows of it the sample has.
    share = {lang: sum(s[0] == lang for s in sample) for lang in languages}
    weight = np.array([1 / share[s[0]] for s in sample])[:, None]
    square = features.T @ (features * weight) + RIDGE / len(chosen) * np.eye(features.shape[1])
    machines = root @ np.linalg.solve(square, features.T @ (target * weight))
    runs = np.unique(np.concatenate(chosen))
    landmarks = np.zeros((len(runs), len(chosen)), np.float32)
    for k, ids in enumerate(chosen):
        landmarks[np.searchsorted(runs, ids), k] = 1 / np.sqrt(len(ids))
    return Model(languages, runs, landmarks, machines.astype(np.float32))


def _sample(docs: DataFrame) -> list[tuple[str, np.ndarray]]:
    """Runs of at most ``PER_LANGUAGE`` labelled texts of each language.

    Rows are first thinned to about twice that number by a hash, so that the ranking within
    a language sees a bounded group, however common the language is.
    """
    labelled = docs.where("lang is not null and text is not null").select(
        "lang", "text", F.xxhash64("text", "doc_id").alias("h")
    )
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return []
    most = (1 << 63) - 1
    limits = [(k, min(most, 2 * PER_LANGUAGE * most // n)) for k, n in counts.items()]
    limit = F.broadcast(docs.sparkSession.createDataFrame(limits, "lang string, most long"))
    nearest = Window.partitionBy("lang").orderBy("place", "h")
    chosen = (
        labelled.withColumn("place", F.col("h").bitwiseAND(F.lit(most)))
        .join(limit, "lang")
        .where("place <= most")
        .withColumn("nth", F.row_number().over(nearest))
        .where(F.col("nth") <= PER_LANGUAGE)
        .select("lang", "text", "nth")
    )

    def make(batch: pa.RecordBatch):
        runs = [present(t).astype(np.int32) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(runs, pa.list_(pa.int32()))],
            names=["lang", "nth", "runs"],
        )

    rows = arrow.map_batches(chosen, "lang string, nth int, runs array<int>", make).collect()
    rows.sort(key=lambda r: (r["lang"], r["nth"]))
    return [(r["lang"], np.array(r["runs"], np.int64)) for r in rows]


def fit(labelled: DataFrame) -> Model | None:
    """Learn from ``text`` and ``lang`` of a frame that also has a ``doc_id``."""
    return fit_sample(_sample(labelled))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``docs`` in their order, then ``lang_pred`` and ``score``."""
    spark = docs.sparkSession
    given = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    given = given.withColumn("letter", F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)))
    shared = spark.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part in words.slices(batch, "text"):
            texts = part.column(1).to_pylist()
            judged = np.flatnonzero(np.array(part.column(2).to_pylist(), bool) & (m is not None))
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for low in range(0, len(judged), ROWS):
                some = judged[low : low + ROWS]
                values = m.values([present(texts[i]) for i in some])
                best = values.argmax(axis=1)
                score[some] = np.clip((values[np.arange(len(some)), best] + 1) / 2, 0, 1)
                for i, k in zip(some, best):
                    lang[i] = m.languages[k]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(lang), pa.array(score, pa.float64())],
                names=["row", "lang_pred", "score"],
            )

    schema = given.select("row").schema.add("lang_pred", "string").add("score", "double")
    return arrow.map_batches(given, schema, make)


def held_out() -> F.Column:
    """The fifth of the documents that is never learned from."""
    return F.crc32(F.col("doc_id").cast("bigint").cast("string")) % 5 == 0


def classify(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every document."""
    known = docs.select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.col("lang").cast("string")
    )
    learned = known.where(~F.coalesce(held_out(), F.lit(False)))
    texts = known.select("doc_id", "text")
    out = predict(texts, fit(learned))
    return out.select("row.doc_id", "lang_pred", "score").select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def accepted(docs: DataFrame, least: float = 0.25) -> DataFrame:
    """The documents whose language is known, with all their columns.

    Rejected are ``und`` and texts that every machine puts far on the side of the rest.
    """
    known = docs.where(~F.coalesce(held_out(), F.lit(False)))
    model = fit(known.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.col("lang").cast("string")))
    judged = predict(docs, model)
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")
