"""Bounded retry: attempts, back-off, dead letters with their counts, and state that ends."""

from __future__ import annotations

import time
from datetime import datetime

import pandas as pd
import pytest

from headrace import schemas as S
from headrace import session
from headrace.operators import deadletter
from headrace.streaming import jobs, retries

RUN = datetime(2024, 2, 1, 6, 59)


class Stream:
    """Failures fed to ``outcomes`` file by file; what came out of each run."""

    def __init__(self, spark, folder, **settings):
        self.spark, self.folder, self.settings = spark, folder, settings
        spark.createDataFrame([], S.FAILURES).write.parquet(f"{folder}/in")

    def __call__(self, *failed):
        rows = [(n, "key", 1.5, "raw", "json error", data) for n, data in failed]
        out, seen = self.spark.createDataFrame(rows, S.FAILURES), []
        out.coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        source = self.spark.readStream.schema(S.FAILURES).parquet(f"{self.folder}/in")

        def keep(batch, epoch):
            seen.extend((r.outcome, r.attempts, r.sequence_number, r.data) for r in batch.collect())

        told = retries.outcomes(source, **self.settings).writeStream.foreachBatch(keep).outputMode("append")
        with session.settings(self.spark, retries.DRAINING):
            run = told.option("checkpointLocation", f"{self.folder}/state").trigger(availableNow=True).start()
        run.awaitTermination()
        return sorted(seen, key=str)


@pytest.fixture
def stream(spark, tmp_path):
    return lambda **settings: Stream(spark, str(tmp_path), **settings)


def test_attempts_are_counted_to_the_bound(stream):
    feed = stream(max_retries=3, backoff_s=0)
    assert [feed(("a", f"x{n}")) for n in range(1, 5)] == [
        [("retry", 1, "a", "x1")], [("retry", 2, "a", "x2")], [("retry", 3, "a", "x3")],
        [("dead-letter", 4, "a", "x4")],
    ]
    assert feed(("a", "x5"), ("b", None)) == [("retry", 1, "a", "x5"), ("retry", 1, "b", None)]


def test_copies_in_one_batch_and_rows_without_a_number(stream):
    feed = stream(max_retries=1, backoff_s=0)
    got = feed(("a", "x"), ("a", "x"), ("b", ""), (None, "n"), (None, "n"), ("", None))
    assert got == sorted([
        ("dead-letter", 2, "a", "x"), ("retry", 1, "b", ""), ("dead-letter", 1, None, "n"),
        ("dead-letter", 1, None, "n"), ("dead-letter", 1, "", None),
    ], key=str)


def test_a_record_costs_little():
    """The step runs once a record in trouble, so its own work must be well below Spark's."""

    class State:
        hasTimedOut = exists = False

        def update(self, value):
            self.value = value

        def setTimeoutDuration(self, millis):
            pass

    class Frame:
        def selectExpr(self, *columns):
            return self

        groupBy = selectExpr

        def applyInPandasWithState(self, step, *types):
            return step

    step = retries.outcomes(Frame(), backoff_s=0)
    page = pd.DataFrame([("a", "key", 1.5, "raw", "json error", None)], columns=S.columns(S.FAILURES))
    (out,) = step(("a", True), iter([page]), State())
    assert out.columns.tolist() == S.columns(retries.OUTCOMES)
    assert out.values.tolist() == [["retry", 1, "a", "key", 1.5, "raw", "json error", None]]

    def seconds():
        begin = time.perf_counter()
        for _ in range(200):
            list(step(("a", True), iter([page]), State()))
        return time.perf_counter() - begin

    assert min(seconds() for _ in range(3)) < 200 * 0.0012


def test_back_off_and_end_of_state(stream):
    """A record is retried when its time has come, and forgotten if it does not fail again."""
    feed = stream(max_retries=1, backoff_s=0.2, forget_s=0.2)
    assert feed(("a", "x")) == []
    time.sleep(0.3)
    assert feed(("b", "y")) == [("retry", 1, "a", "x")]
    time.sleep(0.3)
    assert feed(("c", "z")) == [("retry", 1, "b", "y")]  # and a is forgotten
    # The first attempt of a new record, not its second.
    assert feed(("a", "x2")) == [("retry", 1, "c", "z")]
    time.sleep(0.3)
    assert ("retry", 1, "a", "x2") in feed(("d", "w"))


def test_a_failing_record_goes_round_and_is_archived(spark, envelopes, tmp_path):
    root, again, dead = (f"{tmp_path}/{n}" for n in ("out", "again", "dead"))
    good = {"event_id": "1", "event_type": "order", "event_time": "2024-01-16T10:00:00Z"}
    envelopes(("good", good), ("bad", b"not json"), ("gone", None)).write.parquet(f"{tmp_path}/in")

    def process(path, name):
        jobs.process_stream(spark, path, root, f"{tmp_path}/{name}", clock=lambda: RUN).awaitTermination()

    process(f"{tmp_path}/in", "p")
    for sent in range(4):
        if sent:
            process(f"{again}/*", "q")
        jobs.retry_stream(spark, f"{root}/failures", again, dead, f"{tmp_path}/r", backoff_s=0, clock=lambda: RUN).awaitTermination()
    stored = spark.read.schema(S.DEAD_LETTER_ARCHIVE).json(deadletter.archive_path(dead))
    assert {(r.source_message_id, r.approximate_receive_count) for r in stored.collect()} == {("bad", "4"), ("gone", "4")}
    assert spark.read.parquet(f"{root}/events").count() == 1
    assert spark.read.parquet(f"{root}/failures").count() == 8


class Bucket:
    """The state of a key as Spark keeps it between the batches."""

    hasTimedOut, exists, now, get, wait = False, False, 0, None, None

    def getCurrentProcessingTimeMs(self):
        return self.now

    def update(self, value):
        self.get, self.exists = value, True

    def setTimeoutDuration(self, millis):
        self.wait = millis

    def remove(self):
        self.get, self.exists, self.wait = None, False, None


class Keyed:
    """A frame that tells the key and the step it is given."""

    def selectExpr(self, *columns):
        return self

    def groupBy(self, *key):
        self.key = key
        return self

    def applyInPandasWithState(self, step, *types):
        return self.key, step


def test_a_call_does_all_records_of_a_bucket():
    """Spark calls the step for a bucket of records, not for each: those that failed and those that are due."""
    key, step = retries.outcomes(Keyed(), max_retries=1, backoff_s=0.2, forget_s=5)
    assert key == ("_bucket", "_named")
    state = Bucket()

    def call(now, *numbers):
        page = pd.DataFrame([(n, "key", float("nan"), "raw", "why", f"{n}-{now}") for n in numbers], columns=S.columns(S.FAILURES))
        state.now, state.hasTimedOut = now, not numbers
        return [tuple(row) for frame in step((7, True), iter([page]), state) for row in frame.values.tolist()]

    def told(outcome, attempts, n, at):
        return (outcome, attempts, n, "key", None, "raw", "why", f"{n}-{at}")

    assert call(1000, "a", "b", "a", "c") == [told("dead-letter", 2, "a", 1000)] and state.wait == 200
    # What is due is done beside what failed again, with the counts of each.
    assert call(1300, "c", "d") == [told("retry", 1, "b", 1000), told("dead-letter", 2, "c", 1300)] and state.wait == 200
    assert call(1501) == [told("retry", 1, "d", 1300)] and state.wait == 6300 - 1501
    assert call(6400, "d") == [told("dead-letter", 2, "d", 6400)] and not state.exists  # b was taken for delivered


def test_records_of_a_bucket_cost_little():
    _, step = retries.outcomes(Keyed(), backoff_s=0)
    page = pd.DataFrame([(f"s{n}", "key", 1.5, "raw", "why", "data" * 100) for n in range(20_000)], columns=S.columns(S.FAILURES))
    begin, state = time.perf_counter(), Bucket()
    assert sum(map(len, step((7, True), iter([page]), state))) == 20_000
    assert time.perf_counter() - begin < 20_000 * 0.0001
    assert len(state.get[0]) < 20_000 * 50  # what was sent again is not held
