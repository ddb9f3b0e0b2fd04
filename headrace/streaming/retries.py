"""Bounded retry of failed records as keyed state of a stream.

A record is known by its sequence number. Its state counts the failed attempts and holds what
was received last until the back-off is over. The attempt after the last retry gives it up: it
becomes a dead letter with its true number of attempts, and its state is gone. A record that
does not fail again within ``forget_s`` after a retry is taken for delivered, and its state
goes as well, so the state holds records in trouble and no others.

Rows without a sequence number can't be told from each other and are given up at once. Null
and empty data are retried as they are. A record that fails again after it was given up is a
new one. Copies of one number are read in batches and kept as a count and the last one.

Spark calls the step once for a key, which costs it far more than the work for a record. So the
key of the state is one of ``BUCKETS`` buckets of sequence numbers, and a call does all records
of its bucket: those that failed again, and those whose time has come. A bucket's records are
one text, read and written as a whole; its timer is the earliest of theirs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from headrace import schemas as S

RETRY, DEAD = "retry", "dead-letter"
OUTCOMES = f"outcome string, attempts int, {S.FAILURES}"
# Timers ask for batches without data for ever, so a run that drains its source has none of them.
DRAINING = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}
_FIELDS = S.columns(S.FAILURES)
# A sequence number's attempts, the time (ms) at which something is due, and what is sent again then.
_STATE = "records string"
# As long as a checkpoint lives, since a record must find its bucket again.
BUCKETS = 1 << 12


_OUT = pd.Index(S.columns(OUTCOMES))


def _records(page: pd.DataFrame) -> Iterator[tuple]:
    """The rows as Spark has them, absent values as None."""
    columns = ([None if v is None or v != v else v for v in page[c].tolist()] for c in _FIELDS)
    return zip(*columns)


def _rows(told: list[tuple]) -> pd.DataFrame:
    """One block of plain objects: a frame of typed columns takes pandas milliseconds."""
    return pd.DataFrame(np.array(told, object), columns=_OUT, copy=False)


def _now(state: GroupState) -> int:
    """The time of the batch in ms; 0 for a state without a clock."""
    return getattr(state, "getCurrentProcessingTimeMs", int)()


def outcomes(
    failures: DataFrame, max_retries: int = S.MAX_RETRIES, backoff_s: float = 1.0, forget_s: float = 86_400.0
) -> DataFrame:
    """What becomes of each failed record: ``retry`` when its back-off is over, or ``dead-letter``.

    ``failures`` is a stream with a row for each failed attempt. The back-off doubles with each
    attempt; without one a record is retried in the batch that reports it. Times are those of
    the batch, which a replayed batch has again. Timers are looked at in each batch, which a stream in service also
    runs without new data and one that drains its source (``DRAINING``) only with some.
    """

    def step(key: tuple, pages: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if not key[1]:
            for page in pages:
                if told := [(DEAD, 1, *record) for record in _records(page)]:
                    yield _rows(told)
            return
        held: dict[str, list] = json.loads(state.get[0]) if state.exists else {}
        now, told = _now(state), []
        failed: dict[str, tuple[int, tuple]] = {}
        for page in pages:
            for record in _records(page):
                failed[record[0]] = failed.get(record[0], (0,))[0] + 1, record
        for number in [n for n, (_, due, _) in held.items() if due < now and n not in failed]:
            attempts, _, record = held.pop(number)
            if record is not None:
                told.append((RETRY, attempts, *record))
                held[number] = [attempts, now + max(1, int(forget_s * 1000)), None]
        for number, (n, record) in failed.items():
            attempts = held.pop(number, (0,))[0] + n
            if attempts > max_retries:
                told.append((DEAD, attempts, *record))
                continue
            waiting = backoff_s > 0
            wait = backoff_s * 2 ** (attempts - 1) if waiting else forget_s
            held[number] = [attempts, now + max(1, int(wait * 1000)), record if waiting else None]
            if not waiting:
                told.append((RETRY, attempts, *record))
        if held:
            state.update((json.dumps(held),))
            state.setTimeoutDuration(max(1, min(due for _, due, _ in held.values()) - now))
        elif state.exists:
            state.remove()
        if told:
            yield _rows(told)

    # Rows without a number are spread by what they hold.
    named = "coalesce(sequence_number, '') <> ''"
    content = "xxhash64(partition_key, approximate_arrival_timestamp, data)"
    keyed = failures.selectExpr(
        *_FIELDS,
        f"{named} AS _named",
        f"pmod(IF({named}, xxhash64(sequence_number), {content}), {BUCKETS}) AS _bucket",
    )
    return keyed.groupBy("_bucket", "_named").applyInPandasWithState(
        step, OUTCOMES, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout
    )
