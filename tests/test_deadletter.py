"""Retry split, dead-letter envelopes and archive; per-key order."""

from __future__ import annotations

import json
import random
from datetime import datetime

from headrace import schemas as S
from headrace.operators import deadletter, ordering
from headrace.sources import deadletters

RUN = datetime(2024, 2, 2, 9, 30)


def letters(spark, *bodies):
    attributes = {"ApproximateReceiveCount": "3", "SentTimestamp": "1700000000000"}
    rows = [(f"m{i}", body, attributes, "arn") for i, body in enumerate(bodies)]
    return spark.createDataFrame(
        rows, "message_id string, body string, attributes map<string,string>, event_source_arn string"
    ).selectExpr("*", "CAST(NULL AS VARIANT) AS message_attributes")


def test_retry_split(spark):
    attempts = [("once",)] + [("thrice",)] * 3 + [("gone",)] * 4 + [(None,), ("",)]
    got = {
        r.sequence_number: (r.attempts, r.outcome)
        for r in deadletter.retry_split(spark.createDataFrame(attempts, "sequence_number string")).collect()
    }
    assert got == {"once": (1, "retry"), "thrice": (3, "retry"), "gone": (4, "dead-letter")}


def test_envelope_and_archive(spark, tmp_path):
    df = letters(spark, '{"event_id":"1","broken":true}', "non-json body", '{"a":1} x', "", None, "[1]")
    rows = deadletter.envelope(df, RUN).selectExpr("*", "to_json(body) AS json").collect()
    assert {r.source_message_id: r.json for r in rows} == {
        "m0": '{"broken":true,"event_id":"1"}', "m1": '"non-json body"', "m2": '"{\\"a\\":1} x"',
        "m3": '""', "m4": '""', "m5": "[1]",
    }
    assert {r.approximate_receive_count for r in rows} == {"3"}
    assert {r.received_at for r in rows} == {"2024-02-02T09:30:00.000000+00:00"}
    assert len({r.dlq_record_id for r in rows}) == 6
    again = deadletter.envelope(df, RUN).collect()
    assert {r.dlq_record_id for r in again} == {r.dlq_record_id for r in rows}

    assert deadletter.archive(df, str(tmp_path), RUN, "streaming-dlq/") == {"archived": 6, "failed": 0}
    folder = tmp_path / "streaming-dlq" / "dt=2024-02-02" / "hh=09"
    assert list(folder.rglob("*.json"))
    stored = spark.read.schema(S.DEAD_LETTER_ARCHIVE).json(deadletter.archive_path(str(tmp_path)))
    assert stored.count() == 6
    assert {r.j for r in stored.selectExpr("to_json(body) AS j").collect()} == {
        r.json for r in rows
    }


def test_nested_batches(spark, tmp_path):
    """Messages as delivered: nested batches in JSON lines, one of them empty."""
    batch = {
        "Records": [
            {"messageId": "m1", "body": '{"event_id":"1","broken":true}',
             "attributes": {"ApproximateReceiveCount": "3"},
             "messageAttributes": {"kind": {"dataType": "String"}}, "eventSourceARN": "arn"},
            {"messageId": "m2", "body": "non-json body"},
        ]
    }
    (tmp_path / "batch.json").write_text(json.dumps(batch) + "\n" + json.dumps({"Records": []}) + "\n{}\n")
    df = deadletters.read_batches(spark, str(tmp_path))
    rows = deadletter.envelope(df, RUN).selectExpr("*", "to_json(message_attributes) AS more").collect()
    assert {(r.source_message_id, r.approximate_receive_count, r.more) for r in rows} == {
        ("m1", "3", '{"kind":{"dataType":"String"}}'), ("m2", None, "{}"),
    }


def test_empty_archive(spark, tmp_path):
    assert deadletter.archive(letters(spark, "x").where("false"), str(tmp_path), RUN) == {"archived": 0}


def test_a_batch_archived_twice_is_there_once(spark, tmp_path):
    for batch in ("1", "2", "1"):
        assert deadletter.archive(letters(spark, "a", "b"), str(tmp_path), RUN, batch=batch)["archived"] == 2
    assert spark.read.schema(S.DEAD_LETTER_ARCHIVE).json(f"{tmp_path}/streaming-dlq").count() == 4


def test_positions_of_a_hot_key(spark, tmp_path):
    """A third of all rows share a key; NULL keys and NULL times are kept."""
    rng = random.Random(3)
    rows = [
        (rng.choice(["hot", "hot", "hot", None, *"abcde"]), rng.choice([None, rng.uniform(0, 50_000)]), i)
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "k string, at double, seq int")
    got = {r.seq: r.position for r in ordering.positions(df, "k", ["at", "seq"], f"{tmp_path}/o").collect()}
    expected = {}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        expected.update({r[2]: n for n, r in enumerate(mine, 1)})
    assert got == expected


def test_ordered_layout(spark, tmp_path):
    df = spark.range(5000).selectExpr("IF(id % 3 = 0, 'hot', CAST(id % 50 AS STRING)) AS k", "-id AS at")
    ordering.ordered(df, "k", ["at"]).write.mode("append").parquet(str(tmp_path))
    files = sorted(p for p in tmp_path.glob("part-*.parquet"))
    seen = {}
    for file in files:
        for r in spark.read.parquet(str(file)).collect():
            assert seen.get(r.k, -(10**9)) < r["at"]
            seen[r.k] = r["at"]
    assert len(seen) == 51
