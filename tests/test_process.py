"""Decode, enrich and route on literal records."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest

from headrace.functions import fields
from headrace.operators import decode, enrich, route
from headrace.sources import envelopes as sources
from headrace.sources import users as user_source


def payloads(spark, *events):
    df = spark.createDataFrame([(i, json.dumps(e)) for i, e in enumerate(events)], "i int, t string")
    return df.selectExpr("i", "parse_json(t) AS payload")


def flags(spark, expression, *events):
    rows = payloads(spark, *events).selectExpr("i", f"{expression} AS out").collect()
    return [r.out for r in sorted(rows, key=lambda r: r.i)]


def test_decode_classes(envelopes):
    classified = decode.decode(
        envelopes(
            ("s0", None), ("s1", ""), ("s2", "Q"), ("s3", b"not-json"), ("s4", b"\xff\xfe"),
            ("s5", b'{"a":1} x'), ("s6", b"[1]"), ("s7", b"null"), ("s8", b"3"), ("s9", b'"s"'),
            (None, b"[2]"), (None, {}),
        )
    )
    failed = {(r.sequence_number, r.raw, r.reason.split(":")[0]) for r in decode.failures(classified).collect()}
    assert failed == {
        ("s0", "", "missing kinesis.data"),
        ("s1", "", "missing kinesis.data"),
        ("s2", "Q", "base64 error"),
        ("s3", "not-json", "json error"),
        ("s4", "��", "json error"),
        ("s5", '{"a":1} x', "json error"),
        ("s6", "[1]", "payload is not a JSON object"),
        ("s7", "null", "payload is not a JSON object"),
        ("s8", "3", "payload is not a JSON object"),
        ("s9", "s", "payload is not a JSON object"),
        (None, "[2]", "payload is not a JSON object"),
    }
    assert [r.sequence_number for r in decode.decoded(classified).collect()] == [""]


def test_failed_raw_is_cut_at_1024_bytes(envelopes):
    body = ("é" * 2000).encode()
    raw = decode.failures(decode.decode(envelopes(b"x" + body))).collect()[0].raw
    assert raw == (b"x" + body)[:1024].decode(errors="replace")


def test_nested_batches(spark):
    batch = {"Records": [{"kinesis": {"sequenceNumber": "1", "data": "e30="}}, {"kinesis": {}}]}
    df = spark.createDataFrame([(json.dumps(b),) for b in (batch, {}, {"Records": None})], "t string")
    from headrace import schemas as S

    parsed = df.selectExpr(f"from_json(t, '{S.ENVELOPE_BATCH}') AS b").select("b.*")
    assert sorted(r.data or "" for r in sources.flatten(parsed).collect()) == ["", "e30="]


@pytest.mark.parametrize(
    "event, threshold, expected",
    [
        ({"event_type": "order", "amount": 1500.0}, 1000, True),
        ({"event_type": "order", "amount": 50}, 1000, False),
        ({"event_type": "page_view", "amount": 99999}, 1000, False),
        ({"event_type": "order", "amount": 1000}, 1000, True),
        ({"event_type": "order", "amount": "1500"}, 1000, True),
        ({"event_type": "order", "amount": "abc"}, 1000, False),
        ({"event_type": "order", "amount": [1500]}, 1000, False),
        ({"event_type": "order", "amount": "nan"}, 1000, False),
        ({"event_type": "order", "amount": "inf"}, 1000, True),
        ({"event_type": "order", "amount": True}, 1, True),
        ({"event_type": "order"}, 1000, False),
        ({"event_type": "order"}, 0, True),
        ({"event_type": "order", "amount": None}, 0, True),
        ({"event_type": "order", "amount": ""}, 0, True),
        ({"event_type": "order", "amount": {}}, 0, True),
        ({"amount": 5000}, 1000, False),
    ],
)
def test_high_value(spark, event, threshold, expected):
    assert flags(spark, route.is_high_value_order("payload", threshold), event) == [expected]


def test_fraud(spark):
    events = [
        ({"fraud_signal": "fraud_suspected"}, True),
        ({"risk_flag": "geo_mismatch"}, True),
        ({"fraud_signal": "card_velocity_high"}, True),
        ({"fraud_signal": "definitely_fine"}, False),
        ({}, False),
        ({"fraud_signal": "x", "risk_flag": "geo_mismatch"}, False),
        ({"fraud_signal": "", "risk_flag": "geo_mismatch"}, True),
        ({"fraud_signal": 0, "risk_flag": "geo_mismatch"}, True),
        ({"fraud_signal": ["geo_mismatch"]}, False),
    ]
    got = flags(spark, route.is_fraud_signal("payload"), *(e for e, _ in events))
    assert got == [flag for _, flag in events]


def test_partition_key(spark):
    events = [{"user_id": "U-123", "event_id": "E-1"}, {"event_id": "E-2"}, {}, {"user_id": 0}]
    got = flags(spark, route.partition_key("payload"), *events)
    assert got == ["U-123", "E-2", "unknown", "unknown"]


def routed(envelopes, users=None, *events, threshold=500):
    records = decode.decoded(decode.decode(envelopes(*events)))
    return route.route(enrich.enrich(records, users), threshold)


def test_routing_batch(envelopes):
    out = routed(
        envelopes, None,
        {"event_id": "1", "event_type": "page_view", "user_id": "u1"},
        {"event_id": "2", "event_type": "order", "user_id": "u2", "amount": 1500},
        {"event_id": "3", "event_type": "order", "user_id": "u3", "amount": 10},
        {"event_id": "4", "event_type": "page_view", "user_id": "u4", "fraud_signal": "geo_mismatch"},
    )
    assert out.count() == 4
    assert {r.event_id for r in route.alerts(out).collect()} == {"2", "4"}


def test_alert_message(envelopes):
    out = routed(envelopes, None, {"risk_flag": "geo_mismatch"}, {"event_type": "order", "amount": 900})
    got = {r.subject: json.loads(r.message) for r in route.alerts(out).collect()}
    assert set(got) == {"Streaming alert: unknown", "Streaming alert: order"}
    assert got["Streaming alert: order"]["ingestion_pipeline"] == "kinesis-lambda-firehose"


def test_one_bad_one_good(envelopes):
    classified = decode.decode(
        envelopes(("seq-bad", b"not-json"), ("seq-good", {"event_id": "1"}), (None, b"bad"))
    )
    assert [r.sequence_number for r in route.batch_failures(classified).collect()] == ["seq-bad"]
    metrics = route.batch_metrics(classified, "false").collect()[0].asDict()
    assert metrics == {"processed": 1, "delivered": 1, "alerts": 0, "failed": 1, "firehose_failed": 0}


def test_refused_delivery_is_reported(envelopes):
    classified = decode.decode(envelopes(("a", {"x": 1}), ("b", {"x": 2}), ("c", {"x": 2})))
    refused = f"{fields.text('payload', 'x')} = '2'"
    assert {r.sequence_number for r in route.batch_failures(classified, refused).collect()} == {"b", "c"}
    metrics = route.batch_metrics(classified, "false", refused).collect()[0]
    assert (metrics.processed, metrics.delivered, metrics.failed, metrics.firehose_failed) == (3, 1, 2, 2)


def test_empty_batch(envelopes, spark):
    classified = decode.decode(envelopes({"a": 1}).where("false"))
    assert route.batch_metrics(classified, "true").collect()[0].asDict() == {
        "processed": 0, "delivered": 0, "alerts": 0, "failed": 0, "firehose_failed": 0,
    }


VIP = ("u1", "vip", "US", Decimal("9999"))


@pytest.mark.parametrize("salts, rows", [(1, None), (1, 2), (3, None)])
def test_enrichment(envelopes, users, salts, rows):
    dimension = users(VIP, ("u2", None, "DE", None), ("0", "zero", "FR", Decimal("1")))
    events = [
        {"event_id": "1", "event_type": "page_view", "user_id": "u1", "page": "/"},
        {"event_id": "2", "user_id": "u9", "user_segment": "own"},
        {"event_id": "3", "user_id": "u2", "user_segment": "own"},
        {"event_id": "4", "user_id": 0},
        {"event_id": "5", "user_id": ""},
        {"event_id": "6", "user_id": "0"},
        {"event_id": "7", "ingestion_pipeline": "backfill"},
        {"event_id": "8", "ingestion_pipeline": None},
    ]
    records = decode.decoded(decode.decode(envelopes(*events)))
    lines = route.ndjson(enrich.enrich(records, dimension, salts, rows)).collect()
    got = {e["event_id"]: e for e in (json.loads(r.line) for r in lines)}
    tag = {"ingestion_pipeline": "kinesis-lambda-firehose"}
    assert got["1"] == {
        **events[0], **tag, "user_segment": "vip", "user_country": "US", "user_lifetime_value": 9999,
    }
    assert got["2"] == {**events[1], **tag}
    assert got["3"] == {
        **events[2], **tag, "user_segment": None, "user_country": "DE", "user_lifetime_value": None,
    }
    assert got["4"] == {**events[3], **tag}
    assert got["5"] == {**events[4], **tag}
    assert got["6"]["user_segment"] == "zero"
    assert got["7"] == events[6]
    assert got["8"] == events[7]
    assert all("\n" not in r.line for r in lines)


def test_stored_dimension(spark, users, tmp_path):
    users(VIP, ("u2", None, "DE", None)).write.parquet(f"{tmp_path}/users")
    assert user_source.rows(spark, f"{tmp_path}/users") == 2
    assert user_source.read(spark, f"{tmp_path}/users").where("segment = 'vip'").count() == 1


def test_a_hot_user_is_spread_over_tasks(spark, users):
    """Salting cuts one user's rows into several tasks and loses none."""
    records = spark.range(4000).selectExpr(
        "'s' || id AS sequence_number", "CAST(id AS DOUBLE) AS approximate_arrival_timestamp",
        "parse_json('{\"user_id\":\"u1\"}') AS payload",
    )
    broadcast, coalesce = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"
    spark.conf.set(broadcast, "-1")
    spark.conf.set(coalesce, "false")
    try:
        out = enrich.enrich(records, users(VIP), salts=16).selectExpr("hit", "spark_partition_id() AS p")
        assert out.where("hit").count() == 4000
        assert out.select("p").distinct().count() > 4
    finally:
        spark.conf.unset(broadcast)
        spark.conf.set(coalesce, "true")


def test_a_repeated_user_gives_one_row(envelopes, users):
    """However the dimension is joined, an event stays one event."""
    twice = users(VIP, VIP, ("u1", "a", None, None), ("u2", "b", "c", None))
    records = decode.decoded(decode.decode(envelopes({"user_id": "u1"}, {"user_id": "u2"}, {"user_id": ""})))
    results = []
    for how in ({"user_rows": 4}, {}, {"salts": 3}):
        rows = enrich.enrich(records, twice, **how).selectExpr(
            "sequence_number", "hit", "try_variant_get(user_segment, '$', 'string') AS s"
        ).collect()
        results.append(sorted(map(tuple, rows)))
    assert results[0] == results[1] == results[2]
    assert [r[:2] for r in results[0]] == [("seq-0", True), ("seq-1", True), ("seq-2", False)]


def test_records_without_a_user_are_spread(spark, envelopes, users):
    """With a dimension too large to broadcast and without adaptive execution."""
    records = decode.decoded(decode.decode(envelopes(*({"event_id": str(i)} for i in range(400)))))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = enrich.enrich(records, users(VIP)).selectExpr("hit", "spark_partition_id() AS p")
        sizes = [r["count"] for r in joined.groupBy("p").count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 400 and max(sizes) < 150
