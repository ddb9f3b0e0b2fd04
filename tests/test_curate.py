"""Typed projection, rejects, de-duplication, merge laws and late repair."""

from __future__ import annotations

import json
import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from headrace import schemas as S
from headrace import session
from headrace.operators import audit, curate, land, late, skew

RUN = datetime(2024, 2, 1, 6)
TIME = "2024-01-15T10:00:00+00:00"


def raw_rows(spark, *events, start=0, ingested=RUN, file="f"):
    rows = [(json.dumps(e), file, start + i) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, "t string, source_file string, source_row bigint").selectExpr(
        "parse_json(t) AS payload", "source_file", "source_row", f"TIMESTAMP_NTZ'{ingested}' AS ingested_at"
    )


def event(event_id="1", **more):
    return {"event_id": event_id, "event_type": "order", "event_time": TIME, **more}


def project(spark, *events, **kw):
    return curate.project(raw_rows(spark, *events, **kw), RUN)


def test_types(spark):
    row = curate.accepted(
        project(
            spark,
            event(
                quantity="2.5", unit_price="1.005", amount=12.345, is_high_value="yes",
                user_lifetime_value=7, user_id=9, source=None, unknown="x",
            ),
        )
    ).collect()[0]
    assert (row.quantity, row.unit_price, row.amount) == (Decimal(3), Decimal("1.01"), Decimal("12.35"))
    assert (row.is_high_value, row.user_ltv, row.user_id, row.source) == (True, Decimal("7.00"), "9", None)
    assert (row.event_time, row.event_date) == (datetime(2024, 1, 15, 10), date(2024, 1, 15))
    assert (row.source_file, row.source_row, row.ingested_at, row.curated_at) == ("f", 0, RUN, RUN)


@pytest.mark.parametrize("value", ["x", "1e99", [1], {}, None, ""])
def test_malformed_numbers_become_null(spark, value):
    row = curate.accepted(project(spark, event(amount=value, unit_price=value))).collect()[0]
    assert row.amount is None and row.unit_price is None


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"event_id": None}, "event_id missing"),
        ({"event_time": "soon"}, "event_time unreadable"),
        ({"event_time": None}, "event_time unreadable"),
        ({"event_type": None}, "event_type missing"),
        ({"is_high_value": "zzz"}, "is_high_value not boolean"),
        ({"quantity": 10**10}, "quantity out of range"),
        ({"is_high_value": None}, None),
        ({"is_high_value": "off"}, None),
    ],
)
def test_reject_rules(spark, change, rule):
    projected = project(spark, {**event(), **change}, event("other"))
    assert [r.reject_rule for r in curate.rejects(projected).collect()] == ([rule] if rule else [])
    assert curate.accepted(projected).count() == (1 if rule else 2)


def test_sample_shapes_without_id_are_rejected(spark):
    """Orders and stock moves as arrays of records, none with an event id."""
    orders = [{"order_id": f"ORD-{i}", "event_time": "2024-01-15T10:23:45Z", "event_type": "ORDER_CREATED"} for i in range(10)]
    projected = project(spark, *orders)
    assert curate.accepted(projected).count() == 0
    assert {r.reject_rule for r in curate.rejects(projected).collect()} == {"event_id missing"}


def stored(spark, path):
    return {r.event_id: r.amount for r in curate.read_target(spark, path).collect()}


def merge(spark, path, stage, batch_id, rows, **kw):
    return curate.merge(spark, curate.accepted(rows), path, batch_id, f"{stage}/{batch_id}", **kw)


def test_merge_cases(spark, tmp_path):
    path, stage = f"{tmp_path}/t", f"{tmp_path}/s"
    curate.create_target(spark, path)
    assert merge(spark, path, stage, 1, project(spark, event("1", amount=1), event("1", amount=9), event("2", amount=2))) == 2
    assert stored(spark, path) == {"1": Decimal("1.00"), "2": Decimal("2.00")}
    # Known id with other values: the first stays. Two new copies: the earlier stays.
    late_copy = raw_rows(spark, event("3", amount=8), ingested=RUN + timedelta(hours=1))
    batch = curate.project(
        raw_rows(spark, event("1", amount=5), event("3", amount=3), file="g").unionByName(late_copy), RUN
    )
    assert merge(spark, path, stage, 2, batch) == 1
    assert stored(spark, path)["3"] == Decimal("3.00")
    # The same batch again, under its own id and under a new one.
    assert merge(spark, path, stage, 2, batch) == 1
    assert merge(spark, path, stage, 3, batch) == 0
    # An older batch replayed after newer ones still holds its rows.
    assert merge(spark, path, stage, 1, project(spark, event("1", amount=1), event("2", amount=2))) == 2
    assert len(stored(spark, path)) == 3
    assert curate.read_target(spark, path).count() == 3
    with pytest.raises(ValueError):
        merge(spark, path, stage, 0, batch)


def test_merge_of_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    curate.create_target(spark, path)
    assert merge(spark, path, f"{tmp_path}/s", 1, project(spark, event()).where("false")) == 0
    assert curate.read_target(spark, path).count() == 0


def random_events(seed, n=300):
    """Deliveries in which one id makes up a third of all rows."""
    rng = random.Random(seed)
    return [event("hot" if rng.random() < 0.34 else str(rng.randrange(120)), amount=i) for i in range(n)]


def brute_force(events):
    kept = {}
    for e in events:
        kept.setdefault(e["event_id"], Decimal(f"{e['amount']}.00"))
    return kept


@pytest.mark.parametrize(
    "limit", [("ROWS", skew.BROADCAST_ROWS), ("ROWS", 150), ("ROWS", 0), ("BYTES", 300), ("BYTES", 0)]
)
def test_any_split_gives_one_result(spark, tmp_path, monkeypatch, limit):
    """Small, key-first and fully shuffled merges all keep the first copies."""
    monkeypatch.setattr(curate, f"BROADCAST_{limit[0]}", limit[1])
    events = random_events(5)
    path, stage = f"{tmp_path}/t", f"{tmp_path}/s"
    curate.create_target(spark, path)
    cuts = [0, 40, 200, 300]
    for batch_id, (a, b) in enumerate(zip(cuts, cuts[1:]), 1):
        merge(spark, path, stage, batch_id, project(spark, *events[a:b], start=a))
    assert stored(spark, path) == brute_force(events)
    assert curate.read_target(spark, path).count() == len(brute_force(events))
    for batch_id in (9, 10):  # compaction keeps the table as it was, for readers and merges
        curate.compact(spark, path)
        assert stored(spark, path) == brute_force(events)
        assert merge(spark, path, stage, batch_id, project(spark, *events)) == 0
        assert merge(spark, path, stage, 1, project(spark, *events[:40])) == 0  # a replay
        assert merge(spark, path, stage, -5, project(spark, *events[:40])) == 0
        assert curate.read_target(spark, path).count() == len(brute_force(events))
    assert merge(spark, path, stage, 11, project(spark, event("new"))) == 1
    assert not list(tmp_path.glob("s/*")) and not session.exists(spark, f"{path}/batch_id=2")


def test_a_small_batch_reads_its_buckets_only(spark, tmp_path, capsys):
    path, stage = f"{tmp_path}/t", f"{tmp_path}/s"
    curate.create_target(spark, path)
    merge(spark, path, stage, 1, project(spark, *(event(str(i), amount=i) for i in range(500))))
    curate.compact(spark, path)
    few = curate.read_target(spark, path, buckets=[3, 5])
    assert 0 < few.count() < 60
    assert few.selectExpr(f"{curate.bucket()} AS b").distinct().count() == 2
    few.explain()
    assert "PartitionFilters: [bucket" in capsys.readouterr().out.replace("isnotnull(bucket", "bucket")
    assert merge(spark, path, stage, 2, project(spark, event("7"), event("new"))) == 1
    assert curate.read_target(spark, path).count() == 501


def test_first_write_keeps_every_column(spark):
    rows = curate.accepted(project(spark, event("1", page="a"), event("2", email="b")))
    kept = curate.first_write(rows)
    assert kept.columns == S.columns(S.CURATED)
    assert {(r.event_id, r.page, r.email) for r in kept.collect()} == {("1", "a", None), ("2", None, "b")}


def landed(spark, path, *events, dt="2024-01-16"):
    rows = raw_rows(spark, *events).selectExpr(
        "payload", "try_variant_get(payload, '$.event_type', 'string') AS event_type", f"'{dt}' AS dt", "'05' AS hh"
    )
    land.write(rows, path, land.PARTITIONS)


def test_late_repair(spark, tmp_path):
    files, path = f"{tmp_path}/events", f"{tmp_path}/t"
    landed(
        spark, files, event("1"), event("2"), event("3", event_type="signup"),
        event("4", event_time="bad"), event("2", amount=1),
    )
    landed(spark, files, event("9"), dt="2024-01-17")
    curate.create_target(spark, path)
    merge(spark, path, f"{tmp_path}/s", 1, project(spark, event("1")))
    run = datetime(2024, 2, 2, 12)

    def repair(**kw):
        return late.late_repair(spark, files, path, "2024-01-16", run, **kw).collect()[0]

    first = repair(event_type="order", lookback_h=12, batch_id=-2)
    assert (first.rows_merged, first.event_type, first.lookback_h) == (1, "order", 12)
    assert (first.event_date, first.run_at) == (date(2024, 1, 16), run)
    second = repair()
    assert (second.rows_merged, second.event_type, second.lookback_h) == (1, None, 6)
    assert repair().rows_merged == 1  # the same run replaces its own rows
    assert late.late_repair(spark, files, path, "2024-01-16", run + timedelta(hours=1)).collect()[0].rows_merged == 0
    rows = {r.event_id: r.ingested_at for r in curate.read_target(spark, path).collect()}
    assert rows == {"1": RUN, "2": run - timedelta(hours=12), "3": run - timedelta(hours=6)}
    with pytest.raises(ValueError):
        repair(batch_id=5)
    # A repair of another date at the same time keeps the rows of this one.
    other = late.late_repair(spark, files, path, "2024-01-17", run).collect()[0]
    assert other.rows_merged == 1
    assert curate.read_target(spark, path).count() == 4


def test_reconcile(spark):
    rows = spark.createDataFrame(
        [("a", "d1"), ("a", "d1"), ("b", "d1"), ("c", "d2")], "event_type string, dt string"
    )
    got = {tuple(r) for r in audit.reconcile(rows, rows.where("event_type <> 'c'").limit(2)).collect()}
    assert ("c", "d2", 1, 0) in got
    assert audit.reconcile(rows, rows).count() == 0


def test_order_audit(spark):
    cases = [
        event("ok", quantity=3, unit_price=39.99, amount=119.97, is_high_value=False),
        event("sum", quantity=3, unit_price=39.99, amount=120, is_high_value=False),
        event("flag", quantity=1, unit_price=1299, amount=1299, is_high_value=False),
        event("edge", quantity=1, unit_price=1000, amount=1000, is_high_value=True),
        event("open", quantity=None, unit_price=5, amount=7),
        event("view", event_type="page_view", quantity=2, unit_price=5, amount=7),
    ]
    rows = audit.order_amounts(curate.accepted(project(spark, *cases))).collect()
    assert {(r.event_id, r.wrong_amount, r.wrong_flag) for r in rows} == {
        ("sum", True, False), ("flag", False, True),
    }


def test_contract(spark):
    full = {f: "x" for f in (*S.BASE_FIELDS, *S.TYPE_FIELDS["signup"])}
    good = {**full, "event_type": "signup"}
    bad = [{**good, "event_type": "other"}, {k: v for k, v in good.items() if k not in ("email", "source")}]
    rows = spark.createDataFrame([(json.dumps(e),) for e in (good, *bad)], "t string")
    got = {r.rule: r.violations for r in audit.contract(rows.selectExpr("parse_json(t) AS payload")).collect()}
    assert {rule: n for rule, n in got.items() if n} == {
        "unknown type": 1, "missing source": 1, "incomplete signup": 1,
    }


def test_the_payload_is_read_in_one_pass(spark):
    """A path for each of the columns would search the payload's keys anew for each."""
    plan = curate.accepted(project(spark, event()))._jdf.queryExecution().analyzed().toString()
    assert plan.count("variant_get(payload") == 1


def test_shuffles_of_a_merge_grow_with_its_rows(spark, tmp_path, monkeypatch):
    """The rows of a task are bounded; the session's number of partitions is only the least."""
    key, seen, plain = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", [], curate.first_write

    def noted(*given):
        seen.append(spark.conf.get(key, None))
        return plain(*given)

    monkeypatch.setattr(skew, "ROWS_PER_TASK", 10)
    monkeypatch.setattr(curate, "first_write", noted)
    rows = curate.accepted(project(spark, *(event(str(i)) for i in range(200))))
    curate.create_target(spark, f"{tmp_path}/t")
    assert curate.merge(spark, rows, f"{tmp_path}/t", 1, f"{tmp_path}/s") == 200
    assert seen == ["20"] and spark.conf.get(key, None) is None
