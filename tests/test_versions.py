"""Several writers, restarts with new checkpoints, repairs after compactions: nothing is lost."""

from __future__ import annotations

from datetime import datetime

import pytest
from test_curate import event, landed, merge, project, stored

from headrace import schemas as S
from headrace import session
from headrace.operators import curate, late, versions
from headrace.streaming import jobs

RUN = datetime(2024, 2, 1, 6, 59)


def ids(spark, path):
    return sorted(r.event_id for r in curate.read_target(spark, path).collect())


def test_a_number_is_given_once(spark, tmp_path):
    path = f"{tmp_path}/log/1"
    assert session.put_new(spark, path, "a é") and not session.put_new(spark, path, "b")
    assert session.read_text(spark, path) == "a é" and session.names(spark, f"{tmp_path}/log") == ["1"]
    table = f"{tmp_path}/t"
    first = versions.latest(spark, table)
    assert versions.publish(spark, table, first.adding(versions.Part("a", 1, 0, 1)))
    assert not versions.publish(spark, table, first.adding(versions.Part("b", 1, 0, 2)))
    assert [p.path for p in versions.latest(spark, table).parts] == ["a"]
    with pytest.raises(ValueError):
        first.dropping([versions.Part("a", 1, 0, 1)])


def test_two_merges_from_one_version(spark, tmp_path, monkeypatch):
    """Another merge is first while this one works; the keys are matched again."""
    path, stage, real = f"{tmp_path}/t", f"{tmp_path}/s", versions.publish
    curate.create_target(spark, path)
    merge(spark, path, stage, 1, project(spark, event("1", amount=1)))

    def late_publish(spark, table, version):
        monkeypatch.setattr(versions, "publish", real)
        assert merge(spark, path, f"{stage}x", 7, project(spark, event("2", amount=2), event("3", amount=3))) == 2
        return real(spark, table, version)

    monkeypatch.setattr(versions, "publish", late_publish)
    assert merge(spark, path, stage, 2, project(spark, event("1", amount=9), event("2", amount=9), event("4", amount=4))) == 1
    assert {k: int(v) for k, v in stored(spark, path).items()} == {"1": 1, "2": 2, "3": 3, "4": 4}
    assert curate.read_target(spark, path).count() == 4 and not list(tmp_path.glob("s*/*"))


def test_repair_after_compaction(spark, tmp_path):
    files, path, stage = f"{tmp_path}/events", f"{tmp_path}/t", f"{tmp_path}/s"
    curate.create_target(spark, path)
    for k in (1, 2):
        merge(spark, path, stage, k, project(spark, event(str(k))))
    landed(spark, files, event("1"), event("3"), event("4"), event("5"))

    def repair():
        summary = late.late_repair(spark, files, path, "2024-01-16", RUN, batch_id=-5)
        return summary.collect()[0].rows_merged

    assert repair() == 3
    curate.compact(spark, path)
    landed(spark, files, event("6"))
    assert repair() == 1 and ids(spark, path) == list("123456")
    for _ in range(3):
        curate.compact(spark, path)
        assert ids(spark, path) == list("123456") and repair() == 0


def test_rows_merged_during_a_compaction_stay(spark, tmp_path, monkeypatch):
    path, stage, real = f"{tmp_path}/t", f"{tmp_path}/s", versions.update
    curate.create_target(spark, path)
    merge(spark, path, stage, 1, project(spark, event("1")))

    def late_update(spark, table, change):
        monkeypatch.setattr(versions, "update", real)
        merge(spark, path, f"{stage}x", 2, project(spark, event("2")))
        return real(spark, table, change)

    monkeypatch.setattr(versions, "update", late_update)
    curate.compact(spark, path)
    assert ids(spark, path) == ["1", "2"]
    curate.compact(spark, path)
    assert ids(spark, path) == ["1", "2"]


def test_a_reader_outlives_a_compaction(spark, tmp_path):
    path, stage = f"{tmp_path}/t", f"{tmp_path}/s"
    curate.create_target(spark, path)
    merge(spark, path, stage, 1, project(spark, event("1")))
    reader = curate.read_target(spark, path)
    curate.compact(spark, path)
    merge(spark, path, stage, 2, project(spark, event("2")))
    assert reader.count() == 1
    curate.compact(spark, path)
    assert not session.exists(spark, f"{path}/batch_id=1")


def test_levels(spark, tmp_path):
    """Each row is rewritten once a level; a round writes what its level holds and no more."""
    path, stage = f"{tmp_path}/t", f"{tmp_path}/s"
    curate.create_target(spark, path)
    seen = []
    for k in range(1, 10):
        merge(spark, path, stage, k, project(spark, event(str(k)), event(str(k - 1))))
        seen.append(curate.compact_levels(spark, path, fan=3))
    assert seen == [[], [], [0], [], [], [0], [], [], [0, 1]]
    (part,) = versions.latest(spark, path).parts
    assert (part.level, part.rows, part.batch_id) == (2, 10, 0)
    assert ids(spark, path) == sorted(map(str, range(10)))
    assert merge(spark, path, stage, 10, project(spark, event("0"))) == 0
    assert curate.compact_levels(spark, path, fan=3) == []
    assert versions.latest(spark, path).parts == (part,)  # a part without rows is dropped
    assert len(session.names(spark, f"{path}.log")) <= versions.KEPT_VERSIONS


def test_a_new_checkpoint_neither_skips_nor_replaces(spark, envelopes, tmp_path):
    root, raw_table, curated, dead = (f"{tmp_path}/{n}" for n in ("out", "raw", "curated", "dead"))

    def run(name, kind):
        envelopes(
            {"event_id": f"{kind}1", "event_type": "order", "amount": 900, "event_time": "2024-01-16T10:00:00Z"},
            {"event_id": f"{kind}2", "event_type": "order", "amount": 900, "event_time": "2024-01-16T10:00:00Z"},
            b"bad " + kind.encode(),
        ).coalesce(1).write.parquet(f"{tmp_path}/in-{kind}")
        state = f"{tmp_path}/state-{name}"
        jobs.process_stream(spark, f"{tmp_path}/in-{kind}", root, f"{state}/p", threshold=500, clock=lambda: RUN).awaitTermination()
        jobs.archive_stream(spark, f"{root}/failures", dead, f"{state}/d", clock=lambda: RUN).awaitTermination()
        jobs.ingest_stream(spark, f"{root}/events", raw_table, f"{state}/i", clock=lambda: RUN).awaitTermination()
        jobs.merge_stream(spark, raw_table, curated, f"{state}/m", clock=lambda: RUN).awaitTermination()

    run("first", "a")
    run("second", "b")
    assert spark.read.parquet(f"{root}/alerts").count() == 4
    assert spark.read.parquet(f"{root}/metrics").selectExpr("sum(processed)").first()[0] == 4
    bodies = spark.read.schema(S.DEAD_LETTER_ARCHIVE).json(f"{dead}/streaming-dlq")
    assert bodies.select("dlq_record_id").distinct().count() == 2
    raw = jobs.read_raw(spark, raw_table)
    assert raw.count() == raw.select("source_file", "source_row").distinct().count() == 4
    assert ids(spark, f"{curated}/events") == ["a1", "a2", "b1", "b2"]


def test_writers_are_numbered(spark, tmp_path):
    def number(name):
        return versions.writer_number(spark, f"{tmp_path}/r", f"{tmp_path}/{name}")

    assert [number(n) for n in ("a", "b", "a", "c", "b")] == [0, 1, 0, 2, 1]
    assert versions.batch_number(0, 0) == 1 and versions.batch_number(2, 4) == (2 << 32) + 5
