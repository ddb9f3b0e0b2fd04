"""Nothing is lost or doubled: old files, replays, failures, alerts, unreadable files, odd paths."""

from __future__ import annotations

import os
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkRuntimeError

from headrace import schemas as S
from headrace.operators import decode, land, raw
from headrace.sources import landing
from headrace.streaming import jobs

RUN = datetime(2024, 2, 1, 6, 59)
WEEK_OLD = time.time() - 8 * 86400


def age(folder):
    for file in folder.rglob("part-*"):
        os.utime(file, (WEEK_OLD, WEEK_OLD))


def test_files_older_than_those_seen_are_processed(spark, envelopes, tmp_path):
    source = tmp_path / "in"

    def run():
        jobs.decode_stream(spark, str(source), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out").count()

    envelopes({"event_id": "1"}).coalesce(1).write.parquet(str(source))
    assert run() == 1
    envelopes({"event_id": "2"}).coalesce(1).write.parquet(str(source / "late"))
    age(source / "late")
    for file in (source / "late").glob("part-*"):
        file.rename(source / file.name)
    assert run() == 2


def land_rows(spark, folder, n=1, kind="a"):
    rows = spark.range(n).selectExpr(
        f"""parse_json('{{"event_type":"{kind}","event_id":"' || id || '","event_time":"2024-01-01T00:00:00Z"}}') AS payload"""
    )
    rows.coalesce(1).write.mode("append").parquet(str(folder / f"event_type={kind}/dt=2024-01-01/hh=05"))


def test_old_files_are_ingested_and_merged(spark, tmp_path):
    files, table, curated = tmp_path / "events", tmp_path / "raw", tmp_path / "curated"

    def run():
        jobs.ingest_stream(spark, str(files), str(table), f"{tmp_path}/s1", clock=lambda: RUN).awaitTermination()
        for folder in table.glob("batch_id=*"):
            if folder.name != "batch_id=1":
                age(folder)
        jobs.merge_stream(spark, str(table), str(curated), f"{tmp_path}/s2", clock=lambda: RUN).awaitTermination()
        merged = spark.read.schema(S.CURATED).parquet(f"{curated}/events")
        return jobs.read_raw(spark, str(table)).count(), merged.count()

    land_rows(spark, files)
    assert run() == (1, 1)
    land_rows(spark, files, 3, "b")
    age(files / "event_type=b")
    assert run() == (4, 3)  # id 0 is known
    assert not list(curated.glob("stage/*"))


def test_failures_keep_all_that_was_received(spark, envelopes, tmp_path):
    long = "x" * 5000
    sent = envelopes(("s1", b"broken " + long.encode()), (None, b"no id"), ("", b"empty id"), ("s4", {"event_id": "1"}))
    sent.coalesce(1).write.parquet(f"{tmp_path}/in")
    root, dead = f"{tmp_path}/out", f"{tmp_path}/dead"
    jobs.process_stream(spark, f"{tmp_path}/in", root, f"{tmp_path}/s1", clock=lambda: RUN).awaitTermination()
    received = {r.data for r in sent.where("sequence_number IS NULL OR sequence_number <> 's4'").collect()}
    failures = spark.read.schema(S.FAILURES).parquet(f"{root}/failures").collect()
    assert {r.data for r in failures} == received and len(failures) == 3
    assert {r.sequence_number for r in failures} == {"s1", None, ""}
    assert max(len(r.raw) for r in failures) == S.RAW_PREVIEW
    reports = spark.read.parquet(f"{root}/reports").collect()
    assert [r.sequence_number for r in reports] == ["s1"]
    for _ in range(2):
        jobs.archive_stream(spark, f"{root}/failures", dead, f"{tmp_path}/s2", clock=lambda: RUN).awaitTermination()
    letters = spark.read.schema(S.DEAD_LETTER_ARCHIVE).json(f"{dead}/streaming-dlq")
    assert {r.b for r in letters.selectExpr("try_variant_get(body, '$', 'string') AS b").collect()} == received
    assert letters.count() == 3


def test_every_alerting_record_is_stored(spark, envelopes, tmp_path):
    alert = {"event_type": "order", "amount": 900}
    sent = envelopes(
        {**alert, "event_id": ""}, {**alert, "event_id": ""}, {**alert, "event_id": "7"},
        {**alert, "event_id": "7", "amount": 10000}, alert, alert, (None, alert), {"event_type": "order", "amount": 1},
    )
    sent.coalesce(1).write.parquet(f"{tmp_path}/in")
    root = f"{tmp_path}/out"
    jobs.process_stream(
        spark, f"{tmp_path}/in", root, f"{tmp_path}/s", threshold=500, clock=lambda: RUN
    ).awaitTermination()
    alerts = spark.read.schema(S.ALERTS).parquet(f"{root}/alerts").collect()
    metrics = spark.read.parquet(f"{root}/metrics").collect()[0]
    assert len(alerts) == len({r.alert_key for r in alerts}) == metrics.alerts == 7
    assert (metrics.processed, metrics.delivered, metrics.firehose_failed) == (8, 8, 0)


class Crash(Exception):
    pass


@pytest.mark.parametrize("at", ["errors", "failures", "metrics"])
def test_a_batch_tried_again_keeps_its_time_and_files(spark, envelopes, tmp_path, monkeypatch, at):
    """The first try ends between two outputs; the second one runs an hour later."""
    envelopes({"event_type": "a"}, {"event_id": "1"}, b"bad").selectExpr(
        "sequence_number", "partition_key", "data", "CAST(NULL AS DOUBLE) AS approximate_arrival_timestamp"
    ).coalesce(1).write.parquet(f"{tmp_path}/in")
    root, real = tmp_path / "out", jobs.once

    def failing(session, state, output, batch_id, write):
        if output == at:
            raise Crash(at)
        return real(session, state, output, batch_id, write)

    def run(now):
        jobs.process_stream(spark, f"{tmp_path}/in", str(root), f"{tmp_path}/s", clock=lambda: now).awaitTermination()

    monkeypatch.setattr(jobs, "once", failing)
    with pytest.raises(Exception, match="Crash"):
        run(RUN)
    before = {p: p.stat().st_mtime_ns for p in (root / "events").rglob("part-*.parquet")}
    monkeypatch.setattr(jobs, "once", real)
    run(RUN + timedelta(hours=2))
    assert before == {p: p.stat().st_mtime_ns for p in (root / "events").rglob("part-*.parquet")}
    for name, schema in (("events", S.LANDING), ("errors", S.LANDING_ERRORS)):
        rows = spark.read.schema(schema).parquet(str(root / name)).collect()
        assert [(r.dt, r.hh) for r in rows] == [(date(2024, 2, 1), 6)], name
    assert spark.read.parquet(str(root / "metrics")).count() == 1


def test_an_unreadable_file_takes_no_other_with_it(spark, tmp_path):
    files, table = tmp_path / "events", f"{tmp_path}/raw"
    for kind in "abcde":
        land_rows(spark, files, 2, kind)
    (broken,) = (files / "event_type=c").rglob("part-*.parquet")
    broken.write_bytes(broken.read_bytes()[:-30])
    (files / "event_type=a/dt=2024-01-01/hh=05/part-x.parquet").write_text("not parquet")
    for _ in range(2):
        jobs.ingest_stream(spark, str(files), table, f"{tmp_path}/s", clock=lambda: RUN).awaitTermination()
    assert jobs.read_raw(spark, table).count() == 8
    ledger = jobs.read_ledger(spark, table).collect()
    outcome = {r.source_file.rsplit("event_type=", 1)[1][:1] + r.source_file[-9:]: r.outcome for r in ledger}
    assert len(ledger) == 6 and sorted(outcome.values()) == ["loaded"] * 4 + ["unreadable"] * 2
    assert {r.source_file for r in ledger if r.outcome == "loaded"} == {
        r.source_file for r in jobs.read_raw(spark, table).collect()
    }


ODD = ("sign up", "a=b", "x:y", "50%", "a+b", "ü", "plain")


@pytest.mark.parametrize("levels", [land.PARTITIONS, land.DAILY])
@pytest.mark.parametrize("streamed", [False, True])
def test_paths_give_the_values_that_were_written(spark, tmp_path, levels, streamed):
    rows = spark.createDataFrame([(k,) for k in ODD], "event_type string").selectExpr(
        "parse_json('{}') AS payload", "event_type", "'2024-01-15' AS dt", "'07' AS hh"
    )
    if streamed:
        jobs._land_batch(rows, str(tmp_path), levels, 3)
    else:
        land.write(rows, str(tmp_path), levels)
    found = landing.scan_paths(spark, str(tmp_path)).collect()
    hour = 7 if levels == land.PARTITIONS else None
    assert {(r.event_type, r.dt, r.hh) for r in found} == {(k, date(2024, 1, 15), hour) for k in ODD}
    stored = {str(p) for p in tmp_path.rglob("part-*.parquet")}
    assert {r.source_file.removeprefix("file:").replace("///", "/") for r in found} == stored
    assert raw.to_raw(landing.scan(spark, str(tmp_path)), RUN).count() == len(ODD)


def test_whole_data_is_kept_for_failures_only(envelopes):
    df = decode.decode(envelopes(b"bad", {"a": 1}), keep_data=True).collect()
    assert [(r.data is not None) == (r.reason is not None) for r in df] == [True, True]


def test_a_store_error_loses_no_file(spark, tmp_path, monkeypatch):
    """The store refuses three times; the stream fails, starts again and loads all."""
    files, table, real = tmp_path / "events", f"{tmp_path}/raw", landing.read_files
    for kind in "ab":
        land_rows(spark, files, 2, kind)
    refusals = iter(range(3))

    def refusing(*args):
        if next(refusals, None) is not None:
            raise PySparkRuntimeError("slow down")
        return real(*args)

    def run():
        jobs.ingest_stream(spark, str(files), table, f"{tmp_path}/s", clock=lambda: RUN).awaitTermination()

    monkeypatch.setattr(landing, "read_files", refusing)
    for _ in range(3):
        with pytest.raises(Exception, match="slow down"):
            run()
    run()
    assert jobs.read_raw(spark, table).count() == 4
    assert {r.outcome for r in jobs.read_ledger(spark, table).collect()} == {"loaded"}


def test_a_repaired_file_is_loaded_later(spark, tmp_path):
    files, table = tmp_path / "events", f"{tmp_path}/raw"
    for kind in "ab":
        land_rows(spark, files, 2, kind)
    (broken,) = (files / "event_type=b").rglob("part-*.parquet")
    whole = broken.read_bytes()
    broken.write_bytes(whole[:-30])
    for crc in files.rglob(".*.crc"):
        crc.unlink()

    def run():
        jobs.ingest_stream(spark, str(files), table, f"{tmp_path}/s", clock=lambda: RUN).awaitTermination()
        return jobs.read_raw(spark, table).count()

    assert run() == 2
    land_rows(spark, files, 2, "c")
    assert run() == 4
    broken.write_bytes(whole)
    land_rows(spark, files, 2, "d")
    assert run() == 8
    land_rows(spark, files, 2, "e")
    assert run() == 10
    ledger = [r.outcome for r in jobs.read_ledger(spark, table).collect()]
    assert sorted(ledger) == ["loaded"] * 5 + ["unreadable"]
