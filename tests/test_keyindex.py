"""The key index of compacted parts: files opened are bounded by the batch, rows stay the same."""

from __future__ import annotations

from test_curate import event, merge, project

from headrace import session
from headrace.operators import curate, keyindex, versions

DAYS = [f"2024-01-{d:02d}T10:00:00Z" for d in range(1, 21)]


def load(spark, tmp_path, ids, monkeypatch):
    """A table of one compacted part with many files, and its parts."""
    path, stage = f"{tmp_path}/t", f"{tmp_path}/s"
    curate.create_target(spark, path)
    events = [event(str(i), event_time=DAYS[i % 20]) for i in ids]
    assert merge(spark, path, stage, 1, project(spark, *events)) == len(events)
    monkeypatch.setattr(keyindex, "SLOT_ROWS", 50)
    curate.compact(spark, path)
    return path, stage


def test_slots():
    assert [keyindex.slots(n) for n in (0, 1, 4_000_000, 4_000_001, 9_000_000)] == [1, 1, 1, 2, 4]
    assert keyindex.slots(10**15) == keyindex.MAX_SLOTS


def test_a_small_batch_opens_a_few_files(spark, tmp_path, monkeypatch):
    path, stage = load(spark, tmp_path, range(600), monkeypatch)
    now = versions.latest(spark, path)
    (part,) = now.parts
    assert part.slots == 16 and len(session.names(spark, keyindex.path(path, part.path))) >= 16
    whole = curate.read_target(spark, path)
    assert len(whole.inputFiles()) >= 60
    batch = project(spark, event("7"), event("311"), event("n1"), event("n2"), event("n3"))
    found = curate.rivals(spark, path, list(now.parts), curate.accepted(batch), 5)
    assert len(found.inputFiles()) == 2
    assert {"7", "311"} <= {r.event_id for r in found.select("event_id").collect()}
    new = curate.accepted(project(spark, event("n1")))
    assert curate.rivals(spark, path, list(now.parts), new, 1).inputFiles() == []
    assert merge(spark, path, stage, 2, batch) == 3
    assert merge(spark, path, stage, 3, batch) == 0
    assert curate.read_target(spark, path).count() == 603


def test_lookup_and_scan_agree(spark, tmp_path, monkeypatch):
    """Batches above and below the bounds of the lookup add the same rows."""
    path, stage = load(spark, tmp_path, range(0, 400, 2), monkeypatch)
    batch = project(spark, *(event(str(i)) for i in range(400)))
    parts = list(versions.latest(spark, path).parts)
    fixed = curate.accepted(batch)
    held = {r.event_id for r in curate.read_target(spark, path).collect()}
    for paged, ids in ((1000, 10_000), (10, 10_000), (10, 10)):
        monkeypatch.setattr(keyindex, "PAGED_IDS", paged)
        monkeypatch.setattr(keyindex, "LOOKUP_IDS", ids)
        got = {r.event_id for r in curate.rivals(spark, path, parts, fixed, 400).collect()}
        assert got == held
    assert merge(spark, path, stage, 2, batch) == 200


def test_one_hash_for_many_ids_changes_no_row(spark, tmp_path, monkeypatch):
    """The index only names files; ids are compared as a whole."""
    path, stage = load(spark, tmp_path, range(100), monkeypatch)
    everything = [r[0] for r in curate.read_target(spark, path).selectExpr("xxhash64(event_id)").collect()]
    monkeypatch.setattr(keyindex, "hashes", lambda batch, key: everything)
    assert merge(spark, path, stage, 2, project(spark, event("5"), event("x"))) == 1


def test_indexes_go_with_their_parts(spark, tmp_path, monkeypatch):
    path, stage = load(spark, tmp_path, range(20), monkeypatch)
    (old,) = versions.latest(spark, path).parts
    for k in (2, 3):
        merge(spark, path, stage, k, project(spark, event(f"x{k}")))
        curate.compact(spark, path)
    assert not session.exists(spark, keyindex.path(path, old.path))
    assert not session.exists(spark, old.path)
    (now,) = versions.latest(spark, path).parts
    assert session.exists(spark, keyindex.path(path, now.path))


def test_parts_without_an_index_are_read_by_bucket(spark, tmp_path, monkeypatch):
    """A log written before there was an index."""
    path, stage = load(spark, tmp_path, range(100), monkeypatch)
    versions.update(spark, path, lambda v: versions.Version(
        v.number, tuple(versions.Part(p.path, p.rows, p.level, p.batch_id) for p in v.parts), v.dropped, v.compactions
    ))
    assert merge(spark, path, stage, 2, project(spark, event("5"), event("x"))) == 1
