"""Upsert semantics of the state tables."""

import datetime as dt
import os

import pytest

from tillflow.state.pipeline_state import AuditLog, WatermarkStore
from tillflow.state.versioned import upsert

T1 = dt.datetime(2020, 1, 1, 0, 0, 0)
T2 = dt.datetime(2020, 1, 1, 0, 5, 0)


def test_upsert_updates_inserts_and_keeps(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, u string, keep string")
    source = spark.createDataFrame([(2, None, "IGNORED"), (3, "c", "z")], "k int, u string, keep string")
    got = {r.k: (r.u, r.keep) for r in upsert(target, source, ["k"], ["u"]).collect()}
    assert got == {1: ("a", "x"), 2: (None, "y"), 3: ("c", "z")}


def test_watermark_first_read_and_two_pipelines(spark, tmpdir_path):
    wm = WatermarkStore(spark, os.path.join(tmpdir_path, "wm"))
    wm.ensure()
    assert wm.read("p1", "raw_orders") == (None, None)
    wm.write("p1", "raw_orders", T1, "10", T1)
    wm.write("p2", "raw_orders", T2, "20", T1)
    wm.write("p1", "raw_orders", T2, "11", T2)
    assert wm.read("p1", "raw_orders") == (T2, "11")
    assert wm.read("p2", "raw_orders") == (T2, "20")
    assert wm.frame().count() == 2


def test_audit_lifecycle(spark, tmpdir_path):
    a = AuditLog(spark, os.path.join(tmpdir_path, "audit"))
    a.ensure()
    a.start("b1", "pipe", T1)
    a.fail("b1", "other-name", T2, "boom " + "x" * 2100, completed_at=T2)
    r = a.frame().first()
    assert r.status == "failed" and r.pipeline_name == "pipe" and r.started_at == T1
    assert len(r.error_message) == 2000
    a.complete("b1", "pipe", T1, 5, 4, completed_at=T2)
    r = a.frame().first()
    assert (r.status, r.records_read, r.records_loaded, r.error_message) == ("success", 5, 4, None)
    assert r.duration_seconds == 300.0


def test_changes_fold_into_few_files(spark, tmpdir_path):
    """Equal to a plain dictionary after every change, also at the folds; the number of
    files follows the logarithm of the changes."""
    path = os.path.join(tmpdir_path, "wm")
    wm, want = WatermarkStore(spark, path), {}
    for i in range(40):
        key = f"p{i % 3}"
        wm.write(key, "raw_orders", T1 + dt.timedelta(seconds=i), str(i), T1)
        want[key] = (T1 + dt.timedelta(seconds=i), str(i))
        if i in (0, 14, 15, 16, 31, 39):
            fresh = WatermarkStore(spark, path)
            assert {k: fresh.read(k, "raw_orders") for k in want} == want
            assert fresh.table.changes() == i + 1
    assert wm.table.files() == 2 + 40 % 16
    # folded files stay until the next fold and are not read
    assert len([n for n in os.listdir(path) if n.endswith(".json")]) == 8 + 16


def test_cut_off_folds_and_changes_are_not_read(spark, tmpdir_path, monkeypatch):
    from tillflow.state import versioned

    path = os.path.join(tmpdir_path, "audit")
    a = AuditLog(spark, path)
    a.start("b0", "pipe", T1)
    os.makedirs(os.path.join(path, "part-1-000000000000-000000000015"))     # no _SUCCESS
    with open(os.path.join(path, "_half"), "w") as f:
        f.write('{"change": 1, "ro')
    assert a.frame().count() == 1 and a.table.changes() == 1

    def cut(*x, **k):
        raise KeyboardInterrupt
    monkeypatch.setattr(versioned, "folded", cut)
    monkeypatch.setattr(versioned, "FAN_IN", 2)
    with pytest.raises(KeyboardInterrupt):      # the change is written, its fold is not
        a.start("b1", "pipe", T2)
    monkeypatch.undo()
    assert {r.batch_id for r in a.frame().collect()} == {"b0", "b1"}


def test_first_values_are_kept_through_folds(spark, tmpdir_path, monkeypatch):
    from tillflow.state import versioned

    monkeypatch.setattr(versioned, "FAN_IN", 2)
    a = AuditLog(spark, os.path.join(tmpdir_path, "audit"))
    a.start("b1", "first", T1)
    for i in range(5):
        a.fail("b1", f"late{i}", T2, f"try {i}", completed_at=T2)
        a.start(f"c{i}", "pipe", T2)
    a.complete("b1", "later", T2, 7, 6, completed_at=T2)
    r = a.frame().filter("batch_id = 'b1'").first()
    assert (r.pipeline_name, r.started_at, r.status, r.records_read, r.error_message) == ("first", T1, "success", 7, None)
    assert a.frame().count() == 6


def test_a_change_writes_one_small_file_whatever_the_history(spark, tmpdir_path, monkeypatch):
    path = os.path.join(tmpdir_path, "wm")
    wm = WatermarkStore(spark, path)
    for i in range(3):
        wm.write(f"p{i}", "raw_orders", T1, None, T1)
    monkeypatch.setattr(type(wm.table), "read", None)       # a change reads nothing
    before = set(os.listdir(path))
    wm.write("p1", "raw_orders", T2, "5", T1)
    new = [n for n in set(os.listdir(path)) - before if not n.startswith(".")]
    assert new == ["change-000000000003.json"] and os.path.getsize(os.path.join(path, new[0])) < 500
    monkeypatch.undo()
    assert wm.read("p1", "raw_orders") == (T2, "5") and wm.read("p0", "raw_orders") == (T1, None)
