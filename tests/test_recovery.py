"""Runs that are cut off between their steps load every line exactly once."""

import os

import pytest
from pyspark.sql import functions as F

from tillflow.plans import pipeline
from tillflow.plans.pipeline import LoadError, PendingRuns
from tillflow.state.pipeline_state import AuditLog, WatermarkError, WatermarkStore

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"
T0 = "2010-01-01 10:00:00"


class Cut(BaseException):
    """The end of the process: no handler of the pipeline runs for it."""


@pytest.fixture()
def place(tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write(f"{HEADER}\n1,A,x,1,{T0},1.0,7,UK\n2,B,y,2,{T0},2.0,8,UK\n")
    return src, os.path.join(tmpdir_path, "wh")


def _loaded(spark, wh):
    return sorted((r.invoice_no, r.batch_id) for r in pipeline.read_raw(spark, wh).collect())


def _pending(spark, wh):
    return PendingRuns(spark, pipeline.Layout(wh).pending).entries()


def _die(monkeypatch, target, name):
    """The process ends where ``name`` would be called; nothing is tidied up."""
    def cut(*a, **k):
        raise Cut()
    monkeypatch.setattr(target, name, cut)
    # what a dead process would not do either
    monkeypatch.setattr(pipeline, "_delete_quietly", lambda *a: None)
    monkeypatch.setattr(PendingRuns, "remove", lambda *a: None)


@pytest.mark.parametrize("publish", ["rename", "direct"])
def test_cut_between_publish_and_mark(spark, place, monkeypatch, publish):
    src, wh = place
    _die(monkeypatch, WatermarkStore, "write")
    with pytest.raises(Cut):
        pipeline.run_pipeline(spark, src, wh, batch_id="b1", publish=publish)
    monkeypatch.undo()
    assert _loaded(spark, wh) == [("1", "b1"), ("2", "b1")] and len(_pending(spark, wh)) == 1
    r = pipeline.run_pipeline(spark, src, wh, batch_id="b2", publish=publish)
    assert r.records_read == 0 and _loaded(spark, wh) == [("1", "b1"), ("2", "b1")]
    assert _pending(spark, wh) == []
    audit = {a.batch_id: a for a in AuditLog(spark, pipeline.Layout(wh).audit).frame().collect()}
    assert (audit["b1"].status, audit["b1"].records_read, audit["b1"].records_loaded) == ("success", 2, 2)


@pytest.mark.parametrize("publish", ["rename", "direct"])
def test_cut_before_the_checks_are_done(spark, place, monkeypatch, publish):
    src, wh = place
    _die(monkeypatch, pipeline, "write_marks" if publish == "rename" else "_invalid_utf8")
    with open(os.path.join(src, "b.csv"), "wb") as f:       # so that the direct run looks at the bytes
        f.write(f"{HEADER}\n3,C,caf�,1,{T0},1.0,7,UK\n".encode())
    with pytest.raises(Cut):
        pipeline.run_pipeline(spark, src, wh, batch_id="b1", publish=publish)
    monkeypatch.undo()
    assert _loaded(spark, wh) == ([] if publish == "rename" else [("1", "b1"), ("2", "b1"), ("3", "b1")])
    pipeline.run_pipeline(spark, src, wh, batch_id="b2", publish=publish)
    assert _loaded(spark, wh) == [("1", "b2"), ("2", "b2"), ("3", "b2")] and _pending(spark, wh) == []
    assert not [n for n in os.listdir(pipeline.Layout(wh).lines) if n.startswith("_incoming")]


def test_cut_before_the_rename(spark, place, monkeypatch):
    src, wh = place
    _die(monkeypatch, pipeline, "publish_batch")
    with pytest.raises(Cut):
        pipeline.run_pipeline(spark, src, wh, batch_id="b1")
    monkeypatch.undo()
    assert _loaded(spark, wh) == []
    assert pipeline.recover(spark, wh) == [] and _pending(spark, wh) == []
    pipeline.run_pipeline(spark, src, wh, batch_id="b1")
    assert _loaded(spark, wh) == [("1", "b1"), ("2", "b1")]


def test_mark_that_cannot_be_stored_doubles_no_line(spark, place, monkeypatch):
    """The run fails, its batch stays, and the next run stores the mark."""
    src, wh = place

    def fail(*a, **k):
        raise WatermarkError("no space")
    monkeypatch.setattr(WatermarkStore, "write", fail)
    with pytest.raises(WatermarkError):
        pipeline.run_pipeline(spark, src, wh, batch_id="b1")
    monkeypatch.undo()
    pipeline.run_pipeline(spark, src, wh, batch_id="b2")
    assert _loaded(spark, wh) == [("1", "b1"), ("2", "b1")]


def test_direct_rows_go_when_a_later_step_fails(spark, place, monkeypatch):
    src, wh = place
    real, calls = pipeline.write_marks, []

    def fail_second(*a):
        calls.append(a)
        if len(calls) == 2:
            raise OSError("no space")
        real(*a)
    monkeypatch.setattr(pipeline, "write_marks", fail_second)
    with pytest.raises(LoadError):
        pipeline.run_pipeline(spark, src, wh, batch_id="b1", publish="direct")
    monkeypatch.undo()
    assert _loaded(spark, wh) == [] and _pending(spark, wh) == []
    pipeline.run_pipeline(spark, src, wh, batch_id="b2", publish="direct")
    assert _loaded(spark, wh) == [("1", "b2"), ("2", "b2")]


def test_recovery_leaves_other_pipelines_and_later_marks_alone(spark, place, monkeypatch):
    src, wh = place
    _die(monkeypatch, WatermarkStore, "write")
    with pytest.raises(Cut):
        pipeline.run_pipeline(spark, src, wh, batch_id="b1")
    monkeypatch.undo()
    assert pipeline.recover(spark, wh, "another") == [] and len(_pending(spark, wh)) == 1
    later = pipeline.dt.datetime(2012, 1, 1)
    wm = WatermarkStore(spark, pipeline.Layout(wh).watermark)
    wm.write(pipeline.PIPELINE_NAME, "raw_orders", later, "9")
    assert pipeline.recover(spark, wh) == ["b1"]
    assert wm.read(pipeline.PIPELINE_NAME, "raw_orders") == (later, "9")


def test_overlong_and_unfit_rows_are_quarantined_whole(spark, place):
    src, wh = place
    long = "d" * 600
    with open(os.path.join(src, "b.csv"), "w") as f:
        f.write(f"{HEADER}\n3,C,z,1,{T0},1.0,7,UK,EXTRA,\"a,b\"\n3,C,z,1,{T0},1.0,7,UK\n4,D,{long},1,{T0},123456789.5,7,UK\n"
                f"5,E,w,-1,{T0},-1.0,7,UK\n1,A,other,1,{T0},1.0,7,UK,MORE\n")
    with pytest.raises(pipeline.ExtractionError):
        pipeline.run_pipeline(spark, src, wh, batch_id="b0")
    r = pipeline.run_pipeline(spark, src, wh, batch_id="b1", on_ragged="quarantine", on_unfit="quarantine")
    assert (r.records_read, r.records_loaded, r.records_quarantined, r.records_skipped) == (7, 3, 4, 0)
    assert _loaded(spark, wh) == [("1", "b1"), ("2", "b1"), ("3", "b1")]
    assert pipeline.read_raw(spark, wh).filter(F.col("invoice_no") == "1").first().description == "x"
    q = sorted((x.invoice_no, x.error_reason, x.raw_record) for x in pipeline.read_quarantine(spark, wh).collect())
    overlong = "record has more fields than the header; "
    assert q[0] == ("1", overlong, f"1,A,other,1,{T0},1.0,7,UK,MORE")
    assert q[1] == ("3", overlong, f"3,C,z,1,{T0},1.0,7,UK,EXTRA,\"a,b\"")
    assert q[2][:2] == ("4", "description does not fit the raw table; unit_price does not fit the raw table; ") and long in q[2][2]
    assert q[3] == ("5", "unit_price is negative; ", None)
    # the default skips and counts unfit rows
    src2, wh2 = os.path.join(wh, "src2"), os.path.join(wh, "wh2")
    os.makedirs(src2)
    with open(os.path.join(src2, "a.csv"), "w") as f:
        f.write(f"{HEADER}\n4,D,{long},1,{T0},1.0,7,UK\n5,D,z,1,{T0},1.0,7,UK\n")
    r = pipeline.run_pipeline(spark, src2, wh2, batch_id="s")
    assert (r.records_loaded, r.records_quarantined, r.records_skipped) == (1, 0, 1)
