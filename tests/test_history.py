"""Compaction of tables that grow by batches."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tillflow.plans import ingest, pipeline, queries
from tillflow.sinks import history, tables
from tillflow.sinks.history import batches, compact, file_count, read_layout

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"


def _flagged_lines(spark, rows, batch_id):
    """Order lines (invoice, stock code, time, price) as rows of a batch."""
    df = spark.createDataFrame([(i, s, "d", 1.0, t, p, "7", "UK") for i, s, t, p in rows],
                               "invoice_no string, stock_code string, description string, quantity double, "
                               "invoice_date timestamp_ntz, unit_price double, customer_id string, country string")
    reason = F.when(F.col("unit_price") < 0, F.lit("unit_price is negative; ")).otherwise(F.lit(""))
    now = dt.datetime(2020, 1, 1)
    return ingest.batch_lines(df.withColumn("error_reason", reason), batch_id, now, now).drop("_loadable", "_unfit")


def _load(spark, root, rows, batch_id, run=None):
    folder = tables.write_incoming(_flagged_lines(spark, rows, batch_id), tables.incoming_folder(root, batch_id))
    if run:
        tables.write_marks(spark, folder, {"run": run})
    tables.publish_batch(spark, root, folder, batch_id)


def _day(month, day=1):
    return dt.datetime(2011, month, day, 12)


def _all(spark, root, **kw):
    return sorted((r.batch_id, r.invoice_no, r.load_status) for r in tables.read_lines(spark, root, **kw).collect())


@pytest.fixture()
def root(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "order_lines")
    _load(spark, path, [("1", "A", _day(1), 1.0), ("2", "A", _day(2), -1.0)], "b1", "r1")
    _load(spark, path, [("3", "A", _day(2), 1.0), ("4", "A", None, 1.0)], "b2", "r2")
    return path


def test_compaction_changes_no_row_and_prunes_months(spark, root):
    want = _all(spark, root)
    layout = tables.compact_lines(spark, root)
    assert sorted(layout.slots) == ["2011-01", "2011-02", "none"] and set(layout.batches) == {"b1", "b2"}
    assert _all(spark, root) == want
    assert not [n for n in os.listdir(root) if n.startswith("batch_id=")]
    feb = tables.read_lines(spark, root, since=_day(2), until=_day(2, 28))
    assert sorted(r.invoice_no for r in feb.collect()) == ["2", "3"]
    assert feb.inputFiles() and all("slot=2011-02" in f for f in feb.inputFiles())
    # nothing new: nothing is written
    assert tables.compact_lines(spark, root) == layout and _all(spark, root) == want


def test_only_touched_months_are_written_again(spark, root):
    first = tables.compact_lines(spark, root)
    _load(spark, root, [("5", "A", _day(2), 1.0), ("6", "A", _day(3), 1.0)], "b3", "r3")
    want = _all(spark, root)
    second = tables.compact_lines(spark, root)
    assert _all(spark, root) == want and len(want) == 6
    assert second.slots["2011-01"] == first.slots["2011-01"] and second.slots["2011-02"] != first.slots["2011-02"]
    assert {n for n in os.listdir(f"{root}/_layout") if not n.startswith(".")} == {"1.json"}


def test_replaced_batch_hides_its_rows_in_the_history(spark, root):
    tables.compact_lines(spark, root)
    _load(spark, root, [("1", "A", _day(4), 9.0)], "b1", "r1-again")
    want = [("b1", "1", "loaded"), ("b2", "3", "loaded"), ("b2", "4", "loaded")]
    assert _all(spark, root) == want
    layout = tables.compact_lines(spark, root)
    assert _all(spark, root) == want and layout.batches["b1"] == {"run": "r1-again"}
    assert "2011-01" not in layout.slots and "2011-04" in layout.slots


def test_leftover_folders_of_a_cut_off_compaction_are_not_read_twice(spark, root, monkeypatch):
    want = _all(spark, root)
    monkeypatch.setattr(history, "_sweep", lambda *a: None)     # cut off after the layout was written
    compact(spark, tables.lines_table(root))
    assert [n for n in os.listdir(root) if n.startswith("batch_id=")] and _all(spark, root) == want
    monkeypatch.undo()
    tables.compact_lines(spark, root)
    assert not [n for n in os.listdir(root) if n.startswith("batch_id=")] and _all(spark, root) == want


def test_generation_without_a_layout_is_not_read(spark, root, monkeypatch):
    want = _all(spark, root)

    def cut(*a, **k):
        raise OSError("cut off")
    monkeypatch.setattr(history, "write_json", cut)
    with pytest.raises(history.CompactionError):
        tables.compact_lines(spark, root)
    monkeypatch.undo()
    assert _all(spark, root) == want and read_layout(spark, root).number == -1
    # a half-written layout file says nothing either
    os.makedirs(f"{root}/_layout", exist_ok=True)
    with open(f"{root}/_layout/0.json", "w") as f:
        f.write('{"slots": {"2011-')
    assert _all(spark, root) == want
    tables.compact_lines(spark, root)
    assert _all(spark, root) == want


def test_second_compaction_of_the_same_state_fails(spark, root):
    os.makedirs(f"{root}/_layout", exist_ok=True)
    old = read_layout(spark, root)
    real = history.read_layout
    try:
        history.read_layout = lambda *a: old    # both start from the same layout
        compact(spark, tables.lines_table(root))
        _load(spark, root, [("9", "A", _day(1), 1.0)], "b9", "r9")
        with pytest.raises(history.CompactionError):
            compact(spark, tables.lines_table(root))
    finally:
        history.read_layout = real
    assert len(_all(spark, root)) == 5


def test_files_follow_the_data_not_the_batches(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "order_lines")
    for b in range(30):
        folder = f"{root}/batch_id=b{b:03d}"
        _flagged_lines(spark, [(str(b), "A", _day(1 + b % 3, 1 + b % 27), 1.0)], f"b{b:03d}").coalesce(1).write.partitionBy(
            "load_status").parquet(folder)
    before = file_count(spark, root)
    tables.compact_lines(spark, root)
    assert before >= 30 and file_count(spark, root) <= 6
    assert len(tables.read_lines(spark, root, since=_day(3), until=_day(3, 28)).inputFiles()) <= 2
    assert len(_all(spark, root)) == 30 and set(batches(spark, root)) == {f"b{b:03d}" for b in range(30)}


def test_runs_over_a_compacted_table(spark, tmpdir_path):
    """New batches, a batch that is loaded again, and counts, after its folder is gone."""
    src, wh = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "wh")
    os.makedirs(src)

    def put(name, *lines):
        with open(os.path.join(src, name), "w") as f:
            f.write("\n".join([HEADER, *lines]) + "\n")
    put("a.csv", "1,A,x,1,2010-01-01 10:00:00,1.0,7,UK", "2,B,y,2,2010-01-01 10:00:00,2.0,8,UK")
    pipeline.run_pipeline(spark, src, wh, batch_id="a", compact_after=1)
    put("b.csv", "3,C,z,1,2010-02-01 10:00:00,1.0,9,FR")
    pipeline.run_pipeline(spark, src, wh, batch_id="b", compact_after=1)
    lines = pipeline.Layout(wh).lines
    assert not [n for n in os.listdir(lines) if n.startswith("batch_id=")]
    r = pipeline.run_pipeline(spark, src, wh, batch_id="a")        # again, from where it started
    assert (r.records_read, r.records_loaded) == (2, 2)
    assert sorted((x.invoice_no, x.batch_id) for x in pipeline.read_raw(spark, wh).collect()) == [("1", "a"), ("2", "a"), ("3", "b")]
    put("c.csv", "4,D,w,1,2010-02-02 10:00:00,1.0,9,FR")
    r = pipeline.run_pipeline(spark, src, wh, batch_id="c", skip_loaded_keys=True)
    assert r.records_loaded == 1 and pipeline.read_raw(spark, wh).count() == 4


def test_whole_fixture_is_the_same_after_compaction(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "order_lines")
    f = queries.flagged(spark, "/root/testdata/sf0.001")
    lines = ingest.batch_lines(f, "all", queries.INGESTED_AT, queries.QUARANTINED_AT).drop("_loadable", "_unfit")
    tables.publish_batch(spark, root, tables.write_incoming(lines, tables.incoming_folder(root, "all")), "all")
    before = sorted(map(str, tables.read_lines(spark, root).collect()))
    tables.compact_lines(spark, root)
    assert sorted(map(str, tables.read_lines(spark, root).collect())) == before
