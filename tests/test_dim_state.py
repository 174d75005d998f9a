"""Dimensions from new batches and the state equal those from all lines."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tillflow.operators.distinct_counts import distinct_counts
from tillflow.operators.spread_join import hot_keys, left_join_spread
from tillflow.operators.datatests import unique_failures
from tillflow.plans import dim_state, key_state, marts, pipeline, queries, staging
from tillflow.plans.catalog import ModelParams
from tillflow.sinks import tables

SF = "/root/testdata/sf0.001"
PARAMS = ModelParams(as_of=dt.date(2001, 8, 31))
CUTS = [dt.datetime(1996, 6, 1), dt.datetime(1998, 1, 1), dt.datetime(1999, 6, 1)]


def _state(spark, wh):
    layout = pipeline.Layout(wh)
    return dim_state.DimensionState(spark, layout.dim_state, layout.lines)


def _same(spark, wh, state):
    raw = pipeline.read_raw(spark, wh)
    for got, want in ((state.stg_customers(), staging.stg_customers(raw)), (state.stg_products(), staging.stg_products(raw)),
                      (state.stg_customers("latest").drop("country"), staging.stg_customers(raw, "latest").drop("country"))):
        assert got.schema.simpleString() == want.schema.simpleString()
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Three batches by time, and one whose lines share customers and products with all."""
    wh = str(tmp_path_factory.mktemp("dims") / "wh")
    src = queries.source(spark, SF).persist()
    for i, cut in enumerate(CUTS):
        pipeline.run_pipeline(spark, src.filter(F.col("InvoiceDate") < F.lit(cut)), wh, batch_id=f"b{i}")
    return wh, src


def test_updates_equal_a_rebuild(spark, loaded, tmp_path, monkeypatch):
    wh = str(tmp_path / "wh")
    shutil.copytree(loaded[0], wh)
    state = _state(spark, wh)
    assert not state.exists()
    assert state.update() == {"batches_read": 3, "folded_anew": 0}
    _same(spark, wh, state)
    assert state.update() == {"batches_read": 0, "folded_anew": 0}
    pipeline.run_pipeline(spark, loaded[1], wh, batch_id="b3")
    # only the new batch is read
    read = []
    real = dim_state.read_raw_orders
    monkeypatch.setattr(dim_state, "read_raw_orders", lambda *a, **k: read.append(real(*a, **k)) or read[-1])
    assert state.update() == {"batches_read": 1, "folded_anew": 0}
    monkeypatch.undo()
    assert len(read) == 1
    _same(spark, wh, state)


def test_invoice_in_two_batches_counts_once(spark, tmp_path):
    wh, src = str(tmp_path / "wh"), str(tmp_path / "src")
    os.makedirs(src)
    head = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    with open(f"{src}/a.csv", "w") as f:
        f.write(head + "1,A,x,1,2010-01-01 10:00:00,1.0,7,UK\n1,B,y,1,2010-01-01 10:00:00,1.0,7,UK\n2,A,x,1,2010-01-01 10:00:00,3.0,8,FR\n")
    pipeline.run_pipeline(spark, src, wh, batch_id="a")
    state = _state(spark, wh)
    state.update()
    with open(f"{src}/b.csv", "w") as f:
        f.write(head + "1,A,zz,2,2010-01-02 10:00:00,2.0,7,AT\n9,A,x,1,2010-01-02 10:00:00,0.0,7,UK\n")
    pipeline.run_pipeline(spark, src, wh, batch_id="b")
    state.update()
    _same(spark, wh, state)
    assert {r.customer_id: r.total_orders for r in state.stg_customers().collect()} == {"7": 2, "8": 1}
    # the same after the lines and the state are compacted
    tables.compact_lines(spark, pipeline.Layout(wh).lines)
    assert state.update() == {"batches_read": 0, "folded_anew": 0}
    for name in state.schemas:
        dim_state.history.compact(spark, state.table(name))
    with open(f"{src}/c.csv", "w") as f:
        f.write(head + "9,C,x,1,2010-01-03 10:00:00,5.0,7,UK\n10,A,q,1,2010-01-03 10:00:00,5.0,,UK\n")
    pipeline.run_pipeline(spark, src, wh, batch_id="c")
    assert state.update() == {"batches_read": 1, "folded_anew": 0}
    _same(spark, wh, state)


def test_replaced_and_removed_batches_are_taken_back(spark, loaded, tmp_path):
    wh = str(tmp_path / "wh")
    shutil.copytree(loaded[0], wh)
    state = _state(spark, wh)
    state.update()
    for name in state.schemas:      # the state's own history, too
        dim_state.history.compact(spark, state.table(name))
    # b1 again with more lines of its time: read from where it started
    more = loaded[1].withColumn("Price", F.col("Price") + F.lit(1.0))
    pipeline.run_pipeline(spark, more, wh, batch_id="b1")
    assert state.update() == {"batches_read": 1, "folded_anew": 1}
    _same(spark, wh, state)
    shutil.rmtree(f"{pipeline.Layout(wh).lines}/batch_id=b0")
    assert state.update() == {"batches_read": 0, "folded_anew": 1}
    _same(spark, wh, state)


def test_update_that_is_cut_off_is_done_again(spark, loaded, tmp_path, monkeypatch):
    wh = str(tmp_path / "wh")
    shutil.copytree(loaded[0], wh)
    state = _state(spark, wh)
    state.update()
    pipeline.run_pipeline(spark, loaded[1], wh, batch_id="b3")
    before = sorted(map(str, state.stg_customers().collect()))

    def cut(*a):
        raise KeyboardInterrupt
    monkeypatch.setattr(dim_state.DimensionState, "_fold", cut)
    with pytest.raises(KeyboardInterrupt):
        state.update()
    monkeypatch.undo()
    assert sorted(map(str, state.stg_customers().collect())) == before
    assert state.update() == {"batches_read": 1, "folded_anew": 0}
    _same(spark, wh, state)


def test_daily_build_writes_the_marts_of_a_rebuild(spark, loaded, tmp_path):
    wh = str(tmp_path / "wh")
    shutil.copytree(loaded[0], wh)
    pipeline.release(pipeline.build_marts(spark, wh, PARAMS, batches=["b0", "b1", "b2"]))
    assert not _state(spark, wh).exists()       # all there is: no history to spare
    pipeline.run_pipeline(spark, loaded[1], wh, batch_id="b3")
    daily = pipeline.build_marts(spark, wh, PARAMS, batches=["b3"])
    assert _state(spark, wh).exists()
    names = ("fct_orders", "dim_customers", "dim_products", "dim_date")
    got = {n: sorted(map(str, daily[n].collect())) for n in names}
    results = {(r.model, r.column_name): r.passed for r in pipeline.run_tests(spark, wh, PARAMS, False, daily).collect() if r.test == "unique"}
    assert [k for k, passed in results.items() if not passed] == [("fct_orders", "order_key")]     # planted
    pipeline.release(daily)
    whole = pipeline.build_marts(spark, wh, PARAMS)
    assert {n: sorted(map(str, whole[n].collect())) for n in names} == got
    pipeline.release(whole)


def test_repeated_keys_equal_the_test_over_all_lines(spark, loaded, tmp_path):
    """Batch by batch, after a replacement, a removal and a compaction."""
    wh = str(tmp_path / "wh")
    shutil.copytree(loaded[0], wh)
    layout = pipeline.Layout(wh)
    state = key_state.KeyState(spark, layout.key_state, layout.lines)

    def same():
        fct = marts.fct_orders(staging.stg_orders(pipeline.read_raw(spark, wh)))
        want = sorted(map(tuple, unique_failures(fct, "order_key").collect()))
        assert sorted(map(tuple, state.repeated().collect())) == want
        return len(want)
    assert state.update()["batches_read"] == 3 and same() > 0
    # a late line that repeats an early key: its month is counted again, no other
    row = pipeline.read_raw(spark, wh).filter(F.col("batch_id") == "b0").orderBy("invoice_date", "invoice_no", "stock_code").first()
    os.makedirs(tmp_path / "late")
    with open(tmp_path / "late" / "x.csv", "w") as f:
        f.write("Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
                f"{row.invoice_no},{row.stock_code},again,1,{row.invoice_date:%Y-%m-%d %H:%M:%S},1.0,7,UK\n")
    pipeline.run_pipeline(spark, str(tmp_path / "late"), wh, batch_id="late", pipeline_name="other")
    before = len(state.repeated().collect())
    assert state.update() == {"batches_read": 1, "months": 1}
    assert same() == before + 1 and state.update() == {"batches_read": 0, "months": 0}
    dim_state.history.compact(spark, state.table)
    pipeline.run_pipeline(spark, loaded[1].withColumn("Price", F.col("Price") + F.lit(1.0)), wh, batch_id="b1")   # replaced
    assert state.update()["batches_read"] == 1
    same()
    shutil.rmtree(f"{layout.lines}/batch_id=late")
    assert state.update() == {"batches_read": 0, "months": 1}
    same()


def test_distinct_counts_of_many_columns(spark):
    df = spark.createDataFrame([(1, "a", 2.5), (1, "b", None), (None, "b", 1.0), (2, None, 0.5)], "x int, y string, z double")
    got = distinct_counts(df, {"xs": F.col("x"), "ys": F.col("y"), "both": F.col("y")}, {"s": F.col("z")}, rows="n")
    assert got.columns == ["s", "xs", "ys", "both", "n"] and got.collect() == [(4.0, 2, 2, 2, 4)]
    assert distinct_counts(df.limit(0), {"xs": F.col("x")}, {"s": F.col("z")}, rows="n").collect() == [(None, 0, 0)]
    assert distinct_counts(df, {"xs": F.col("x")}).collect() == [(2,)]


def test_spread_join_equals_the_plain_one(spark):
    rows = [(i, None if i % 3 == 0 else "hot" if i % 3 == 1 else f"k{i % 40}") for i in range(900)]
    facts = spark.createDataFrame(rows, "i int, k string")
    dim = spark.createDataFrame([("hot", 300, "h"), *[(f"k{j}", 8, str(j)) for j in range(0, 38)]], "k string, lines int, v string")
    want = sorted(map(str, facts.join(dim, "k", "left").collect()))
    hot = hot_keys(dim, "k", F.col("lines"), rows_per_task=50)
    assert hot == {"hot": 7}
    for h in (None, hot):
        got = left_join_spread(facts, dim, "k", h)
        assert got.columns == ["k", "i", "lines", "v"] and sorted(map(str, got.collect())) == want
    spread = {r[0] for r in left_join_spread(facts, dim.hint("merge"), "k", hot).select(F.spark_partition_id()).collect()}
    assert spread


def test_state_tables_are_written_at_once(spark, loaded, tmp_path, monkeypatch):
    """The tables of an update do not wait for each other, and their rows are shuffled once."""
    import threading

    wh = str(tmp_path / "wh")
    shutil.copytree(loaded[0], wh)
    state = _state(spark, wh)
    meet = threading.Barrier(5, timeout=60)     # breaks if one table is written before another is begun
    real = dim_state.history.delete
    begun = set()

    def delete(s, path):
        name = path.split("/")[-2]
        if name in state.schemas and name not in begun:
            begun.add(name)
            meet.wait()
        return real(s, path)
    monkeypatch.setattr(dim_state.history, "delete", delete)
    assert state.update()["batches_read"] == 3 and len(begun) == 5
    monkeypatch.undo()
    _same(spark, wh, state)
