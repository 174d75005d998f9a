"""What a query leaves on the disk while it runs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tillflow.plans import ingest, pipeline, queries, queries_io
from tillflow.session import FREE_SHUFFLES, freed_shuffles, shared_dir
from tillflow.sinks import tables
from tillflow.sources.csv_source import list_files, read_source_csv


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Tables of 60 orders of 7 lines, some lines twice."""
    path = str(tmp_path_factory.mktemp("tables"))
    day = dt.datetime(1994, 1, 1)
    made = {
        "nation": ("n_nationkey int, n_name string", [(0, "FRANCE"), (1, "PERU")]),
        "customer": ("c_custkey bigint, c_nationkey int", [(k, k % 2) for k in range(20)]),
        "part": ("p_partkey bigint, p_name string, p_retailprice double", [(k, f"part {k}", 10.0 + k) for k in range(40)]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
                   [(k, k % 20, day + dt.timedelta(days=11 * k)) for k in range(90, 150)]),
        "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_returnflag string",
                     [(k, (k * 7 + n) % 40, n, n, 1.0 + n, 10.0 * n, "R" if n == 3 else "N")
                      for k in range(90, 150) for n in (1, 2, 3, 4, 5, 6, 7, 7)]),
    }
    for name, (schema, rows) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path


def _shuffles(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def _left(spark, before: set[str]) -> set[str]:
    """Shuffle files that came and stayed; the executors delete theirs in the background."""
    import time

    for _ in range(50):
        if not (left := _shuffles(spark) - before):
            break
        time.sleep(0.1)
    return left


def _scratch(spark) -> set[str]:
    path = f"{shared_dir(spark).removeprefix('file:')}/tillflow"
    return set(os.listdir(path)) if os.path.exists(path) else set()


def test_scopes_give_shuffles_back_and_may_overlap(spark, tmpdir_path):
    first = spark.conf.get(FREE_SHUFFLES, "false")
    frame = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = _shuffles(spark)
    one, two = freed_shuffles(spark), freed_shuffles(spark)
    one.__enter__()
    two.__enter__()
    one.__exit__(None, None, None)
    frame.write.parquet(f"{tmpdir_path}/a")
    two.__exit__(None, None, None)
    assert spark.conf.get(FREE_SHUFFLES) == first and not _left(spark, before)
    assert frame.count() == 7 and spark.read.parquet(f"{tmpdir_path}/a").count() == 7


def test_compacted_lines_holds_no_shuffle_of_an_earlier_job(spark, sf_dir, monkeypatch):
    before, scratch, seen, load = _shuffles(spark), _scratch(spark), [], queries_io._load
    monkeypatch.setattr(queries_io, "_load", lambda *a: (seen.append(_left(spark, before)), load(*a)))
    span = queries_io.q_compacted_lines(spark, sf_dir)
    assert seen == [set()] * 4 and not _left(spark, before)
    # the source is gone, the lines are those of a read of the whole source
    assert sorted(n.split("-")[0] for n in _scratch(spark) - scratch) == ["flagged", "order_lines"]
    want = (ingest.batch_lines(queries.flagged(spark, sf_dir), "b", queries.INGESTED_AT, queries.QUARANTINED_AT)
            .filter(F.col("invoice_date").between(dt.datetime(1995, 3, 1), dt.datetime(1998, 2, 15)))
            .filter((F.col("load_status") == "quarantined") | F.col("_loadable")).count())
    assert span.agg(F.sum("line_rows")).first()[0] == want > 100


def test_published_lines_are_those_of_the_joined_tables(spark, sf_dir):
    root, kept = queries_io._published(spark, sf_dir)
    want = queries.flagged(spark, sf_dir).drop(*queries.FIXTURE_ORDER)
    assert kept.columns == want.columns and kept.count() == want.count() > 300
    assert kept.exceptAll(want).isEmpty() and want.exceptAll(kept).isEmpty()
    tables.compact_lines(spark, root)
    assert tables.read_lines(spark, root).filter(F.col("load_status") == "loaded").count() > 300


def test_csv_quarantine_packs_its_source_and_holds_no_earlier_shuffle(spark, sf_dir, monkeypatch):
    before, scratch, seen, run, write = _shuffles(spark), _scratch(spark), [], pipeline.run_pipeline, queries_io._write_ragged

    def watched(s, source, *a, **k):
        folder = source.removeprefix("file:")
        text = "\n".join(r[0] for r in spark.read.text(source).collect())
        seen.append((_left(spark, before), sum(os.path.getsize(f"{folder}/{n}") for n in os.listdir(folder) if n.startswith("part-")), len(text)))
        return run(s, source, *a, **k)

    monkeypatch.setattr(pipeline, "run_pipeline", watched)
    packed = sorted(map(str, queries_io.q_csv_quarantine(spark, sf_dir).collect()))
    (shuffles, size, text), = seen
    assert not shuffles and size < text * 0.6
    assert [n.split("-")[0] for n in _scratch(spark) - scratch] == ["warehouse"]
    monkeypatch.setattr(queries_io, "_write_ragged", lambda s, d, **k: write(s, d, short_lines=False))
    assert sorted(map(str, queries_io.q_csv_quarantine(spark, sf_dir).collect())) == packed


def test_small_packed_files_keep_the_order_of_the_lines(spark, sf_dir):
    def lines(path):
        return [tuple(r)[:-1] for r in read_source_csv(spark, path).orderBy("_ord").drop("_ord", "_overlong", "_bad_text", "_open_quote").collect()]

    plain = queries_io._write_ragged(spark, sf_dir, short_lines=True)
    packed = queries_io._write_ragged(spark, sf_dir, short_lines=True, compression="snappy", lines_per_file=7)
    assert len(list_files(spark, packed)) > 50
    assert lines(packed) == lines(plain) and len(lines(plain)) == 480


def test_test_suite_holds_no_shuffle_of_the_lines_it_derived(spark, sf_dir, monkeypatch):
    from tillflow.operators import datatests

    before, scratch, joins, derive = _shuffles(spark), _scratch(spark), [], ingest.transform

    def watched(source, *a, **k):
        joins.append("Join" in source._jdf.queryExecution().executedPlan().toString())
        return derive(source, *a, **k)

    monkeypatch.setattr(ingest, "transform", watched)
    suite = queries.q_test_suite(spark, sf_dir)
    # the joins were done before, so their shuffles never lie beside the dedup's
    assert joins == [False] and not _left(spark, before)
    assert [n.split("-")[0] for n in _scratch(spark) - scratch] == ["raw_orders"]
    want = datatests.test_suite(queries.models(spark, sf_dir).as_dict())
    assert sorted(map(str, suite.collect())) == sorted(map(str, want.collect()))
