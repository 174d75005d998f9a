"""Driver contract and a Spark-vs-DuckDB spot check at the smallest scale."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import TABLES, _rows

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert set(df.columns) == {"customer_segment", "customers", "share_pct"}


def test_every_query_has_an_oracle():
    # training-data operators that SQL cannot express are tested with that subpackage
    assert set(entry.oracle_sql()) | set(entry._LLM_QUERIES) == set(entry.queries())


@pytest.mark.parametrize("key", ["dedup_keep_last", "quality_rejected", "stg_products", "dim_customers",
                                 "revenue_by_segment", "test_suite", "dim_date"])
def test_matches_duckdb(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sdf = entry.queries()[key](spark, SF)
    rel = con.sql(entry.oracle_sql()[key])
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(rel.columns, rel.fetchall())


def test_imports_without_the_training_data_part(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(root, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    for with_pipeline in (False, True):  # the pipeline's file may stay when the subpackage goes
        if with_pipeline:
            (tmp_path / "copy" / "corpus_pipeline.py").write_text("from tillflow.llm import quality\n")
        said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                              cwd=tmp_path / "copy", capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
        assert said.returncode == 0, said.stderr
        left = set(entry.queries()) - set(entry._LLM_QUERIES)
        assert said.stdout.split() == [str(len(left))] * 2
