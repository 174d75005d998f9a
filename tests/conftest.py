from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tillflow.session import apply_engine_conf, shared_dir

    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.scheduler.mode", "FAIR")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_engine_conf(s)
    # Tests set a shared folder only where the session has none.
    shared_dir(s, fallback=tempfile.mkdtemp(prefix="tillflow-ckpt-"))
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tillflow-test-")


HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"


@pytest.fixture()
def write_csv(tmpdir_path):
    """Write text (or bytes) to a CSV file in a fresh folder; returns the path."""
    counter = {"n": 0}

    def _w(body, name=None, header=HEADER):
        counter["n"] += 1
        name = name or f"f{counter['n']}.csv"
        path = os.path.join(tmpdir_path, name)
        data = body if isinstance(body, bytes) else ((header + "\n" if header else "") + body).encode()
        with open(path, "wb") as f:
            f.write(data)
        return path

    return _w
