"""Benchmark: the daily chain on the order-line source derived from the test
tables at $BENCH_SF_DIR (default /root/testdata/sf0.1), on local[$BENCH_CPUS].

The order lines derived from the test tables are first written as CSV text
(setup, not timed), the source format of the pipeline. Timed steps, after a
warm-up run of the same chain at sf0.01 (JVM start-up, code generation and
JIT are reported separately as startup_sec):
  ingest              CSV -> clean -> dedup -> quality split -> raw + quarantine
  build_marts         staging views + fct (this batch) / dim tables written
  data_tests          the 34 declared tests, results collected
  dashboard           KPIs, monthly revenue, peak, segments, countries, top
                      products, revenue by segment, quarantine breakdown
  ingest_from_tables  the same lines ingested straight from the test tables
                      (five-table join as the source) into a second warehouse
value = ingest + build_marts + data_tests (the daily chain).

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Set BENCH_EVENT_LOG=<folder> to keep Spark's event log there (read it with
checks/stage_times.py).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    t_start = time.time()
    from pyspark.sql import SparkSession

    from tillflow.session import apply_engine_conf, shared_dir

    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tillflow-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
             # concurrent independent jobs share the cores (as get_session sets)
             .config("spark.scheduler.mode", os.environ.get("BENCH_SCHEDULER_MODE", "FAIR"))
             .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
             # throughput collector for a batch JVM (override with BENCH_JAVA_OPTS)
             .config("spark.driver.extraJavaOptions", os.environ.get("BENCH_JAVA_OPTS", "-XX:+UseParallelGC"))
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.eventLog.enabled", "true" if os.environ.get("BENCH_EVENT_LOG") else "false")
             .config("spark.eventLog.dir", os.environ.get("BENCH_EVENT_LOG", "/tmp"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    apply_engine_conf(spark)
    work = tempfile.mkdtemp(prefix="tillflow-bench-")
    shared_dir(spark, fallback=os.path.join(work, "shared"))

    from tillflow.plans import pipeline, queries
    from tillflow.plans.catalog import ModelParams
    from tillflow.sources.fixtures import FIXTURE_ORDER, fixture_orders
    import datetime as dt

    params = ModelParams(as_of=dt.date(2001, 8, 31), spine_start=dt.date(1995, 1, 1), spine_days=2557)

    def write_csv(src_dir: str, out: str) -> str:
        """Setup (not timed): the order lines derived from the test tables as
        CSV text, in file order (range-partitioned on the order columns, so
        part files and the rows inside them follow that order)."""
        src = fixture_orders(spark, src_dir)
        (src.repartitionByRange(cpus, *FIXTURE_ORDER).sortWithinPartitions(*FIXTURE_ORDER)
         .drop(*FIXTURE_ORDER).write.option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSS").csv(out))
        return out

    def chain(source, wh: str, timings: dict | None):
        def step(name, fn):
            t = time.time()
            out = fn()
            if timings is not None:
                timings[name] = round(time.time() - t, 3)
            return out

        res = step("ingest", lambda: pipeline.run_pipeline(spark, source, wh, batch_id="bench"))
        built = step("build_marts", lambda: pipeline.build_marts(spark, wh, params, batches=[res.batch_id]))
        step("data_tests", lambda: pipeline.run_tests(spark, wh, params, raise_on_failure=False,
                                                      models=built, batches=[res.batch_id]).collect())
        pipeline.release(built)
        step("dashboard", lambda: pipeline.collect_all(pipeline.dashboard(spark, wh)))
        return res

    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.01")
    if not os.path.isdir(warm_dir):
        warm_dir = "/root/testdata/sf0.001"
    chain(write_csv(warm_dir, os.path.join(work, "warm_csv")), os.path.join(work, "warm"), None)
    startup = time.time() - t_start

    csv_dir = write_csv(sf_dir, os.path.join(work, "csv"))
    timings: dict[str, float] = {}
    res = chain(csv_dir, os.path.join(work, "wh"), timings)

    # The same lines straight from the test tables (5-table join as source).
    t = time.time()
    res_tables = pipeline.run_pipeline(spark, queries.source(spark, sf_dir), os.path.join(work, "wh_tables"),
                                       batch_id="bench_tables")
    timings["ingest_from_tables"] = round(time.time() - t, 3)

    # The daily chain of the source project: ingest >> build models >> test.
    chain_total = sum(timings[k] for k in ("ingest", "build_marts", "data_tests"))
    rows = res.records_read
    out = {
        "metric": "pipeline_seconds",
        "value": round(chain_total, 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "rows": rows,
        "rows_per_sec": round(rows / chain_total, 1) if chain_total else None,
        "ingest_rows_per_sec": round(rows / timings["ingest"], 1) if timings["ingest"] else None,
        "records_loaded": res.records_loaded,
        "records_quarantined": res.records_quarantined,
        "tables_records_loaded": res_tables.records_loaded,
        "startup_sec": round(startup, 3),
        "warmup": os.path.basename(warm_dir),
        "value_steps": ["ingest", "build_marts", "data_tests"],
        "source": "csv",
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
