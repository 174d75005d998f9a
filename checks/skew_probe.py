"""Skew check for the keep-last dedup: a third of the lines share one key.

    python checks/skew_probe.py [--sf /root/testdata/sf0.1] [--case dedup|customers]

Lines with l_linenumber in (1, 2) (about a third) get NULL invoice, stock
code and time, so they all fall into one dedup group (NULL keys group
together). The dedup runs with Spark's event log on; the script prints the
rows each reduce task of the dedup shuffle read. With the partial top-1
before the shuffle, the hot group arrives as at most one row per map task.

``--case customers`` instead gives those lines one customer id and builds
stg_customers: the distinct-invoice count and the sums are combined before
the final shuffle, so the hot customer reaches its reducer as a handful of
partial rows.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _task_reads(ev: str) -> dict:
    """Shuffle rows read per task, by stage, from the event log so far."""
    reads = {}
    files = [f for f in glob.glob(os.path.join(ev, "**", "*"), recursive=True)
             if os.path.isfile(f) and not os.path.basename(f).startswith("appstatus")]
    for f in files:
        for line in open(f, errors="replace"):
            try:
                e = json.loads(line)
            except json.JSONDecodeError:
                continue
            if e.get("Event") == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                n = e["Task Metrics"].get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                if n:
                    reads.setdefault(e["Stage ID"], []).append(n)
    return reads


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--case", choices=["dedup", "customers"], default="dedup")
    a = ap.parse_args()
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from tillflow.operators.clean import clean
    from tillflow.operators.dedup import dedup_keep_last
    from tillflow.plans import queries
    from tillflow.session import apply_engine_conf

    ev = tempfile.mkdtemp(prefix="tillflow-skew-ev-")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", ev).config("spark.eventLog.compress", "false")
             .config("spark.sql.adaptive.enabled", "false")  # keep the 8 reducers visible
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    apply_engine_conf(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    src = queries.source(spark, a.sf)
    hot = F.col("l_linenumber").isin(1, 2)
    if a.case == "customers":
        from tillflow.plans import ingest, staging

        src = src.withColumn("Customer ID", F.when(hot, F.lit("HOT")).otherwise(F.col("`Customer ID`")))
        total = src.count()
        hot_rows = src.filter(F.col("`Customer ID`") == "HOT").count()
        raw = ingest.raw_orders(ingest.transform(src), "b", queries.INGESTED_AT)
        path = os.path.join(tempfile.mkdtemp(prefix="tillflow-skew-raw-"), "raw")
        raw.write.parquet(path)
        kept = staging.stg_customers(spark.read.parquet(path)).count()
    else:
        src = src.select(*[F.when(hot, F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
                           if c in ("Invoice", "StockCode") else
                           (F.when(hot, F.lit(None).cast("timestamp_ntz")).otherwise(F.col(c)).alias(c)
                            if c == "InvoiceDate" else F.col(f"`{c}`")) for c in src.columns])
        total = src.count()
        hot_rows = src.filter(F.col("Invoice").isNull() & F.col("StockCode").isNull()
                              & F.col("InvoiceDate").isNull()).count()
        kept = dedup_keep_last(clean(src)).count()
    spark.stop()

    reads = _task_reads(ev)
    print(f"lines {total}, lines in the hot group {hot_rows} ({hot_rows / total:.0%}), result rows {kept}")
    for stage, rs in sorted(reads.items()):
        print(f"stage {stage}: reduce tasks {len(rs)}, rows read per task min {min(rs)} max {max(rs)} "
              f"total {sum(rs)}")


if __name__ == "__main__":
    main()
