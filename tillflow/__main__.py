"""Command line for the daily chain.

    python -m tillflow ingest    --source <csv path/glob> --warehouse <dir> [--batch-id ID]
    python -m tillflow build     --warehouse <dir> [--batches ID ...] [--as-of YYYY-MM-DD]
    python -m tillflow test      --warehouse <dir>
    python -m tillflow daily     --source <csv> --warehouse <dir>     (ingest >> build >> test)
    python -m tillflow dashboard --warehouse <dir>
    python -m tillflow stream    --source <folder> --warehouse <dir> [--continuous]

Run it with spark-submit on a cluster (spark.checkpoint.dir must name a
shared folder); locally it starts a local session.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from tillflow.config import PIPELINE_NAME, IngestOptions
from tillflow.plans import pipeline
from tillflow.plans.catalog import ModelParams
from tillflow.session import get_session


def _params(a) -> ModelParams:
    p = ModelParams()
    if getattr(a, "as_of", None):
        p.as_of = dt.date.fromisoformat(a.as_of)
    if getattr(a, "spine_start", None):
        p.spine_start = dt.date.fromisoformat(a.spine_start)
    if getattr(a, "spine_days", None):
        p.spine_days = a.spine_days
    return p


def _ingest(spark, a):
    opts = IngestOptions(string_nulls=a.string_nulls, normalize_ids=a.normalize_ids,
                         keep_null_dates=a.keep_null_dates, date_first=a.date_first)
    source = a.source
    if a.source_format == "parquet":
        from tillflow.sources.parquet_source import read_source_parquet

        source = read_source_parquet(spark, a.source)
    res = pipeline.run_pipeline(spark, source, a.warehouse, pipeline_name=a.pipeline_name,
                                batch_id=a.batch_id, options=opts, multi_line=True if a.multi_line else "auto",
                                encoding=a.encoding, on_ragged=a.on_ragged, on_unfit=a.on_unfit, publish=a.publish,
                                new_files_only=a.new_files_only, compact_after=a.compact_after)
    print(json.dumps({"batch_id": res.batch_id, "status": res.status, "records_read": res.records_read,
                      "records_loaded": res.records_loaded, "records_quarantined": res.records_quarantined,
                      "records_skipped": res.records_skipped, "duplicates_removed": res.duplicates_removed}))
    return res


def _test(spark, a, models=None, batches=None) -> int:
    print(f"tests of batches {', '.join(batches)} only" if batches else "tests of whole models")
    rows = pipeline.run_tests(spark, a.warehouse, _params(a), raise_on_failure=False, models=models,
                              batches=batches).collect()
    failed = [r for r in rows if not r["passed"]]
    for r in rows:
        print(f"{'PASS' if r['passed'] else 'FAIL'} {r['model']}.{r['column_name']} {r['test']} "
              f"failures={r['failures']}")
    print(f"{len(rows) - len(failed)} passed, {len(failed)} failed")
    return 1 if failed else 0


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tillflow")
    ap.add_argument("command", choices=["ingest", "build", "test", "daily", "dashboard", "stream"])
    ap.add_argument("--source")
    ap.add_argument("--source-format", choices=["csv", "parquet"], default="csv")
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--batch-id")
    ap.add_argument("--batches", nargs="*")
    ap.add_argument("--pipeline-name", default=PIPELINE_NAME)
    ap.add_argument("--as-of")
    ap.add_argument("--spine-start")
    ap.add_argument("--spine-days", type=int)
    ap.add_argument("--string-nulls", choices=["null", "nan"], default="null")
    ap.add_argument("--normalize-ids", action="store_true")
    ap.add_argument("--keep-null-dates", action="store_true")
    ap.add_argument("--date-first", choices=["month", "day"], default="month")
    ap.add_argument("--multi-line", action="store_true")
    ap.add_argument("--encoding", default="auto")
    ap.add_argument("--on-ragged", choices=["fail", "quarantine"], default="fail")
    ap.add_argument("--on-unfit", choices=["skip", "quarantine"], default="skip")
    ap.add_argument("--new-files-only", action="store_true", help="leave out files that an earlier batch has read")
    ap.add_argument("--compact-after", type=int, help="fold the batch folders into months when there are so many")
    ap.add_argument("--publish", choices=["rename", "direct"], default="rename")
    ap.add_argument("--continuous", action="store_true")
    ap.add_argument("--scope-tests", action="store_true", help="daily: test only what this batch adds")
    a = ap.parse_args(argv)

    spark = get_session()
    if a.command == "ingest":
        _ingest(spark, a)
        return 0
    if a.command == "build":
        pipeline.build_marts(spark, a.warehouse, _params(a), batches=a.batches)
        return 0
    if a.command == "test":
        return _test(spark, a, batches=a.batches)
    if a.command == "daily":
        res = _ingest(spark, a)
        models = pipeline.build_marts(spark, a.warehouse, _params(a), batches=[res.batch_id])
        code = _test(spark, a, models, batches=[res.batch_id] if a.scope_tests else None)
        pipeline.release(models)
        return code
    if a.command == "dashboard":
        for name, rows in pipeline.collect_all(pipeline.dashboard(spark, a.warehouse)).items():
            print(f"== {name}")
            for r in rows:
                print("  ", {k: (str(v) if v is not None else None) for k, v in r.asDict().items()})
        return 0
    if a.command == "stream":
        from tillflow.streaming.file_ingest import start_file_ingest

        q = start_file_ingest(spark, a.source, a.warehouse, pipeline_name=a.pipeline_name,
                              available_now=not a.continuous, options=IngestOptions(
                                  string_nulls=a.string_nulls, normalize_ids=a.normalize_ids,
                                  keep_null_dates=a.keep_null_dates, date_first=a.date_first),
                              multi_line=a.multi_line, on_ragged=a.on_ragged)
        q.awaitTermination()
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
