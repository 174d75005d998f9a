"""Plan shapes that the engine relies on at scale."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tillflow.operators.dedup import dedup_keep_last
from tillflow.operators.incremental import filter_new_records
from tillflow.plans import pipeline, queries, staging

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_dedup_cuts_groups_before_the_shuffle(spark):
    import re

    plan = _plan(dedup_keep_last(queries.cleaned(spark, SF)))
    # details section: "(n) WindowGroupLimit" followed by its arguments
    limits = {int(n): mode for n, mode in
              re.findall(r"\((\d+)\) WindowGroupLimit\n(?:[^\n]*\n)*?Arguments: [^\n]*, (Partial|Final)", plan)}
    exchanges = [int(n) for n in re.findall(r"\((\d+)\) Exchange\n", plan)]
    partial = [n for n, m in limits.items() if m == "Partial"]
    final = [n for n, m in limits.items() if m == "Final"]
    assert partial and final
    # node ids grow towards the root: partial limit, then the shuffle, then the final limit
    assert any(partial[0] < e < final[0] for e in exchanges)


def test_staging_aggregates_combine_map_side(spark):
    raw = queries.raw_orders(spark, SF)
    for df in (staging.stg_customers(raw), staging.stg_products(raw)):
        plan = _plan(df)
        assert "partial_" in plan          # partial aggregation before each exchange


def test_no_python_udfs_in_registered_queries(spark):
    for name, fn in queries.QUERIES.items():
        plan = _plan(fn(spark, SF))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in plan, f"{name} uses {node}"


def test_reads_prune_columns_and_partitions(spark, tmpdir_path):
    import re

    wh = os.path.join(tmpdir_path, "wh")
    pipeline.run_pipeline(spark, queries.source(spark, SF), wh, batch_id="p1")
    raw = pipeline.read_raw(spark, wh)
    plan = _plan(raw.filter(F.col("batch_id") == "p1").select("invoice_no"))
    parts = re.search(r"PartitionFilters: \[([^\n]*)\]", plan).group(1)
    assert re.search(r"batch_id#\d+ = p1", parts) and re.search(r"load_status#\d+ = loaded", parts)
    assert "ReadSchema: struct<invoice_no:string>" in plan
    # the high-water-mark filter on a typed source reaches the Parquet scan
    pushed = re.search(r"PushedFilters: \[([^\n]*)\]",
                       _plan(filter_new_records(raw, dt.datetime(1998, 1, 1), "100"))).group(1)
    assert "GreaterThan(invoice_date" in pushed


def test_report_joins_see_pre_aggregated_facts(spark):
    from tillflow.plans import reports

    m = queries.models(spark, SF)
    plan = _plan(reports.revenue_by_segment(m.fct_orders, m.dim_customers))
    # the fact is summed per customer before it meets the dimension
    join_at = plan.find("Join")
    assert join_at > 0 and "partial_sum" in plan


def _scans(plan: str, column: str) -> int:
    """Scans of a table that read this column."""
    import re

    return len(re.findall(rf"ReadSchema: struct<[^\n]*\b{column}\b", plan))


def test_star_join_reads_the_fact_once_and_spreads_null_keys(spark, tmpdir_path):
    from tillflow.plans import reports

    m = queries.models(spark, SF)
    m.fct_orders.write.parquet(f"{tmpdir_path}/fct")
    m.dim_customers.write.parquet(f"{tmpdir_path}/dim")
    fct, dim = (spark.read.parquet(f"{tmpdir_path}/{n}") for n in ("fct", "dim"))
    plan = _plan(reports.star_orders_customers(fct, dim.hint("merge")))
    assert _scans(plan, "order_key") == 1 and "Union" not in plan.split("\n\n\n", 1)[0]
    # the join key is (customer, salt), so lines without a customer do not hash alike
    assert "hashpartitioning(customer_id" in plan and "_salt" in plan


def test_headline_and_data_tests_read_each_model_once(spark, tmpdir_path):
    from tillflow.operators import datatests
    from tillflow.plans import reports

    m = queries.models(spark, SF)
    m.fct_orders.write.parquet(f"{tmpdir_path}/fct")
    fct = spark.read.parquet(f"{tmpdir_path}/fct")
    plan = _plan(reports.kpi_headline(fct))
    assert _scans(plan, "invoice_no") == 1 and "partial_" in plan
    spec = datatests.DECLARED_TESTS[-1]
    plan = _plan(datatests.run_model_tests(fct, spec))
    assert _scans(plan, "order_key") == 1


def test_filters_on_the_keys_stay_above_the_dedup(spark):
    """No filter over the deduplicated lines is moved into the joins below, where the
    cleaning of a key would be written out again for each of its uses."""
    import re

    for name in ("test_unique", "stg_products", "raw_orders"):
        plan = _plan(queries.QUERIES[name](spark, SF))
        for node, condition in re.findall(r"\(\d+\) (Filter|SortMergeJoin|BroadcastHashJoin)[^\n]*\n(?:[^\n]+\n)*?"
                                          r"(?:Condition|Join condition) ?: ([^\n]*(?:\n[^\n]+)*)", plan):
            if "_keep_rank" not in condition:
                assert "CASE WHEN" not in condition and "trim(" not in condition, (name, node)


def test_queries_over_many_models_derive_the_lines_once(spark):
    """The models of one query meet over lines that were derived from the tables once."""
    for name in ("kpi_headline", "star_orders_products", "test_suite"):
        plan = _plan(queries.QUERIES[name](spark, SF))
        assert "l_orderkey" not in plan and _scans(plan, "invoice_no") > 0, name


def test_compacted_lines_derives_the_lines_once(spark, monkeypatch):
    from tillflow.plans import queries_io

    calls, flagged = [], queries.flagged
    monkeypatch.setattr(queries, "flagged", lambda *a, **k: calls.append(a) or flagged(*a, **k))
    assert queries_io.q_compacted_lines(spark, SF).count() > 0
    assert len(calls) == 1


def test_engine_conf_keeps_generated_code_compilable(spark):
    """A second run's cleaning and mark made one method of more than 8,000 bytes, which the
    JVM only interprets; such a stage runs operator by operator."""
    from tillflow.session import ENGINE_CONF

    assert int(ENGINE_CONF["spark.sql.codegen.hugeMethodLimit"]) <= 8000
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_batch_lines_work_out_records_only_for_the_quarantine(spark):
    import datetime as dt

    from tillflow.plans import ingest
    from tillflow.operators.quality import flag_quality

    at = dt.datetime(2001, 1, 1)
    rows = [("1", "A", "x" * 501, 1e12, at, 2.0, "c", "FR"), ("2", "B", "ok", 1.0, at, 1e12, "c", "FR"), ("3", "C", "ok", 1.0, at, 2.0, "c", "FR"),
            (None, "D", "x" * 501, 1.0, at, 2.0, "c", "FR")]
    flagged = flag_quality(spark.createDataFrame(rows, "invoice_no string, stock_code string, description string, quantity double, "
                                                       "invoice_date timestamp_ntz, unit_price double, customer_id string, country string"))
    skipped = ingest.batch_lines(flagged, "b", at, at)
    plan = skipped._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan and "Json" not in plan and "to_json" not in plan
    got = sorted((str(r.stock_code), r.load_status, r.error_reason, r.raw_record, r._loadable, r._unfit) for r in skipped.collect())
    assert got == [("A", "loaded", None, None, False, True), ("B", "loaded", None, None, False, True), ("C", "loaded", None, None, True, False),
                   ("D", "quarantined", "invoice_no is null; ", None, False, False)]
    kept = {r.stock_code: r for r in ingest.batch_lines(flagged, "b", at, at, "quarantine").collect()}
    assert kept["A"].error_reason == "description does not fit the raw table; quantity does not fit the raw table; "
    assert kept["B"].error_reason == "unit_price does not fit the raw table; " and '"invoice_no":"2"' in kept["B"].raw_record
    assert (kept["C"].load_status, kept["C"].raw_record, kept["D"].raw_record, kept["D"].error_reason) == (
        "loaded", None, None, "invoice_no is null; ")
