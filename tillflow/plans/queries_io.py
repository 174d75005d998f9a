"""Named queries for the stateful and I/O operators: state upserts, batch
publishing, CSV reading and whole pipeline runs. Each one derives its input
from the test tables, writes what it needs under the shared folder
(``spark.checkpoint.dir``) and returns a DataFrame over the result.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.config import PIPELINE_NAME
from tillflow.operators.clean import clean
from tillflow.operators.conform import LOADABLE_COL
from tillflow.operators.incremental import watermark_expr
from tillflow.operators.quality import REASON_COL
from tillflow.plans import ingest, pipeline, queries
from tillflow.session import freed_shuffles, scratch_path
from tillflow.sinks.tables import (
    BATCH_COL,
    STATUS_COL,
    compact_lines,
    delete_path,
    incoming_folder,
    publish_batch,
    read_lines,
    read_raw_orders,
    write_incoming,
)
from tillflow.sources.csv_source import detect_encoding, drop_check_columns, read_source_csv
from tillflow.sources.fixtures import FIXTURE_ORDER, fixture_orders
from tillflow.state.pipeline_state import (
    AUDIT_KEYS,
    AUDIT_SCHEMA,
    AUDIT_UPDATES,
    WATERMARK_KEYS,
    WATERMARK_SCHEMA,
    WATERMARK_UPDATES,
    run_history,
)
from tillflow.state.versioned import upsert

CUT = dt.datetime(1998, 1, 1)
TARGET_UPDATED_AT = dt.datetime(2001, 1, 1)
SOURCE_UPDATED_AT = dt.datetime(2001, 9, 1)
IDS = ("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")
ID_TYPES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_linenumber": "int", "l_suppkey": "bigint"}


def _ts(value: dt.datetime):
    return F.lit(value).cast("timestamp_ntz")


def _clean_flagged(spark, sf_dir) -> DataFrame:
    return queries.flagged(spark, sf_dir).filter(F.col(REASON_COL) == "")


def _marks_by_country(df: DataFrame) -> DataFrame:
    return df.groupBy("country").agg(watermark_expr().alias("_wm")).select("country", "_wm.*")


# -- state tables ------------------------------------------------------------------

def q_watermark_upsert(spark, sf_dir):
    """Per-country marks of the first years as the stored table,
    per-country marks of all years as the update; lower-case countries match
    their stored row, the others arrive under a second source table name."""
    f = _clean_flagged(spark, sf_dir)
    first = _marks_by_country(f.filter(F.col("invoice_date") < _ts(CUT)))
    target = first.select(F.col("country").alias("pipeline_name"), F.lit("raw_orders").alias("source_table"),
                          "last_processed_at", "last_invoice_no", _ts(TARGET_UPDATED_AT).alias("updated_at"))
    every = _marks_by_country(f)
    source = every.select(
        F.col("country").alias("pipeline_name"),
        F.when(F.lower("country") == F.col("country"), F.lit("raw_orders"))
        .otherwise(F.lit("raw_orders_v2")).alias("source_table"),
        "last_processed_at", "last_invoice_no", _ts(SOURCE_UPDATED_AT).alias("updated_at"))
    target = target.select(*[F.col(x.name).cast(x.dataType) for x in WATERMARK_SCHEMA.fields])
    return upsert(target, source, WATERMARK_KEYS, WATERMARK_UPDATES)


def _audit_upserted(spark, sf_dir) -> DataFrame:
    """One audit row per order day. Days up to 1996 start as
    in-progress runs; days from 1996 on report completion (from a writer with
    another pipeline name and start time, which the update must not take)."""
    f = queries.flagged(spark, sf_dir).filter(F.col("invoice_date").isNotNull())
    days = (f.withColumn("_day", F.to_date("invoice_date"))
            .groupBy("_day").agg(F.min("invoice_date").alias("first_ts"), F.max("invoice_date").alias("last_ts"),
                                 F.count(F.lit(1)).alias("lines"),
                                 F.count_if(F.col(REASON_COL) == "").alias("clean"),
                                 F.count_if(F.col(REASON_COL) != "").alias("rejected"))
            .withColumn("batch_id", F.concat(F.lit("orders_"), F.date_format("_day", "yyyyMMdd")))
            .withColumn("_year", F.year("_day")))
    target = days.filter(F.col("_year") <= 1996).select(
        "batch_id", F.lit(PIPELINE_NAME).alias("pipeline_name"), F.lit("in_progress").alias("status"),
        F.lit(0).cast("long").alias("records_read"), F.lit(0).cast("long").alias("records_loaded"),
        F.col("first_ts").alias("started_at"), F.lit(None).cast("timestamp_ntz").alias("completed_at"),
        F.lit(None).cast("double").alias("duration_seconds"), F.lit(None).cast("string").alias("error_message"),
        F.col("first_ts").alias("updated_at"))
    source = days.filter(F.col("_year") >= 1996).select(
        "batch_id", F.lit("late_writer").alias("pipeline_name"), F.lit("success").alias("status"),
        F.col("lines").cast("long").alias("records_read"), F.col("clean").cast("long").alias("records_loaded"),
        F.col("last_ts").alias("started_at"), F.col("last_ts").alias("completed_at"),
        F.timestamp_diff("SECOND", F.col("first_ts"), F.col("last_ts")).cast("double").alias("duration_seconds"),
        F.when(F.col("rejected") > 0, F.concat(F.lit("rejected "), F.col("rejected").cast("string")))
        .alias("error_message"),
        F.col("last_ts").alias("updated_at"))
    target = target.select(*[F.col(x.name).cast(x.dataType) for x in AUDIT_SCHEMA.fields])
    return upsert(target, source, AUDIT_KEYS, AUDIT_UPDATES)


def q_audit_upsert(spark, sf_dir):
    return _audit_upserted(spark, sf_dir)


def q_audit_history(spark, sf_dir):
    """U6 over the upserted audit table."""
    return run_history(_audit_upserted(spark, sf_dir)).select(
        "status", F.col("runs").cast("long").alias("runs"), F.col("records_read").cast("long").alias("records_read"),
        F.col("records_loaded").cast("long").alias("records_loaded"), "avg_duration_seconds")


# -- batch publishing ----------------------------------------------------------------

def _load(spark, root: str, flagged: DataFrame, batch_id: str) -> None:
    lines = ingest.batch_lines(flagged, batch_id, queries.INGESTED_AT, queries.QUARANTINED_AT)
    lines = lines.filter((F.col(STATUS_COL) != "loaded") | F.col(LOADABLE_COL)).drop(LOADABLE_COL, ingest.UNFIT_COL)
    publish_batch(spark, root, write_incoming(lines, incoming_folder(root, batch_id)), batch_id)


def _published(spark, sf_dir) -> tuple[str, DataFrame]:
    """Two batches (order days before / from 1998) published into a fresh
    order_lines table, then the first batch published again. Returns the table
    and the flagged lines, which are derived once and kept."""
    root, kept = scratch_path(spark, "order_lines"), scratch_path(spark, "flagged")
    with queries.written_source(spark, sf_dir) as src, freed_shuffles(spark):
        flagged = queries.flagged(spark, sf_dir, src=src).drop(*FIXTURE_ORDER)
        flagged.write.parquet(kept)
    f = spark.read.schema(flagged.schema).parquet(kept)
    early = F.coalesce(F.col("invoice_date") < _ts(CUT), F.lit(False))
    _load(spark, root, f.filter(early), "b_early")
    _load(spark, root, f.filter(~early), "b_late")
    _load(spark, root, f.filter(early), "b_early")
    return root, f


def q_batch_overwrite(spark, sf_dir):
    """K2 / K6: rows and quantity per batch and load status after a batch was
    published twice (replaced, not appended)."""
    lines = read_lines(spark, _published(spark, sf_dir)[0])
    return (lines.groupBy(BATCH_COL, STATUS_COL)
            .agg(F.count(F.lit(1)).alias("line_rows"), F.sum("quantity").cast("double").alias("quantity")))


def q_batch_count(spark, sf_dir):
    """K5: loaded rows of one batch (reads one partition folder)."""
    raw = read_raw_orders(spark, _published(spark, sf_dir)[0])
    return raw.filter(F.col(BATCH_COL) == "b_late").agg(F.count(F.lit(1)).alias("records_loaded"))


# -- CSV source ------------------------------------------------------------------------

def _write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    (df.write.option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSS").option("encoding", encoding)
     .csv(path))


def _typed_ids(df: DataFrame):
    return [F.col(c).cast(ID_TYPES[c]).alias(c) for c in IDS]


def q_csv_roundtrip(spark, sf_dir):
    """The source lines written as CSV text (ids as extra
    columns), read back as text with the missing-value tokens, then typed."""
    path = scratch_path(spark, "csv")
    _write_csv(fixture_orders(spark, sf_dir).drop("l_extendedprice"), path)
    back = clean(drop_check_columns(read_source_csv(spark, path)))
    return back.select(*_typed_ids(back), "invoice_no", "stock_code", "description", "quantity", "invoice_date",
                       "unit_price", "customer_id", "country")


def _write_ragged(spark, sf_dir, short_lines: bool, compression: str = "none", lines_per_file: int = 0) -> str:
    """The source lines as raw CSV text in file order; lines 7 of an order get one field too
    many, and ``short_lines`` makes lines 6 stop after the third source field. Compressed
    files are read whole, so ``lines_per_file`` keeps them small (0: no limit)."""
    cols = list(IDS) + ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price",
                        "Customer ID", "Country"]
    text = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in cols]
    full = F.concat_ws(",", *text)
    short = F.concat_ws(",", *text[:len(IDS) + 3])
    line = F.when(F.col("l_linenumber") == 7, F.concat(full, F.lit(",EXTRA")))
    if short_lines:
        line = line.when(F.col("l_linenumber") == 6, short)
    path = scratch_path(spark, "csv_ragged")
    # One text column per line; a separator that never occurs keeps the
    # writer from quoting the commas inside it.
    with queries.written_source(spark, sf_dir) as src, freed_shuffles(spark):
        (src.orderBy(*IDS).select(line.otherwise(full).alias(",".join(cols))).write.option("header", True).option("sep", "\u0001")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .option("compression", compression).option("maxRecordsPerFile", lines_per_file).csv(path))
    return path


def q_csv_ragged(spark, sf_dir):
    """Rows with too many and too few fields, told apart."""
    path = _write_ragged(spark, sf_dir, short_lines=True)
    back = read_source_csv(spark, path)
    return back.select(*_typed_ids(back), F.col("_overlong").alias("overlong"),
                       F.col("Country").isNull().alias("padded"))


def q_csv_latin1_fallback(spark, sf_dir):
    """S3: descriptions with a non-ASCII letter written as ISO-8859-1; the
    probe finds text that is not UTF-8 and the source is read as Latin-1."""
    src = fixture_orders(spark, sf_dir).drop("l_extendedprice")
    src = src.withColumn("Description", F.translate("Description", "E", "É"))
    path = scratch_path(spark, "csv_latin1")
    _write_csv(src, path, encoding="ISO-8859-1")
    enc = detect_encoding(spark, path)
    back = read_source_csv(spark, path, encoding=enc)
    return back.select(*_typed_ids(back), "Description", F.lit(enc).alias("encoding"))


# -- whole pipeline ------------------------------------------------------------------------

def q_pipeline_end_to_end(spark, sf_dir):
    """Two incremental runs (order days before
    1998, then everything) into a fresh warehouse; the loaded lines."""
    wh = scratch_path(spark, "warehouse")
    src = queries.source(spark, sf_dir)
    clock = lambda: queries.INGESTED_AT
    pipeline.run_pipeline(spark, src.filter(F.col("InvoiceDate") < _ts(CUT)), wh, batch_id="e2e_1", clock=clock)
    pipeline.run_pipeline(spark, src, wh, batch_id="e2e_2", clock=clock)
    raw = pipeline.read_raw(spark, wh)
    return queries.to_double(raw.select("invoice_no", "stock_code", "description", "quantity", "invoice_date",
                                        "unit_price", "customer_id", "country", "batch_id"))


def q_csv_quarantine(spark, sf_dir):
    """One run that sets aside overlong records and rows that do not fit, both with
    what they were; rows by status and reason."""
    wh = scratch_path(spark, "warehouse")
    source = _write_ragged(spark, sf_dir, short_lines=False, compression="snappy", lines_per_file=100_000)
    pipeline.run_pipeline(spark, source, wh, batch_id="q", on_ragged="quarantine", on_unfit="quarantine",
                          clock=lambda: queries.INGESTED_AT)
    delete_path(spark, source)      # the batch has what it held
    lines = read_lines(spark, pipeline.Layout(wh).lines)
    return (lines.groupBy(STATUS_COL, REASON_COL)
            .agg(F.count(F.lit(1)).alias("line_rows"), F.count_distinct("invoice_no").alias("invoices"),
                 F.count("raw_record").alias("with_record")))


def q_no_new_rows(spark, sf_dir):
    """A second run over an unchanged source reads only rejected lines past
    the mark, loads nothing and leaves the mark."""
    wh = scratch_path(spark, "warehouse")
    src = queries.source(spark, sf_dir)
    for batch in ("first", "second"):
        pipeline.run_pipeline(spark, src, wh, batch_id=batch, clock=lambda: queries.INGESTED_AT)
    layout = pipeline.Layout(wh)
    second = (pipeline.AuditLog(spark, layout.audit).frame().filter(F.col("batch_id") == "second")
              .select("records_read", "records_loaded"))
    mark = pipeline.WatermarkStore(spark, layout.watermark).frame().select(
        F.col("last_processed_at").alias("marked_at"), F.col("last_invoice_no").alias("marked_invoice"))
    rows = pipeline.read_raw(spark, wh).agg(F.count(F.lit(1)).alias("raw_rows"))
    return second.crossJoin(rows).crossJoin(mark)      # one row each


def q_audit_lifecycle(spark, sf_dir):
    """A run for each year of order dates is started, then completes or fails by
    the audit log's own calls; the folded log."""
    f = queries.flagged(spark, sf_dir).filter(F.col("invoice_date").isNotNull())
    years = (f.groupBy(F.year("invoice_date").alias("y"))
             .agg(F.min("invoice_date").alias("first_ts"), F.max("invoice_date").alias("last_ts"),
                  F.count(F.lit(1)).alias("lines"), F.count_if(F.col(REASON_COL) == "").alias("clean")).collect())
    audit = pipeline.AuditLog(spark, scratch_path(spark, "audit"))
    audit.ensure()
    for r in years:
        audit.start(f"orders_{r.y}", PIPELINE_NAME, r.first_ts)
    for r in years:
        if r.y % 2 == 0:
            audit.complete(f"orders_{r.y}", "late_writer", r.first_ts, r.lines, r.clean, r.last_ts)
        else:
            audit.fail(f"orders_{r.y}", "late_writer", r.first_ts, f"year {r.y}", r.last_ts)
    return audit.frame().drop("updated_at")


def q_marts_written(spark, sf_dir):
    """Two daily builds (order days before 1998, then the rest); the second updates
    the dimensions from its own lines and the state. Rows of the mart tables."""
    wh = scratch_path(spark, "warehouse")
    src = queries.source(spark, sf_dir)
    clock = lambda: queries.INGESTED_AT
    params = pipeline.ModelParams(as_of=queries.AS_OF)
    pipeline.run_pipeline(spark, src.filter(F.col("InvoiceDate") < _ts(CUT)), wh, batch_id="m1", clock=clock)
    pipeline.release(pipeline.build_marts(spark, wh, params, batches=["m1"]))
    pipeline.run_pipeline(spark, src, wh, batch_id="m2", clock=clock)
    m = pipeline.build_marts(spark, wh, params, batches=["m2"])

    def rows(mart, name, counted, amount, label, first, last):
        return m[mart].select(F.lit(mart).alias("mart"), F.col(name).alias("name"), counted.cast("long").alias("counted"),
                              F.col(amount).cast("double").alias("amount"), F.col(label).alias("label"),
                              F.col(first).alias("first_at"), F.col(last).alias("last_at"))
    facts = m["fct_orders"].groupBy(F.lit("fct_orders").alias("mart"), F.col("batch_id").alias("name")).agg(
        F.count(F.lit(1)).alias("counted"), F.sum("net_line_total").cast("double").alias("amount"),
        F.lit(None).cast("string").alias("label"), F.min("invoice_date").alias("first_at"), F.max("invoice_date").alias("last_at"))
    return (rows("dim_customers", "customer_id", F.col("total_orders"), "lifetime_revenue", "customer_segment",
                 "first_order_date", "last_order_date")
            .unionByName(rows("dim_products", "stock_code", F.col("times_ordered") * 1_000_000 + F.col("unique_customers"),
                              "total_units_sold", "product_tier", "first_sold_date", "last_sold_date"))
            .unionByName(facts))


def q_compacted_lines(spark, sf_dir):
    """Batches folded into the months of the history, one of them replaced and one
    added afterwards; the lines of a span of time, read from its months."""
    root, f = _published(spark, sf_dir)
    compact_lines(spark, root)
    _load(spark, root, f.filter(F.coalesce(F.col("invoice_date") < _ts(CUT), F.lit(False))), "b_early")
    span = read_lines(spark, root, since=dt.datetime(1995, 3, 1), until=dt.datetime(1998, 2, 15))
    return (span.groupBy(F.date_format("invoice_date", "yyyy-MM").alias("month"), STATUS_COL)
            .agg(F.count(F.lit(1)).alias("line_rows"), F.sum("quantity").cast("double").alias("quantity")))


QUERIES = {
    "watermark_upsert": q_watermark_upsert,
    "audit_upsert": q_audit_upsert,
    "audit_history": q_audit_history,
    "batch_overwrite": q_batch_overwrite,
    "batch_count": q_batch_count,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_ragged": q_csv_ragged,
    "csv_latin1_fallback": q_csv_latin1_fallback,
    "pipeline_end_to_end": q_pipeline_end_to_end,
    "csv_quarantine": q_csv_quarantine,
    "audit_lifecycle": q_audit_lifecycle,
    "no_new_rows": q_no_new_rows,
    "marts_written": q_marts_written,
    "compacted_lines": q_compacted_lines,
}
