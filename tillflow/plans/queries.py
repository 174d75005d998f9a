"""Named queries over the test tables, one per operator group of the engine.

Every query starts from the order-line source derived from the given tables
(``sources.fixtures``), so its work grows with them. Fixed batch id, clock
and reporting day make the results deterministic. Decimal columns are cast
to double at the query boundary so results compare across engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillflow.config import SOURCE_COLUMNS, IngestOptions
from tillflow.functions import na_tokens_to_null
from tillflow.operators import clean as clean_ops
from tillflow.operators import datatests, incremental
from tillflow.operators.conform import LOADABLE_COL
from tillflow.operators.dedup import dedup_keep_last, duplicate_count
from tillflow.operators.quality import REASON_COL, add_audit_columns
from tillflow.plans import ingest, reports, staging
from tillflow.plans.catalog import ModelParams, Models
from tillflow.session import freed_shuffles, scratch_path
from tillflow.sinks.tables import delete_path
from tillflow.sources.fixtures import FIXTURE_ORDER, fixture_order_column, fixture_orders, joined_tables, order_lines

# Fixed run parameters of the fixture queries.
BATCH_ID = "fixture_batch"
INGESTED_AT = dt.datetime(2001, 9, 1, 0, 0, 0)
QUARANTINED_AT = dt.datetime(2001, 9, 1, 0, 0, 0)
AS_OF = dt.date(2001, 8, 31)
WATERMARK_TS = dt.datetime(1998, 6, 27, 16, 35, 0)
WATERMARK_INVOICE = "6000"
TOP_N = 10

PARAMS = ModelParams(as_of=AS_OF, spine_from_data=True)


def to_double(df: DataFrame) -> DataFrame:
    """Decimal columns -> double (exact sums first, one rounding at the end)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture source lines with ``_ord`` (file-order stand-in) and the
    order columns kept for identification."""
    return fixture_orders(spark, sf_dir).withColumn("_ord", fixture_order_column())


def cleaned(spark, sf_dir, options=IngestOptions()) -> DataFrame:
    return clean_ops.clean(source(spark, sf_dir), options)


@contextmanager
def written_source(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """``source`` for the jobs inside, from the joined tables written under the shared folder
    and removed after them. The shuffles of the joins are gone before those of the jobs
    begin, so the disk never holds both; the rows in columns take a fraction of either."""
    rows, path = joined_tables(spark, sf_dir), scratch_path(spark, "joined")
    try:
        with freed_shuffles(spark):
            rows.write.option("compression", "zstd").parquet(path)
        lines = order_lines(spark.read.schema(rows.schema).parquet(path))
        yield lines.withColumn("_ord", fixture_order_column())
    finally:
        delete_path(spark, path)


def flagged(spark, sf_dir, options=IngestOptions(), src: DataFrame | None = None) -> DataFrame:
    return ingest.transform(source(spark, sf_dir) if src is None else src, options)


def raw_orders(spark, sf_dir, src: DataFrame | None = None) -> DataFrame:
    return ingest.raw_orders(flagged(spark, sf_dir, src=src), BATCH_ID, INGESTED_AT)


def models(spark, sf_dir) -> Models:
    return Models(spark, raw_orders(spark, sf_dir), PARAMS)


def written_models(spark, sf_dir) -> Models:
    """Models for a query that several of them meet in: the raw lines are derived once and
    written under the shared folder, else each model would derive them for itself."""
    path = scratch_path(spark, "raw_orders")
    with written_source(spark, sf_dir) as src, freed_shuffles(spark):
        raw = raw_orders(spark, sf_dir, src)
        raw.write.parquet(path)
    return Models(spark, spark.read.schema(raw.schema).parquet(path), PARAMS)


_IDS = list(FIXTURE_ORDER)


# -- ingest operators ----------------------------------------------------------

def q_rename_and_strip(spark, sf_dir):
    return cleaned(spark, sf_dir).select(*_IDS, "invoice_no", "stock_code", "description", "country")


def q_numeric_coerce(spark, sf_dir):
    """C3 on text: quantities with blanks, a suffix, as words and with an exponent, prices
    with separators and as NaN; what is no number is NULL."""
    src = source(spark, sf_dir)
    line, whole = F.col("l_linenumber"), F.col("Quantity").cast("long").cast("string")
    price = F.col("Price").cast("decimal(18,2)").cast("string")
    src = src.withColumns({
        "Quantity": F.when(line == 1, F.concat(F.lit(" "), whole, F.lit("\t"))).when(line == 2, F.concat(whole, F.lit("d")))
        .when(line == 3, F.lit("seven")).when(line == 6, F.concat(whole, F.lit("E1"))).otherwise(whole),
        "Price": F.when(line == 4, F.concat(F.lit("1,"), price)).when(line == 5, F.lit("NaN"))
        .when(line == 7, F.concat(price, F.lit("00"))).otherwise(price)})
    return clean_ops.clean(src).select(*_IDS, "quantity", "unit_price")


def q_customer_id_nullify(spark, sf_dir):
    return cleaned(spark, sf_dir).select(*_IDS, "customer_id")


def q_date_coerce(spark, sf_dir):
    """C6 on text: month-first, date-only and ISO layouts; a day that does not exist and a
    date in the other order are NULL."""
    at, line = F.col("InvoiceDate"), F.col("l_linenumber")
    late = F.concat(F.date_format(F.date_add(F.trunc(at, "month"), 12), "d/M/yyyy"), F.lit(" 8:26"))
    text = (F.when(line == 2, F.date_format(at, "M/d/yyyy H:mm")).when(line == 3, F.date_format(at, "yyyy-'02-30' HH:mm:ss"))
            .when(line == 4, F.date_format(at, "yyyy-MM-dd")).when(line == 5, late)
            .when(line == 6, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS")).otherwise(F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSS")))
    return clean_ops.clean(source(spark, sf_dir).withColumn("InvoiceDate", text)).select(*_IDS, "invoice_date")


def q_string_nulls_nan(spark, sf_dir):
    """C2 in bug-compatible mode: missing text becomes 'nan'."""
    return cleaned(spark, sf_dir, IngestOptions(string_nulls="nan")).select(
        *_IDS, "invoice_no", "stock_code", "description", "country", "customer_id")


def q_na_tokens(spark, sf_dir):
    src = fixture_orders(spark, sf_dir)
    text = ["Invoice", "StockCode", "Description", "Customer ID", "Country"]
    return src.select(*_IDS, *[na_tokens_to_null(F.col(c)).alias(SOURCE_COLUMNS[c]) for c in text])


def q_conform_to_raw(spark, sf_dir):
    rows = ingest.clean_output(flagged(spark, sf_dir), BATCH_ID, INGESTED_AT)
    return to_double(rows.withColumnRenamed(LOADABLE_COL, "loadable"))


def q_dedup_keep_last(spark, sf_dir):
    d = dedup_keep_last(cleaned(spark, sf_dir))
    return d.select("invoice_no", "stock_code", "invoice_date", "description", "quantity",
                    "unit_price", "customer_id", "country", *_IDS)


def q_duplicate_count(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return duplicate_count(c, dedup_keep_last(c))


def _flagged_with_audit(spark, sf_dir):
    return add_audit_columns(flagged(spark, sf_dir), BATCH_ID, INGESTED_AT)


def q_quality_clean(spark, sf_dir):
    f = _flagged_with_audit(spark, sf_dir)
    return f.filter(F.col(REASON_COL) == "").select(
        "invoice_no", "stock_code", "invoice_date", "description", "quantity", "unit_price",
        "customer_id", "country", "batch_id", "ingested_at", *_IDS)


def q_quality_rejected(spark, sf_dir):
    q = ingest.quarantine(flagged(spark, sf_dir), BATCH_ID, INGESTED_AT, QUARANTINED_AT)
    return to_double(q)


def q_error_reasons(spark, sf_dir):
    f = flagged(spark, sf_dir)
    return (f.filter(F.col(REASON_COL) != "").groupBy(REASON_COL)
            .agg(F.count(F.lit(1)).alias("rejected_rows")))


def q_quarantine_breakdown(spark, sf_dir):
    f = flagged(spark, sf_dir)
    return reports.quarantine_breakdown(f.filter(F.col(REASON_COL) != ""))


def q_incremental_filter(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return incremental.filter_new_records(c, WATERMARK_TS, WATERMARK_INVOICE).select(
        *_IDS, "invoice_no", "invoice_date")


def q_incremental_keep_null_dates(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    return incremental.filter_new_records(c, WATERMARK_TS, WATERMARK_INVOICE,
                                          keep_null_dates=True).select(*_IDS, "invoice_no", "invoice_date")


def q_incremental_first_run(spark, sf_dir):
    c = incremental.filter_new_records(cleaned(spark, sf_dir), None, None)
    return c.agg(F.count(F.lit(1)).alias("records_read"),
                 F.count("invoice_date").alias("records_with_date"))


def q_next_watermark(spark, sf_dir):
    f = flagged(spark, sf_dir)
    return incremental.next_watermark(f.filter(F.col(REASON_COL) == ""))


# -- models --------------------------------------------------------------------

def q_raw_orders(spark, sf_dir):
    return to_double(raw_orders(spark, sf_dir))


def q_raw_orders_nan_mode(spark, sf_dir):
    """G1 bug-compatible mode end to end: missing invoice / stock / text is
    the string 'nan', so those null rules never reject and such lines load."""
    f = flagged(spark, sf_dir, IngestOptions(string_nulls="nan"))
    return to_double(ingest.raw_orders(f, BATCH_ID, INGESTED_AT))


def q_stg_orders(spark, sf_dir):
    return to_double(models(spark, sf_dir).stg_orders)


def q_stg_customers(spark, sf_dir):
    return to_double(models(spark, sf_dir).stg_customers)


def q_stg_customers_latest_country(spark, sf_dir):
    """stg_customers with ``country_rule="latest"``: the country of the
    customer's most recent line (by time, then invoice)."""
    return to_double(staging.stg_customers(raw_orders(spark, sf_dir), country_rule="latest"))


def q_stg_products(spark, sf_dir):
    return to_double(models(spark, sf_dir).stg_products)


def q_fct_orders(spark, sf_dir):
    return to_double(models(spark, sf_dir).fct_orders)


def q_dim_customers(spark, sf_dir):
    return to_double(models(spark, sf_dir).dim_customers)


def q_dim_products(spark, sf_dir):
    return to_double(models(spark, sf_dir).dim_products)


def q_dim_date(spark, sf_dir):
    """The calendar over the whole years the loaded order dates touch."""
    return models(spark, sf_dir).dim_date


# -- star joins and dashboard queries -------------------------------------------

def q_star_orders_customers(spark, sf_dir):
    m = models(spark, sf_dir)
    return to_double(reports.star_orders_customers(m.fct_orders, m.dim_customers))


def q_star_orders_products(spark, sf_dir):
    m = written_models(spark, sf_dir)
    return to_double(reports.star_orders_products(m.fct_orders, m.dim_products))


def q_star_orders_dates(spark, sf_dir):
    m = models(spark, sf_dir)
    return to_double(reports.star_orders_dates(m.fct_orders, m.dim_date))


def q_kpi_headline(spark, sf_dir):
    m = written_models(spark, sf_dir)
    return to_double(reports.kpi_headline(m.fct_orders, m.dim_customers, m.dim_products))


def q_revenue_by_month(spark, sf_dir):
    m = models(spark, sf_dir)
    return to_double(reports.revenue_by_month(m.fct_orders, m.dim_date))


def q_peak_month(spark, sf_dir):
    m = models(spark, sf_dir)
    return to_double(reports.peak_month(reports.revenue_by_month(m.fct_orders, m.dim_date)))


def q_segment_distribution(spark, sf_dir):
    return reports.segment_distribution(models(spark, sf_dir).dim_customers)


def q_revenue_by_country(spark, sf_dir):
    return to_double(reports.revenue_by_country(models(spark, sf_dir).fct_orders))


def q_top_products(spark, sf_dir):
    return to_double(reports.top_products(models(spark, sf_dir).dim_products, TOP_N))


def q_revenue_by_segment(spark, sf_dir):
    m = models(spark, sf_dir)
    return to_double(reports.revenue_by_segment(m.fct_orders, m.dim_customers))


# -- data tests ------------------------------------------------------------------

def q_test_not_null(spark, sf_dir):
    """not_null failing rows of stg_orders: lines without a country or with
    any other declared column NULL."""
    m = models(spark, sf_dir)
    spec = datatests.DECLARED_TESTS[0]
    return datatests.not_null_results(m.stg_orders, spec.model, spec.not_null)


def q_test_unique(spark, sf_dir):
    """unique failing rows of fct_orders.order_key (repeated keys)."""
    return to_double(datatests.unique_failures(models(spark, sf_dir).fct_orders, "order_key"))


def q_test_suite(spark, sf_dir):
    return datatests.test_suite(written_models(spark, sf_dir).as_dict())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rename_and_strip": q_rename_and_strip,
    "numeric_coerce": q_numeric_coerce,
    "customer_id_nullify": q_customer_id_nullify,
    "date_coerce": q_date_coerce,
    "string_nulls_nan": q_string_nulls_nan,
    "na_tokens": q_na_tokens,
    "conform_to_raw": q_conform_to_raw,
    "dedup_keep_last": q_dedup_keep_last,
    "duplicate_count": q_duplicate_count,
    "quality_clean": q_quality_clean,
    "quality_rejected": q_quality_rejected,
    "error_reasons": q_error_reasons,
    "quarantine_breakdown": q_quarantine_breakdown,
    "incremental_filter": q_incremental_filter,
    "incremental_keep_null_dates": q_incremental_keep_null_dates,
    "incremental_first_run": q_incremental_first_run,
    "next_watermark": q_next_watermark,
    "raw_orders": q_raw_orders,
    "raw_orders_nan_mode": q_raw_orders_nan_mode,
    "stg_orders": q_stg_orders,
    "stg_customers": q_stg_customers,
    "stg_customers_latest_country": q_stg_customers_latest_country,
    "stg_products": q_stg_products,
    "fct_orders": q_fct_orders,
    "dim_customers": q_dim_customers,
    "dim_products": q_dim_products,
    "dim_date": q_dim_date,
    "star_orders_customers": q_star_orders_customers,
    "star_orders_products": q_star_orders_products,
    "star_orders_dates": q_star_orders_dates,
    "kpi_headline": q_kpi_headline,
    "revenue_by_month": q_revenue_by_month,
    "peak_month": q_peak_month,
    "segment_distribution": q_segment_distribution,
    "revenue_by_country": q_revenue_by_country,
    "top_products": q_top_products,
    "revenue_by_segment": q_revenue_by_segment,
    "test_not_null": q_test_not_null,
    "test_unique": q_test_unique,
    "test_suite": q_test_suite,
}
