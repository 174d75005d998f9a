"""High-water-mark incremental filter and the next mark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def new_records_predicate(last_processed_at: dt.datetime, last_invoice_no: str | None,
                          ts_col: str = "invoice_date", inv_col: str = "invoice_no",
                          keep_null_dates: bool = False) -> Column:
    """``ts > mark OR (ts = mark AND invoice > mark_invoice)``; invoices
    compare as text ('9' > '10'); a NULL date never passes unless
    ``keep_null_dates``; a NULL stored invoice admits no boundary rows."""
    ts, inv = F.col(ts_col), F.col(inv_col)
    mark = F.lit(last_processed_at).cast("timestamp_ntz")
    at_boundary = (ts == mark) & (inv.cast("string") > F.lit(last_invoice_no).cast("string"))
    # Plain comparisons (a NULL result drops the row in a filter), so the
    # predicate reaches the Parquet scan and row groups older than the mark
    # are skipped by their min/max statistics.
    cond = (ts > mark) | at_boundary
    if keep_null_dates:
        cond = cond | ts.isNull()
    return cond


def filter_new_records(df: DataFrame, last_processed_at: dt.datetime | None,
                       last_invoice_no: str | None, keep_null_dates: bool = False,
                       ts_col: str = "invoice_date", inv_col: str = "invoice_no") -> DataFrame:
    """W1 (no mark: everything) or W2."""
    if last_processed_at is None:
        return df
    return df.filter(new_records_predicate(last_processed_at, last_invoice_no, ts_col, inv_col,
                                           keep_null_dates))


def watermark_expr(ts_col: str = "invoice_date", inv_col: str = "invoice_no") -> Column:
    """W4 in one pass: the greatest timestamp and, among rows at that
    timestamp, the greatest invoice (struct order is lexicographic)."""
    return F.max(F.struct(F.col(ts_col).alias("last_processed_at"),
                          F.col(inv_col).cast("string").alias("last_invoice_no")))


def next_watermark(clean: DataFrame, ts_col: str = "invoice_date", inv_col: str = "invoice_no") -> DataFrame:
    """One row (last_processed_at, last_invoice_no); NULLs when there are no
    clean rows (W6: the caller then leaves the stored mark alone)."""
    return clean.agg(watermark_expr(ts_col, inv_col).alias("_wm")).select("_wm.*")
