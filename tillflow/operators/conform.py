"""Conform rows to the raw table's declared types (K3, K4).

The warehouse load turned '' / 'NULL' / 'null' into NULL, cut timestamps to
whole seconds, stored quantity and price as decimal(10,2), and skipped (but
did not fail on) rows whose values did not fit the declared widths. Here the
same happens as expressions: a ``_loadable`` flag marks rows that fit, and
the skipped rows are counted by the caller.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.config import RAW_DECIMAL, RAW_TEXT_WIDTHS
from tillflow.functions import fits_decimal, load_null_tokens, to_decimal, truncate_to_second

LOADABLE_COL = "_loadable"

RAW_COLUMNS = ("invoice_no", "stock_code", "description", "quantity", "invoice_date",
               "unit_price", "customer_id", "country", "batch_id", "ingested_at")


def _fits(columns) -> dict[str, Column]:
    """Whether each value, after the load-time null tokens, fits its declared type."""
    p, s = RAW_DECIMAL
    out = {c: F.coalesce(F.length(load_null_tokens(F.col(c).cast("string"))) <= width, F.lit(True))
           for c, width in RAW_TEXT_WIDTHS.items() if c in columns}
    return out | {c: fits_decimal(F.col(c), p, s) for c in ("quantity", "unit_price")}


def unfit_columns(columns) -> dict[str, Column]:
    """Whether the incoming value of each column does not fit, in table order."""
    fits = _fits(columns)
    return {c: ~fits[c] for c in RAW_COLUMNS if c in fits}


def conform_raw(df: DataFrame) -> DataFrame:
    """Typed raw-table columns plus ``_loadable``."""
    p, s = RAW_DECIMAL
    exprs = {c: load_null_tokens(F.col(c).cast("string")) for c in RAW_TEXT_WIDTHS if c in df.columns}
    for c in ("invoice_date", "ingested_at"):
        if c in df.columns:
            exprs[c] = truncate_to_second(c)
    for c in ("quantity", "unit_price"):
        exprs[c] = to_decimal(c, p, s)
    loadable = reduce(Column.__and__, _fits(df.columns).values())
    # The flag reads the incoming values, so it is added before they are replaced.
    return df.withColumn(LOADABLE_COL, loadable).withColumns(exprs)
