"""Rename and type the source columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.config import SOURCE_COLUMNS, STRIPPED_TEXT_COLUMNS, IngestOptions
from tillflow.functions import coerce_numeric, coerce_timestamp, py_strip, str_or_nan


class ValidationError(Exception):
    """Typing the source frame failed (a plan-time error, not bad data)."""


def rename_columns(df: DataFrame) -> DataFrame:
    """Source header names -> snake_case; columns not in the mapping are kept."""
    return df.withColumnsRenamed({k: v for k, v in SOURCE_COLUMNS.items() if k in df.columns})


def cast_data_types(df: DataFrame, options: IngestOptions = IngestOptions()) -> DataFrame:
    """Strip text, coerce numbers and dates; bad values become NULL.

    * text columns: string cast + Python-style strip. With
      ``string_nulls="nan"`` a missing value is the text ``'nan'``.
    * quantity, unit_price: lenient numeric parse, NaN -> NULL.
    * customer_id: stripped text, the literal ``'nan'`` -> NULL.
    * invoice_date: timestamp_ntz, unparseable -> NULL.
    Data errors never raise (``try_*`` casts under ANSI mode); only a frame
    without the expected columns does."""
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in ("quantity", "unit_price", "invoice_date") if c not in types]
    if missing:
        raise ValidationError(f"The source frame has no {', '.join(missing)} to type")
    exprs = {}
    for c in STRIPPED_TEXT_COLUMNS:
        if c in types:
            base = str_or_nan(c) if options.string_nulls == "nan" else F.col(c).cast("string")
            exprs[c] = py_strip(base)
    exprs["quantity"] = coerce_numeric("quantity", types["quantity"])
    exprs["unit_price"] = coerce_numeric("unit_price", types["unit_price"])
    if "customer_id" in types:
        cid = py_strip(str_or_nan("customer_id"))
        if options.normalize_ids:
            cid = F.regexp_replace(cid, r"^(-?\d+)\.0+$", "$1")
        exprs["customer_id"] = F.nullif(cid, F.lit("nan"))
    exprs["invoice_date"] = coerce_timestamp("invoice_date", types["invoice_date"], options.date_first)
    return df.withColumns(exprs)


def clean(df: DataFrame, options: IngestOptions = IngestOptions()) -> DataFrame:
    """C1 then C2-C6."""
    return cast_data_types(rename_columns(df), options)
