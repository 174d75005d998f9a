"""Column expressions shared by the operators. All are built-in Spark
functions, so they stay inside whole-stage codegen; no Python UDFs."""

from tillflow.functions.text import (
    blank_to_null,
    load_null_tokens,
    na_tokens_to_null,
    py_strip,
    str_or_nan,
)
from tillflow.functions.numeric import coerce_numeric, fits_decimal, to_decimal
from tillflow.functions.dates import coerce_timestamp, date_key, truncate_to_second
from tillflow.functions.orders import is_cancelled, is_sale, order_key

__all__ = [
    "blank_to_null",
    "coerce_numeric",
    "coerce_timestamp",
    "date_key",
    "fits_decimal",
    "is_cancelled",
    "is_sale",
    "load_null_tokens",
    "na_tokens_to_null",
    "order_key",
    "py_strip",
    "str_or_nan",
    "to_decimal",
    "truncate_to_second",
]
