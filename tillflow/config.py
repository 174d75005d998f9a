"""Fixed values of the order-line data model.

Everything in the FIXED VALUES block must equal what the source pipeline uses,
otherwise results differ: column names of the source file, the quality rules
and their order, the reason texts, the excluded service codes, the segment and
tier thresholds, the declared column widths and the load-time null tokens.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the source pipeline exactly)
# ---------------------------------------------------------------------------

# Source file header -> snake_case name, in file order.
SOURCE_COLUMNS: dict[str, str] = {
    "Invoice": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
}

# Text columns that are cast to string and stripped at ingest.
STRIPPED_TEXT_COLUMNS = ("invoice_no", "stock_code", "description", "country")

# Not-null rules, in the order their reasons are appended.
NOT_NULL_RULES = ("invoice_no", "stock_code", "invoice_date", "quantity", "unit_price")
# Range rule appended after the null rules.
NEGATIVE_PRICE_REASON = "unit_price is negative; "
NULL_REASON_SUFFIX = " is null; "
# Declared but never enforced by the source pipeline.
UNENFORCED_MIN_QUANTITY = -9999

# Dedup key of one order line; the last line in file order wins.
DEDUP_KEYS = ("invoice_no", "stock_code", "invoice_date")

# Load-time strings that become NULL in the raw table.
LOAD_NULL_TOKENS = ("NULL", "null", "")

# Declared widths of the raw table's text columns.
RAW_TEXT_WIDTHS: dict[str, int] = {
    "invoice_no": 20,
    "stock_code": 20,
    "description": 500,
    "customer_id": 20,
    "country": 100,
    "batch_id": 100,
}
# Declared numeric type of quantity and unit_price in the raw table.
RAW_DECIMAL = (10, 2)
ERROR_REASON_WIDTH = 2000
AUDIT_MESSAGE_WIDTH = 2000

# Missing-value tokens recognised when reading the source file (the default
# NA list of the pandas CSV reader).
READ_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Characters removed by Python's str.strip() with no argument
# (every code point for which str.isspace() is true).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Invoice prefix that marks a cancellation.
CANCELLED_PREFIX = "C"

# Service stock codes left out of the product dimension (compared untrimmed,
# case-sensitively).
EXCLUDED_STOCK_CODES = ("POST", "D", "M", "BANK CHARGES", "PADS")

# Customer segments, checked in order: (name, min revenue, min orders).
SEGMENT_VIP = ("VIP", 10000, 50)
SEGMENT_LOYAL = ("LOYAL", 20)
SEGMENT_REGULAR = ("REGULAR", 5)
SEGMENT_DEFAULT = "NEW"

# Customer status by days since the last order.
STATUS_ACTIVE = ("ACTIVE", 30)
STATUS_WARM = ("WARM", 90)
STATUS_DEFAULT = "CHURN_RISK"

# Product tiers by units sold, checked in order.
TIER_BESTSELLER = ("BESTSELLER", 10000)
TIER_POPULAR = ("POPULAR", 1000)
TIER_REGULAR = ("REGULAR", 100)
TIER_DEFAULT = "SLOW_MOVER"

# Calendar spine of the date dimension.
DATE_SPINE_START = _dt.date(2009, 1, 1)
DATE_SPINE_DAYS = 1461

# Format of the order-key text and of the date key.
ORDER_KEY_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_KEY_FORMAT = "yyyyMMdd"
YEAR_MONTH_FORMAT = "yyyy-MM"

# Audit statuses and the prefix of errors that are not pipeline errors.
STATUS_IN_PROGRESS = "in_progress"
STATUS_SUCCESS = "success"
STATUS_FAILED = "failed"
UNEXPECTED_PREFIX = "Unexpected: "

PIPELINE_NAME = "retail_orders_pipeline"
RAW_TABLE = "raw_orders"

# ---------------------------------------------------------------------------
# Tunables (ours, not the source pipeline's)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class IngestOptions:
    """Switches for behaviours where the source pipeline is ambiguous.

    string_nulls: "null" keeps missing text as NULL (the documented outcome);
        "nan" renders it as the text 'nan' like a string cast in pandas does.
    normalize_ids: strip a trailing ".0" from customer ids written as floats.
    keep_null_dates: also pass rows without a date through the incremental
        filter on later runs, so they are quarantined instead of skipped.
    date_first: "month" or "day", the order in slash dates of the source.
    """

    string_nulls: str = "null"
    normalize_ids: bool = False
    keep_null_dates: bool = False
    date_first: str = "month"

    def __post_init__(self):
        if self.date_first not in ("month", "day"):
            raise ValueError(f"date_first must be 'month' or 'day', not {self.date_first!r}")
        if self.string_nulls not in ("null", "nan"):
            raise ValueError(f"string_nulls must be 'null' or 'nan', not {self.string_nulls!r}")
