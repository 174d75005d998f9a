"""Order-line predicates and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow.config import CANCELLED_PREFIX, ORDER_KEY_TS_FORMAT


def is_cancelled(invoice_no: str | Column = "invoice_no") -> Column:
    """Invoice starts with ``C`` (case-sensitive); a NULL invoice is not."""
    inv = F.col(invoice_no) if isinstance(invoice_no, str) else invoice_no
    return F.coalesce(F.left(inv, F.lit(1)) == F.lit(CANCELLED_PREFIX), F.lit(False))


def is_sale(invoice_no: str | Column = "invoice_no", quantity: str | Column = "quantity") -> Column:
    """A sale line: not a cancellation invoice and a positive quantity.
    Evaluated with SQL three-valued logic (NULL behaves as false in ``when``)."""
    inv = F.col(invoice_no) if isinstance(invoice_no, str) else invoice_no
    qty = F.col(quantity) if isinstance(quantity, str) else quantity
    return (F.left(inv, F.lit(1)) != F.lit(CANCELLED_PREFIX)) & (qty > 0)


def order_key(invoice_no="invoice_no", stock_code="stock_code", invoice_date="invoice_date") -> Column:
    """MD5 of ``invoice-stock-'yyyy-MM-dd HH:mm:ss'``; NULL if any part is NULL
    (``concat`` propagates NULL, ``concat_ws`` would not)."""
    parts = [F.col(x) if isinstance(x, str) else x for x in (invoice_no, stock_code, invoice_date)]
    return F.md5(
        F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), F.date_format(parts[2], ORDER_KEY_TS_FORMAT))
    )
