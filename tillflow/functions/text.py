"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow.config import LOAD_NULL_TOKENS, PY_WHITESPACE, READ_NA_TOKENS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: str | Column) -> Column:
    """Remove leading and trailing whitespace the way Python's ``str.strip()``
    does. SQL ``TRIM`` only removes spaces, so pass the full character set. That
    costs many times the plain one; a text that starts and ends with no other white
    space once its spaces are gone does without."""
    plain = F.trim(_col(c).cast("string"))
    more = F.left(plain, F.lit(1)).isin(*PY_WHITESPACE) | F.right(plain, F.lit(1)).isin(*PY_WHITESPACE)
    return F.when(more, F.trim(plain, F.lit(PY_WHITESPACE))).otherwise(plain)


def str_or_nan(c: str | Column) -> Column:
    """String cast in which a missing value becomes the text ``'nan'``
    (what a pandas ``astype(str)`` does to a missing value)."""
    return F.coalesce(_col(c).cast("string"), F.lit("nan"))


def blank_to_null(c: str | Column) -> Column:
    """``NULLIF(TRIM(c), '')`` with SQL (space-only) trim."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def na_tokens_to_null(c: str | Column, tokens=READ_NA_TOKENS) -> Column:
    """Map the reader's missing-value tokens to NULL. Spark's CSV ``nullValue``
    takes a single token, so the list is applied as an expression."""
    col = _col(c)
    return F.when(col.isin(*tokens), F.lit(None).cast("string")).otherwise(col)


def load_null_tokens(c: str | Column) -> Column:
    """Strings the raw-table loader treats as NULL (``''``, ``'NULL'``, ``'null'``)."""
    return na_tokens_to_null(c, LOAD_NULL_TOKENS)
