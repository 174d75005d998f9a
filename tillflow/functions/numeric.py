"""Numeric coercion expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

# Text a lenient numeric parser accepts: optional sign, digits with an optional
# fraction, optional exponent, or inf / nan spellings. Anything else ('12d',
# '1,000', '0x1A') is not a number. Surrounding whitespace is allowed.
_NUMBER_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf|infinity|nan)\s*$"


def coerce_numeric(c: str | Column, source_type: DataType | None = None) -> Column:
    """``to_numeric(errors='coerce')``: a double, or NULL when the value is not
    a number. NaN also becomes NULL (it is a missing value downstream).

    Spark's own string-to-double cast accepts suffixes such as ``'12d'``, so
    text is guarded by a pattern before ``try_cast``."""
    col = F.col(c) if isinstance(c, str) else c
    if source_type is not None and isinstance(source_type, NumericType):
        num = col.cast("double")
    else:
        text = col.cast("string")
        guarded = F.when(F.lower(text).rlike(_NUMBER_TEXT), F.trim(text))
        num = guarded.try_cast("double")
    return F.when(F.isnan(num), F.lit(None).cast("double")).otherwise(num)


def fits_decimal(c: str | Column, precision: int, scale: int) -> Column:
    """True when a non-null value can be stored as ``decimal(p, s)``;
    NULL input counts as fitting."""
    col = F.col(c) if isinstance(c, str) else c
    return col.isNull() | col.try_cast(f"decimal({precision},{scale})").isNotNull()


def to_decimal(c: str | Column, precision: int, scale: int) -> Column:
    """``decimal(p, s)`` or NULL when the value does not fit."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast(f"decimal({precision},{scale})")
