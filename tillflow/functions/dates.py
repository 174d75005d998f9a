"""Timestamp and calendar-key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

from tillflow.config import DATE_KEY_FORMAT

# Layouts of text timestamps: ISO ones, and those of the one order of day and
# month that a source uses.
ISO_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd")
ORDERED_FORMATS = {"month": ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss"), "day": ("d/M/yyyy H:mm", "d/M/yyyy H:mm:ss")}


def coerce_timestamp(c: str | Column, source_type: DataType | None = None, first: str = "month") -> Column:
    """``to_datetime(errors='coerce')`` into ``timestamp_ntz``; text that no
    layout parses becomes NULL instead of failing the job. ``first`` says whether
    the source writes the month or the day first; a date that only the other
    order could mean is NULL, never guessed."""
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(source_type, (TimestampNTZType,)):
        return col
    if isinstance(source_type, (TimestampType, DateType)):
        return col.cast("timestamp_ntz")
    text = F.trim(col.cast("string"))
    # ISO text (fractions, 'T' separator, date only) first, then the layouts.
    parsed = [text.try_cast("timestamp_ntz")]
    parsed += [F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz") for fmt in (*ISO_FORMATS, *ORDERED_FORMATS[first])]
    return F.coalesce(*parsed)


def truncate_to_second(c: str | Column) -> Column:
    """Whole-second precision, keeping the ``timestamp_ntz`` type."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_trunc("second", col).cast("timestamp_ntz")


def date_key(c: str | Column) -> Column:
    """Integer ``YYYYMMDD`` key of the calendar day of a timestamp or date."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(F.to_date(col), DATE_KEY_FORMAT).cast("int")
