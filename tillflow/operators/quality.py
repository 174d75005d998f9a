"""Quality rules, reason text and the clean / rejected split (Q1-Q6, A1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.config import NEGATIVE_PRICE_REASON, NOT_NULL_RULES, NULL_REASON_SUFFIX

REASON_COL = "error_reason"


def error_reason() -> Column:
    """All failed rules of a row, in rule order, each ending ``'; '``.
    Empty string when the row passes. A NULL price is never negative."""
    parts = [F.when(F.col(c).isNull(), F.lit(c + NULL_REASON_SUFFIX)).otherwise(F.lit(""))
             for c in NOT_NULL_RULES]
    parts.append(F.when(F.coalesce(F.col("unit_price") < 0, F.lit(False)),
                        F.lit(NEGATIVE_PRICE_REASON)).otherwise(F.lit("")))
    return F.concat(*parts)


def flag_quality(df: DataFrame) -> DataFrame:
    return df.withColumn(REASON_COL, error_reason())


def clean_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col(REASON_COL) == "").drop(REASON_COL)


def rejected_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col(REASON_COL) != "")


def validate_quality(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected); the rule expression is evaluated once per branch
    from the same plan, so callers persist or write the flagged frame once."""
    flagged = flag_quality(df)
    return clean_rows(flagged), rejected_rows(flagged)


def add_audit_columns(df: DataFrame, batch_id: str, ingested_at: dt.datetime) -> DataFrame:
    """batch_id and ingested_at (UTC, naive) as constants of the batch."""
    return df.withColumns({
        "batch_id": F.lit(batch_id),
        "ingested_at": F.lit(ingested_at).cast("timestamp_ntz"),
    })
