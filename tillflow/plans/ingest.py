"""Ingest transform chain (A2): clean -> incremental filter -> keep-last
dedup -> quality flag, and the outputs cut from it.

One lazy plan: scan, project, filter, one shuffle (the dedup). ``batch_lines``
turns the flagged frame into the rows of one batch of ``order_lines``
(loaded and quarantined together), so the pipeline writes a batch in a
single job.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.config import DEDUP_KEYS, ERROR_REASON_WIDTH, IngestOptions
from tillflow.operators.clean import ValidationError, clean
from tillflow.operators.conform import LOADABLE_COL, RAW_COLUMNS, conform_raw, unfit_columns
from tillflow.operators.dedup import dedup_keep_last
from tillflow.operators.incremental import filter_new_records
from tillflow.operators.quality import REASON_COL, add_audit_columns, flag_quality
from tillflow.sinks.tables import LINES_SCHEMA, LOADED, QUARANTINED, STATUS_COL
from tillflow.sources.csv_source import RECORD_COL

#: Reasons of quarantined rows that failed no quality rule.
OVERLONG_REASON = "record has more fields than the header; "
UNFIT_REASON = " does not fit the raw table; "
#: Rows of ``batch_lines`` whose values do not fit, whatever became of them.
UNFIT_COL = "_unfit"


def prepare(source: DataFrame, options: IngestOptions = IngestOptions(),
            last_processed_at: dt.datetime | None = None, last_invoice_no: str | None = None) -> DataFrame:
    """Typed rows of ``source`` past the stored mark (before dedup): the rows
    a run reads."""
    if "_ord" not in source.columns:
        raise ValidationError("The source needs an orderable '_ord' column (its file order) for the "
                              "keep-last dedup; read it with sources.csv_source or sources.parquet_source, "
                              "or add one")
    cleaned = clean(source, options)
    return filter_new_records(cleaned, last_processed_at, last_invoice_no,
                              keep_null_dates=options.keep_null_dates)


def dedup_and_flag(prepared: DataFrame, order_col: str = "_ord") -> DataFrame:
    """Keep-last rows with their failed rules. Overlong records, where the source carries
    them, are told apart by their whole text: their fields may stand in wrong columns, so
    they never replace a line and fail for that one reason."""
    if RECORD_COL not in prepared.columns:
        return flag_quality(dedup_keep_last(prepared, order_col=order_col))
    flagged = flag_quality(dedup_keep_last(prepared, order_col=order_col, keys=(*DEDUP_KEYS, RECORD_COL)))
    overlong = F.col(RECORD_COL).isNotNull()
    return flagged.withColumn(REASON_COL, F.when(overlong, F.lit(OVERLONG_REASON)).otherwise(F.col(REASON_COL)))


def transform(source: DataFrame, options: IngestOptions = IngestOptions(),
              last_processed_at: dt.datetime | None = None, last_invoice_no: str | None = None,
              order_col: str = "_ord") -> DataFrame:
    """Flagged, deduplicated rows of the new part of ``source``.

    ``source`` has the source-file columns plus an orderable ``order_col``.
    The result carries ``error_reason`` ('' when clean)."""
    return dedup_and_flag(prepare(source, options, last_processed_at, last_invoice_no), order_col)


def clean_output(flagged: DataFrame, batch_id: str, ingested_at: dt.datetime) -> DataFrame:
    """Clean rows with audit columns, conformed to the raw table, with the
    ``_loadable`` flag (rows that do not fit are skipped by the load)."""
    rows = flagged.filter(F.col(REASON_COL) == "").drop(REASON_COL)
    return conform_raw(add_audit_columns(rows, batch_id, ingested_at))


def raw_orders(flagged: DataFrame, batch_id: str, ingested_at: dt.datetime) -> DataFrame:
    return clean_output(flagged, batch_id, ingested_at).filter(F.col(LOADABLE_COL)).select(*RAW_COLUMNS)


def quarantine(flagged: DataFrame, batch_id: str, ingested_at: dt.datetime,
               quarantined_at: dt.datetime) -> DataFrame:
    """Rejected rows, written by name: the raw columns (values that do not
    fit the declared types become NULL, the row is kept), the batch audit
    columns, the reason and the quarantine time."""
    rows = flagged.filter(F.col(REASON_COL) != "")
    c = conform_raw(add_audit_columns(rows, batch_id, ingested_at))
    return c.select(*RAW_COLUMNS,
                    F.substring(REASON_COL, 1, ERROR_REASON_WIDTH).alias(REASON_COL),
                    F.lit(quarantined_at).cast("timestamp_ntz").alias("quarantined_at"))


def batch_lines(flagged: DataFrame, batch_id: str, ingested_at: dt.datetime,
                quarantined_at: dt.datetime, on_unfit: str = "skip") -> DataFrame:
    """Rows of one batch of ``order_lines``: clean rows that fit the raw
    table's types (``loaded``) and every rejected row (``quarantined``,
    values that do not fit become NULL), with ``_loadable`` kept for the
    caller's skipped-row count and ``_unfit`` for clean rows that do not fit. With
    ``on_unfit="quarantine"`` those are rejected rows too: the reason names the columns
    and ``raw_record`` holds the values as they came, as JSON.
    Columns: LINES_SCHEMA without batch_id, and the two flags."""
    record = F.col(RECORD_COL) if RECORD_COL in flagged.columns else F.lit(None).cast("string")
    failed = F.col(REASON_COL) != ""
    c = add_audit_columns(flagged, batch_id, ingested_at)
    reason, kept = F.col(REASON_COL), {"_record": record}
    if on_unfit == "quarantine":
        # only here does a row tell what it was; the other case needs no more than the flag
        names = F.concat(*[F.when(u, F.lit(n + UNFIT_REASON)).otherwise(F.lit("")) for n, u in unfit_columns(c.columns).items()])
        values = F.to_json(F.struct(*[F.col(x) for x in RAW_COLUMNS if x in flagged.columns]))
        kept["_names"] = F.when(~failed, names).otherwise(F.lit(""))
        c = c.withColumns(kept)
        kept = {"_values": F.when(F.col("_names") != "", values)}
        reason = F.concat("_names", REASON_COL)      # one of them is empty
    c = conform_raw(c.withColumns(kept))
    rejected = reason != ""
    if on_unfit == "quarantine":
        record = F.coalesce("_record", "_values")
    else:
        record = F.col("_record")
    return c.select(
        *[F.col(f.name) for f in LINES_SCHEMA.fields
          if f.name not in ("batch_id", REASON_COL, "quarantined_at", "raw_record", STATUS_COL)],
        F.when(rejected, F.substring(reason, 1, ERROR_REASON_WIDTH)).alias(REASON_COL),
        F.when(rejected, F.lit(quarantined_at).cast("timestamp_ntz")).alias("quarantined_at"),
        record.alias("raw_record"),
        F.when(rejected, F.lit(QUARANTINED)).otherwise(F.lit(LOADED)).alias(STATUS_COL),
        F.col(LOADABLE_COL), (~failed & ~F.col(LOADABLE_COL)).alias(UNFIT_COL),
    )
