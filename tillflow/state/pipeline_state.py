"""Pipeline watermark (S10, K8, W5) and run audit."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.config import (
    AUDIT_MESSAGE_WIDTH,
    STATUS_FAILED,
    STATUS_IN_PROGRESS,
    STATUS_SUCCESS,
)
from tillflow.state.versioned import StateTable

log = logging.getLogger("tillflow.state")

WATERMARK_SCHEMA = T.StructType([
    T.StructField("pipeline_name", T.StringType()),
    T.StructField("source_table", T.StringType()),
    T.StructField("last_processed_at", T.TimestampNTZType()),
    T.StructField("last_invoice_no", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])
WATERMARK_KEYS = ("pipeline_name", "source_table")
WATERMARK_UPDATES = ("last_processed_at", "last_invoice_no", "updated_at")

AUDIT_SCHEMA = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("pipeline_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("records_read", T.LongType()),
    T.StructField("records_loaded", T.LongType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("completed_at", T.TimestampNTZType()),
    T.StructField("duration_seconds", T.DoubleType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])
AUDIT_KEYS = ("batch_id",)
# started_at and pipeline_name keep their first values when a run is updated.
AUDIT_UPDATES = ("status", "records_read", "records_loaded", "completed_at", "duration_seconds",
                 "error_message", "updated_at")


class WatermarkError(Exception):
    pass


def utcnow() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class WatermarkStore:
    def __init__(self, spark: SparkSession, path: str, truncate_to_seconds: bool = False):
        self.spark = spark
        self.table = StateTable(spark, path, WATERMARK_SCHEMA, WATERMARK_KEYS, WATERMARK_UPDATES)
        self.truncate = truncate_to_seconds

    def ensure(self) -> None:
        try:
            self.table.ensure()
        except Exception as e:  # noqa: BLE001
            raise WatermarkError(f"The mark table cannot be set up: {e}") from e

    def read(self, pipeline_name: str, source_table: str) -> tuple[dt.datetime | None, str | None]:
        """(last_processed_at, last_invoice_no), or (None, None) on a first run."""
        try:
            rows = (self.table.read()
                    .filter((F.col("pipeline_name") == pipeline_name) & (F.col("source_table") == source_table))
                    .select("last_processed_at", "last_invoice_no").take(1))
        except Exception as e:  # noqa: BLE001
            raise WatermarkError(f"The stored mark cannot be read: {e}") from e
        if not rows:
            return None, None
        return rows[0]["last_processed_at"], rows[0]["last_invoice_no"]

    def write(self, pipeline_name: str, source_table: str, last_processed_at: dt.datetime,
              last_invoice_no: str | None, updated_at: dt.datetime | None = None) -> None:
        if self.truncate and last_processed_at is not None:
            last_processed_at = last_processed_at.replace(microsecond=0)
        row = [(pipeline_name, source_table, last_processed_at, last_invoice_no, updated_at or utcnow())]
        try:
            self.table.upsert(row)
        except Exception as e:  # noqa: BLE001
            raise WatermarkError(f"The new mark could not be stored: {e}") from e

    def frame(self) -> DataFrame:
        return self.table.read()


class AuditLog:
    """Run history. Writes never fail the run (they are logged), creating
    the table does (U4)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = StateTable(spark, path, AUDIT_SCHEMA, AUDIT_KEYS, AUDIT_UPDATES)

    def ensure(self) -> None:
        self.table.ensure()

    def _upsert(self, **row) -> bool:
        vals = [tuple(row.get(f.name) for f in AUDIT_SCHEMA.fields)]
        try:
            self.table.upsert(vals)
            return True
        except Exception as e:  # noqa: BLE001
            log.warning("Failed to write audit row %s: %s", row.get("batch_id"), e)
            return False

    def start(self, batch_id: str, pipeline_name: str, started_at: dt.datetime) -> bool:
        return self._upsert(batch_id=batch_id, pipeline_name=pipeline_name, status=STATUS_IN_PROGRESS,
                            records_read=0, records_loaded=0, started_at=started_at,
                            updated_at=utcnow())

    def complete(self, batch_id: str, pipeline_name: str, started_at: dt.datetime, records_read: int,
                 records_loaded: int, completed_at: dt.datetime | None = None) -> bool:
        completed_at = completed_at or utcnow()
        return self._upsert(batch_id=batch_id, pipeline_name=pipeline_name, status=STATUS_SUCCESS,
                            records_read=int(records_read), records_loaded=int(records_loaded),
                            started_at=started_at, completed_at=completed_at,
                            duration_seconds=(completed_at - started_at).total_seconds(),
                            updated_at=utcnow())

    def fail(self, batch_id: str, pipeline_name: str, started_at: dt.datetime, error_message: str,
             completed_at: dt.datetime | None = None) -> bool:
        completed_at = completed_at or utcnow()
        return self._upsert(batch_id=batch_id, pipeline_name=pipeline_name, status=STATUS_FAILED,
                            records_read=0, records_loaded=0, started_at=started_at,
                            completed_at=completed_at,
                            duration_seconds=(completed_at - started_at).total_seconds(),
                            error_message=error_message[:AUDIT_MESSAGE_WIDTH], updated_at=utcnow())

    def frame(self) -> DataFrame:
        return self.table.read()


def run_history(audit: DataFrame) -> DataFrame:
    """Runs, rows and mean duration per status."""
    return audit.groupBy("status").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("records_read").alias("records_read"),
        F.sum("records_loaded").alias("records_loaded"),
        F.avg("duration_seconds").alias("avg_duration_seconds"),
    )
