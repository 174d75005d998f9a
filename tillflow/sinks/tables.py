"""Table sinks.

Loaded and quarantined order lines are one physical Parquet dataset,
``order_lines``, partitioned ``batch_id=<id>/load_status=<loaded|quarantined>``.
``raw_orders`` and ``raw_orders_quarantine`` are the two partition-pruned
views of it. One batch is therefore one write job: the flagged rows of the
batch are computed once (one scan, one shuffle) and written once, with no
intermediate table and no second pass for the rejected rows.

A batch is written into a hidden ``_incoming_*`` folder under the dataset
(Spark readers skip names starting with ``_``), checked, and then published as
``batch_id=<id>``. A batch it replaces (K2) is first renamed aside and deleted
only when the new one is in place, so loaded rows are never without a copy.
Each batch folder holds the mark its run started from and the one it reached
(``_marks.json``), so that a re-run of the id reads the same rows again.
Counting a batch prunes to its partition (K5).

``compact_lines`` folds the batch folders into a history with one slot for each
month of the invoice date (see ``history``), so that the number of files follows
the data and not the number of batches, and a read of some months opens only
their files.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.config import DEDUP_KEYS
from tillflow.session import freed_shuffles, path_exists
from tillflow.sinks import history
from tillflow.sinks.history import BATCH_COL, MARKS_FILE, BatchTable

STATUS_COL = "load_status"
LOADED = "loaded"
QUARANTINED = "quarantined"

RAW_SCHEMA = T.StructType([
    T.StructField("invoice_no", T.StringType()),
    T.StructField("stock_code", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("quantity", T.DecimalType(10, 2)),
    T.StructField("invoice_date", T.TimestampNTZType()),
    T.StructField("unit_price", T.DecimalType(10, 2)),
    T.StructField("customer_id", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("ingested_at", T.TimestampNTZType()),
])

QUARANTINE_SCHEMA = T.StructType(RAW_SCHEMA.fields + [
    T.StructField("error_reason", T.StringType()),
    T.StructField("quarantined_at", T.TimestampNTZType()),
    # the source record, for rows whose values alone do not tell what it was
    T.StructField("raw_record", T.StringType()),
])

# Stored columns of order_lines, partition columns last.
LINES_SCHEMA = T.StructType([f for f in QUARANTINE_SCHEMA.fields if f.name != BATCH_COL]
                            + [T.StructField(BATCH_COL, T.StringType()),
                               T.StructField(STATUS_COL, T.StringType())])


class LoadError(Exception):
    pass


def table_path(warehouse: str, name: str) -> str:
    return f"{warehouse.rstrip('/')}/{name}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """K1 for readers: a table that was never written reads as empty with
    its declared schema (writers create it on first write)."""
    if path_exists(spark, path) or schema is None:
        return spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)
    return spark.createDataFrame([], schema)


#: Slot of lines without a date; sorts after all months.
NO_MONTH = "none"


def lines_table(root: str) -> BatchTable:
    """order_lines: months of the invoice date are the slots of its history."""
    return BatchTable(root, LINES_SCHEMA, lambda: F.coalesce(F.date_format("invoice_date", "yyyy-MM"), F.lit(NO_MONTH)),
                      ("invoice_date", "invoice_no", "stock_code"), (STATUS_COL,))


def read_lines(spark: SparkSession, root: str, since: dt.datetime | None = None,
               until: dt.datetime | None = None) -> DataFrame:
    """Lines of every batch; with ``since`` / ``until`` those of these invoice dates
    (both included), read from the files of their months only."""
    if since is None and until is None:
        return history.read(spark, lines_table(root))
    first, last = (f"{t:%Y-%m}" if t else edge for t, edge in ((since, ""), (until, "9999-12")))
    lines = history.read(spark, lines_table(root), (first, last))
    for bound, holds in ((since, F.col("invoice_date").__ge__), (until, F.col("invoice_date").__le__)):
        if bound is not None:
            lines = lines.filter(holds(F.lit(bound).cast("timestamp_ntz")))
    return lines


def compact_lines(spark: SparkSession, root: str, file_bytes: int = history.FILE_BYTES) -> history.Layout:
    """Folds the batch folders into the months of the history. Nothing else may write the
    table meanwhile; readers may read it."""
    return history.compact(spark, lines_table(root), file_bytes)


def read_raw_orders(spark: SparkSession, root: str, since: dt.datetime | None = None,
                    until: dt.datetime | None = None) -> DataFrame:
    """raw_orders: the loaded lines of every batch."""
    return (read_lines(spark, root, since, until).filter(F.col(STATUS_COL) == LOADED)
            .select(*[f.name for f in RAW_SCHEMA.fields]))


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """raw_orders_quarantine: the rejected lines with their reasons."""
    return (read_lines(spark, root).filter(F.col(STATUS_COL) == QUARANTINED)
            .select(*[f.name for f in QUARANTINE_SCHEMA.fields]))


def incoming_folder(root: str, batch_id: str, run: str | None = None) -> str:
    """A hidden folder under ``root`` for one write of a batch."""
    return f"{root.rstrip('/')}/_incoming_{batch_id}_{run or uuid.uuid4().hex[:8]}"


def write_incoming(df: DataFrame, folder: str) -> str:
    """Writes one batch (columns of LINES_SCHEMA without batch_id) into its incoming folder."""
    # The writer sorts each task's rows by the partition column anyway; time
    # as the second key keeps every file's row groups in time order, so reads
    # of a time slice (the mark on, the scoped key test) skip by min/max.
    with freed_shuffles(df.sparkSession):
        (df.sortWithinPartitions(STATUS_COL, "invoice_date").write.mode("overwrite")
         .partitionBy(STATUS_COL).parquet(folder))
    return folder


def batch_folder(root: str, batch_id: str) -> str:
    return f"{root.rstrip('/')}/{BATCH_COL}={batch_id}"


def _aside(root: str, batch_id: str) -> str:
    return f"{root.rstrip('/')}/_replaced_{batch_id}"


def write_marks(spark: SparkSession, folder: str, marks: dict) -> None:
    """A batch's marks, in a small file that Spark's readers skip."""
    history.write_json(spark, f"{folder}/{MARKS_FILE}", marks)


def read_marks(spark: SparkSession, folder: str) -> dict | None:
    return history.read_json(spark, f"{folder}/{MARKS_FILE}")


def recover_batch(spark: SparkSession, root: str, batch_id: str) -> bool:
    """Puts back a batch whose replacement was cut off between its two
    renames; True if it has a folder afterwards."""
    fs, target = _fs(spark, batch_folder(root, batch_id))
    if fs.exists(target):
        return True
    _, aside = _fs(spark, _aside(root, batch_id))
    return fs.exists(aside) and fs.rename(aside, target)


def publish_batch(spark: SparkSession, root: str, incoming: str, batch_id: str) -> None:
    """Makes the written folder ``batch_id=<id>`` (K2). A batch of that id is
    renamed aside first, put back if the new one cannot take its place, and
    deleted last."""
    fs, target = _fs(spark, batch_folder(root, batch_id))
    _, src = _fs(spark, incoming)
    _, aside = _fs(spark, _aside(root, batch_id))
    replaces = recover_batch(spark, root, batch_id)
    if replaces:
        fs.delete(aside, True)      # left by a replacement that did finish
        if not fs.rename(target, aside):
            raise LoadError(f"Could not move batch {batch_id} aside; it is unchanged")
    if not fs.rename(src, target):
        if replaces:
            fs.rename(aside, target)
        raise LoadError(f"Could not publish batch {batch_id}")
    if replaces:
        fs.delete(aside, True)


def write_batch_direct(spark: SparkSession, df_with_batch: DataFrame, root: str) -> None:
    """Publish for object stores, where a folder rename is a copy: writes a
    new batch straight into ``root`` (dynamic partition overwrite of
    ``batch_id=<id>/load_status=*``). Its rows are visible from the commit of
    the job, before the checks; a failed check deletes them again. Only for a
    batch id that is not there yet."""
    with freed_shuffles(spark):
        (df_with_batch.sortWithinPartitions(BATCH_COL, STATUS_COL, "invoice_date")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_COL, STATUS_COL).parquet(root))


def lines_missing(spark: SparkSession, root: str, incoming: str, batch_id: str) -> bool:
    """Whether a batch holds loaded lines (by key) that the folder written to
    replace it does not hold, loaded or quarantined."""
    held = (read_lines(spark, root).filter((F.col(BATCH_COL) == batch_id) & (F.col(STATUS_COL) == LOADED))
            .select(*DEDUP_KEYS))
    fields = [f for f in LINES_SCHEMA.fields if f.name != BATCH_COL]
    new = spark.read.schema(T.StructType(fields)).parquet(incoming).select(*DEDUP_KEYS)
    return not held.subtract(new).isEmpty()


def batch_count(spark: SparkSession, root: str, batch_id: str, status: str = LOADED) -> int:
    """K5: rows of one batch; the filters prune to one partition folder."""
    return (read_lines(spark, root)
            .filter((F.col(BATCH_COL) == batch_id) & (F.col(STATUS_COL) == status)).count())


def overwrite(df: DataFrame, path: str) -> None:
    """Full rebuild of a mart table."""
    df.write.mode("overwrite").parquet(path)


def register_views(models: dict[str, DataFrame]) -> None:
    """Staging models as session views (lazy, inlined into readers)."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)
