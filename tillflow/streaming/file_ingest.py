"""Incremental ingest of a landing folder with Structured Streaming.

The batch pipeline reads the whole source on every run and keeps the rows
past its stored (timestamp, invoice) mark. When order files keep landing in
a folder, Structured Streaming's file source does the file bookkeeping: its
checkpoint records which files were processed, so a run reads only new
files, and the high-water mark still applies the batch pipeline's row rule
(rows older than the mark are skipped, as there).

Each micro-batch runs the batch pipeline on its rows through
``foreachBatch`` with ``batch_id = <prefix>_<stream>_<epoch>``, where
``<stream>`` is a random name kept in the checkpoint: a micro-batch retried
after a failure republishes the same batch folder (idempotent), while another
landing folder, or a stream whose checkpoint was lost, never writes over its
batches. With ``available_now=True`` a run processes what has landed as one
batch and stops (the daily job); otherwise the query keeps running with
``processing_time`` triggers. There is no limit of files per micro-batch: the
mark moves and the dedup ends with each, so such a limit would decide which
rows load.

File order for the keep-last dedup comes from the stream's own file
metadata (path, split start) plus a position within the split. The
checkpoint lives in the shared folder (``spark.checkpoint.dir``) unless one
is given.
"""

from __future__ import annotations

import hashlib
import logging
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.config import PIPELINE_NAME, IngestOptions
from tillflow.plans import pipeline
from tillflow.session import shared_dir
from tillflow.sinks.tables import read_marks, write_marks
from tillflow.sources.csv_source import (
    CORRUPT_COL,
    UTF8,
    decorate,
    enforce_schema,
    read_source_csv,
    source_header,
    text_schema,
    validate_schema,
)

log = logging.getLogger("tillflow.streaming")

_PATH = "_src_path"
_BLOCK = "_src_block"


def _micro_batch_source(spark: SparkSession, batch: DataFrame, header, multi_line: bool):
    """``encoding, multi_line -> DataFrame`` for one micro-batch. The stream's encoding
    uses the rows it read; another one, or files that hold newlines inside quotes, re-read
    exactly this micro-batch's files (their names are collected: one row per new file, which
    the stream's own file listing held on the driver before)."""
    def make(encoding: str, whole: bool | list[str] = False) -> DataFrame:
        if encoding == UTF8 and (not whole or multi_line):
            order = F.struct(F.col(_PATH).alias("file"), F.col(_BLOCK).alias("block"),
                             F.monotonically_increasing_id().alias("pos"))
            return decorate(batch, header, order)
        files = [unquote(r[_PATH]) for r in batch.select(_PATH).distinct().collect()]
        return read_source_csv(spark, files, multi_line=multi_line or whole, encoding=encoding)
    return make


def _stream_name(spark: SparkSession, checkpoint: str) -> str:
    """Name of the stream that a checkpoint belongs to, made on its first use."""
    folder = f"{checkpoint.rstrip('/')}/tillflow"
    known = read_marks(spark, folder)
    if known is None:
        known = {"stream": uuid.uuid4().hex[:12]}
        write_marks(spark, folder, known)
    return known["stream"]


def start_file_ingest(spark: SparkSession, source_dir: str, warehouse: str, *,
                      checkpoint: str | None = None, pipeline_name: str = PIPELINE_NAME,
                      batch_prefix: str = "stream", options: IngestOptions = IngestOptions(),
                      multi_line: bool = False, on_ragged: str = "fail",
                      available_now: bool = True, processing_time: str = "1 minute",
                      results: list | None = None,
                      clock=None) -> StreamingQuery:
    """Start the stream; returns the running query (``awaitTermination()``
    on an available-now query waits until the landed files are loaded)."""
    header = source_header(spark, source_dir, multi_line, UTF8)
    validate_schema(header)
    if checkpoint is None:
        # one checkpoint per (pipeline, landing folder): another folder never
        # inherits this one's file bookkeeping
        key = hashlib.sha1(f"{pipeline_name}|{source_dir.rstrip('/')}".encode()).hexdigest()[:16]
        checkpoint = f"{shared_dir(spark)}/tillflow/streams/{pipeline_name}-{key}"
    stream = _stream_name(spark, checkpoint)
    # Same parsing rules as the batch reader; whole records are parsed so
    # rows with too many fields are flagged.
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", "false")
    opts = {"header": "true", "escape": '"', "mode": "PERMISSIVE", "encoding": UTF8,
            "multiLine": str(multi_line).lower(), "columnNameOfCorruptRecord": CORRUPT_COL,
            "enforceSchema": str(enforce_schema(header)).lower()}
    landed = (spark.readStream.format("csv").options(**opts).schema(text_schema(header)).load(source_dir)
              .select("*", F.col("_metadata.file_path").alias(_PATH),
                      F.col("_metadata.file_block_start").alias(_BLOCK)))

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        kwargs = {} if clock is None else {"clock": clock}
        res = pipeline.run_pipeline(spark, _micro_batch_source(spark, batch, header, multi_line), warehouse,
                                    pipeline_name=pipeline_name, batch_id=f"{batch_prefix}_{stream}_{epoch_id}",
                                    options=options, on_ragged=on_ragged,
                                    multi_line=True if multi_line else "auto", **kwargs)
        log.info("micro-batch %s: read %s, loaded %s", epoch_id, res.records_read, res.records_loaded)
        if results is not None:
            results.append(res)

    writer = landed.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
