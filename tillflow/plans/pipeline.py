"""End-to-end runs: ingest a batch, build the marts, run the data tests,
answer the dashboard queries (the daily chain ingest >> build >> test).

Ingest plan, per batch, one heavy job:
1. read the watermark (S10) and the source (CSV path or a DataFrame that
   carries ``_ord``);
2. clean, incremental filter, keep-last dedup, quality flag, conform: one
   lazy plan with one shuffle;
3. write the batch once into a hidden folder of ``order_lines``, loaded and
   quarantined rows partitioned by ``load_status``. Observed metrics of that
   single pass give rows read, duplicates, rejects, skipped rows, the next
   watermark and the source checks (bad UTF-8, overlong rows);
4. act on the checks (re-read as ISO-8859-1, or fail), then publish the folder
   as ``batch_id=<id>``, advance the watermark, and only then close the audit
   row.

A run leaves a note of itself while it is under way (``state.pending``). A run
that was cut off is settled by the next one before it reads the mark: was its
batch published, the mark moves to where the batch ended, else what it wrote is
removed. No line is loaded twice and none is left out.

A batch id that exists already is read again from the mark its first run
started from (kept in the batch folder), without the rows that later batches
loaded. It is replaced only by a folder that holds all of its loaded lines, and
the watermark never moves back: a re-run never loses rows the mark has passed.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillflow.config import PIPELINE_NAME, RAW_TABLE, UNEXPECTED_PREFIX, IngestOptions
from tillflow.functions import truncate_to_second
from tillflow.operators.clean import ValidationError
from tillflow.operators.conform import LOADABLE_COL
from tillflow.operators.datatests import assert_suite_passes, test_suite
from tillflow.operators.incremental import new_records_predicate
from tillflow.operators.quality import REASON_COL
from tillflow.plans import dim_state, ingest, key_state, marts, reports, staging
from tillflow.plans.catalog import TABLE_MODELS, VIEW_MODELS, ModelParams, Models
from tillflow.sinks.tables import (
    BATCH_COL,
    STATUS_COL,
    LoadError,
    batch_count,
    batch_folder,
    compact_lines,
    delete_path,
    incoming_folder,
    lines_missing,
    overwrite,
    publish_batch,
    read_quarantine as _read_quarantine,
    read_raw_orders,
    recover_batch,
    register_views,
    table_path,
    write_batch_direct,
    write_incoming,
    write_marks,
)
from tillflow.sinks import history
from tillflow.sources.csv_source import (
    LATIN1,
    UTF8,
    ExtractionError,
    check_metrics,
    drop_check_columns,
    has_check_columns,
    list_files,
    not_utf8,
    open_quote_files,
    read_source_csv,
)
from tillflow.state.pending import CHECKED, WRITING, PendingRuns
from tillflow.state.pipeline_state import AuditLog, WatermarkError, WatermarkStore, utcnow

log = logging.getLogger("tillflow.pipeline")

MART_COLUMNS = {
    "fct_orders": ("order_key", "invoice_no", "stock_code", "customer_id", "date_id", "is_cancelled",
                   "invoice_date", "quantity", "unit_price", "line_total", "net_line_total", "country",
                   "batch_id", "ingested_at"),
}


class PipelineError(Exception):
    pass


DOMAIN_ERRORS = (ExtractionError, ValidationError, LoadError, WatermarkError, PipelineError)


@dataclass(frozen=True)
class Layout:
    warehouse: str

    def path(self, name: str) -> str:
        return table_path(self.warehouse, name)

    @property
    def lines(self) -> str:
        """Physical dataset behind raw_orders and raw_orders_quarantine."""
        return self.path("order_lines")

    @property
    def watermark(self) -> str:
        return self.path("state/pipeline_watermark")

    @property
    def audit(self) -> str:
        return self.path("state/pipeline_audit")

    @property
    def dim_state(self) -> str:
        return self.path("state/dimensions")

    @property
    def key_state(self) -> str:
        return self.path("state/order_keys")

    @property
    def pending(self) -> str:
        return self.path("state/pending_runs")

    def mart(self, name: str) -> str:
        return self.path(f"marts/{name}")


@dataclass
class RunResult:
    batch_id: str
    status: str
    records_read: int = 0
    records_loaded: int = 0
    records_quarantined: int = 0
    records_skipped: int = 0
    duplicates_removed: int = 0
    watermark: tuple | None = None
    metrics: dict = field(default_factory=dict)


def make_batch_id(now: dt.datetime) -> str:
    """``orders_<UTC yyyymmdd_hhmmss>_<8 hex>``."""
    return f"orders_{now:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


def _delete_quietly(spark: SparkSession, path: str) -> None:
    try:
        delete_path(spark, path)
    except Exception as e:  # noqa: BLE001
        log.warning("Could not remove %s: %s", path, e)


Mark = tuple  # (last_processed_at, last_invoice_no), (None, None) without a mark


@dataclass(frozen=True)
class Start:
    """Where a batch reads from. A batch that exists already (``replaces``)
    reads from the mark of its first run, but not what lies past the mark it
    reached (``end``) up to the stored one: later batches loaded that."""
    mark: Mark
    stored: Mark
    end: Mark
    replaces: bool = False

    def rows(self, prepared: DataFrame) -> DataFrame:
        if not self.replaces or self.stored[0] is None:
            return prepared
        past_end = F.lit(True) if self.end[0] is None else F.coalesce(new_records_predicate(*self.end), F.lit(False))
        past_stored = F.coalesce(new_records_predicate(*self.stored), F.lit(False))
        return prepared.filter(F.col("invoice_date").isNull() | ~past_end | past_stored)


def _as_text(mark: Mark) -> list:
    return [mark[0].isoformat() if mark[0] else None, mark[1]]


def _as_mark(text: list) -> Mark:
    return (dt.datetime.fromisoformat(text[0]) if text[0] else None, text[1])


def _start(spark: SparkSession, layout: Layout, batch_id: str, pipeline_name: str, stored: Mark) -> Start:
    marks = None
    if not recover_batch(spark, layout.lines, batch_id):
        marks = history.read_layout(spark, layout.lines).batches.get(batch_id)
        if marks is None:
            return Start(stored, stored, stored)
    marks = marks or history.marks_of(spark, layout.lines, batch_id)
    if marks is None or "start" not in marks:
        raise LoadError(f"Batch {batch_id} is loaded but does not say where it started, so it cannot be "
                        "read again whole; use a new batch id")
    if marks["pipeline"] != pipeline_name:
        raise LoadError(f"Batch {batch_id} belongs to pipeline {marks['pipeline']}; use another batch id")
    return Start(_as_mark(marks["start"]), stored, _as_mark(marks["end"]), replaces=True)


def _is_past(mark: Mark, stored: Mark) -> bool:
    return mark[0] is not None and (stored[0] is None or (mark[0], mark[1] or "") > (stored[0], stored[1] or ""))


def recover(spark: SparkSession, warehouse: str, pipeline_name: str = PIPELINE_NAME, clock=utcnow,
            truncate_watermark: bool = False) -> list[str]:
    """Settles runs of a pipeline that were cut off; returns the ids of the batches that
    count as loaded. Called at the start of every run; one run per pipeline at a time is
    assumed, as for the mark itself."""
    layout = Layout(warehouse)
    pending = PendingRuns(spark, layout.pending)
    wm = WatermarkStore(spark, layout.watermark, truncate_to_seconds=truncate_watermark)
    audit = AuditLog(spark, layout.audit)
    loaded = []
    for entry in pending.entries():
        if entry["pipeline"] != pipeline_name:
            continue
        recover_batch(spark, layout.lines, entry["batch_id"])
        there = history.marks_of(spark, layout.lines, entry["batch_id"])
        same = there is not None and there.get("run") == entry["run"]
        if entry["state"] == CHECKED and same:
            mark = _as_mark(entry["end"])
            if _is_past(mark, wm.read(pipeline_name, RAW_TABLE)):
                wm.write(pipeline_name, RAW_TABLE, *mark)
            audit.complete(entry["batch_id"], pipeline_name, dt.datetime.fromisoformat(entry["started_at"]),
                           entry["records_read"], batch_count(spark, layout.lines, entry["batch_id"]), clock())
            loaded.append(entry["batch_id"])
            log.warning("Batch %s was published by a run that was cut off; its mark is stored now", entry["batch_id"])
        elif not entry["direct"] or same:
            _delete_quietly(spark, entry["folder"])    # rows that never passed the checks
        pending.remove(entry["run"])
    return loaded


def _without_loaded_keys(spark: SparkSession, layout: Layout, flagged: DataFrame, last_ts, batch_id: str) -> DataFrame:
    """G7 option: drop clean rows whose (invoice, stock code, time) is
    already loaded by another batch. A loaded twin has the same time in whole
    seconds, and every new row is at or after the stored mark, so only the raw
    slice from the mark's second on is read (the predicate reaches the Parquet
    scan); that slice, not the whole history, meets the new rows. Rejected rows
    are kept."""
    loaded = (read_raw(spark, layout.warehouse, since=last_ts.replace(microsecond=0))
              .filter(F.col(BATCH_COL) != batch_id)
              .select("invoice_no", "stock_code", truncate_to_second("invoice_date").alias("_second")).distinct())
    is_clean = F.col(REASON_COL) == ""
    clean = (flagged.filter(is_clean).withColumn("_second", truncate_to_second("invoice_date"))
             .join(loaded, ["invoice_no", "stock_code", "_second"], "left_anti"))
    return clean.select(*flagged.columns).unionByName(flagged.filter(~is_clean))


ON_RAGGED = ("fail", "quarantine")
ON_UNFIT = ("skip", "quarantine")


def _source_frame(spark: SparkSession, source, multi_line: bool | list[str], encoding: str) -> DataFrame:
    if isinstance(source, (str, list, tuple)):
        return read_source_csv(spark, source, multi_line=multi_line, encoding=encoding)
    return source(encoding, multi_line) if callable(source) else source


def _invalid_utf8(spark: SparkSession, source, multi_line: bool | list[str]) -> bool:
    """Whether the bytes of some row are not UTF-8; stops at the first one."""
    return not not_utf8(_source_frame(spark, source, multi_line, LATIN1)).isEmpty()


@dataclass(frozen=True)
class Load:
    """How one run reads and writes its batch."""
    batch_id: str
    pipeline_name: str
    run: str
    folder: str
    direct: bool
    started_at: dt.datetime
    on_ragged: str = "fail"
    on_unfit: str = "skip"
    skip_loaded_keys: bool = False
    files: tuple[tuple[str, int, int], ...] | None = None


def _write_batch(spark: SparkSession, source, layout: Layout, options: IngestOptions, start: Start,
                 load: Load, encoding: str, multi_line: bool | list[str], clock):
    """Steps 2-3 into ``load.folder``. Returns (metrics, source-check metrics)."""
    checks = None
    last_ts, last_inv = start.mark
    src = _source_frame(spark, source, multi_line, encoding)
    if has_check_columns(src):
        checks = Observation(f"source_checks_{uuid.uuid4().hex[:8]}")
        src = drop_check_columns(src.observe(checks, *check_metrics()), keep_record=load.on_ragged == "quarantine")
    read_obs = Observation(f"read_{uuid.uuid4().hex[:8]}")
    prepared = start.rows(ingest.prepare(src, options, last_ts, last_inv)).observe(
        read_obs, F.count(F.lit(1)).alias("records_read"))
    flagged = ingest.dedup_and_flag(prepared)
    if load.skip_loaded_keys and last_ts is not None:
        flagged = _without_loaded_keys(spark, layout, flagged, last_ts, load.batch_id)
    is_clean = F.col(REASON_COL) == ""
    flag_obs = Observation(f"flag_{uuid.uuid4().hex[:8]}")
    flagged = flagged.observe(
        flag_obs,
        F.count(F.lit(1)).alias("deduplicated"),
        F.count_if(~is_clean).alias("rejected"),
        F.count_if(is_clean).alias("clean"),
        # next mark from the clean rows at full precision (before conform)
        F.max(F.when(is_clean, F.struct(F.col("invoice_date").alias("last_processed_at"),
                                        F.col("invoice_no").alias("last_invoice_no")))).alias("watermark"),
    )
    now = clock()
    lines = ingest.batch_lines(flagged, load.batch_id, now, now, load.on_unfit)
    load_obs = Observation(f"load_{uuid.uuid4().hex[:8]}")
    unfit = ~F.col(LOADABLE_COL)
    lines = lines.observe(load_obs, F.count_if((F.col(STATUS_COL) == "loaded") & unfit).alias("skipped"),
                          F.count_if(F.col(ingest.UNFIT_COL)).alias("unfit"))
    lines = lines.filter((F.col(STATUS_COL) != "loaded") | ~unfit).drop(LOADABLE_COL, ingest.UNFIT_COL)
    marks = {"run": load.run, "pipeline": load.pipeline_name, "start": _as_text(start.mark), "end": _as_text(start.mark)}
    if load.files is not None:
        marks["files"] = load.files
    try:
        if load.direct:
            write_marks(spark, load.folder, marks)     # before any row: a run that is cut off can start over
            write_batch_direct(spark, lines.withColumn(BATCH_COL, F.lit(load.batch_id)), layout.lines)
        else:
            write_incoming(lines, load.folder)
        metrics = {**read_obs.get, **flag_obs.get, **load_obs.get}
        if metrics.get("watermark") is not None:
            marks["end"] = _as_text(tuple(metrics["watermark"]))
        write_marks(spark, load.folder, marks)
    except (ExtractionError, ValidationError):
        raise
    except Exception as e:  # noqa: BLE001
        if "CSV header does not conform" in str(e):
            raise ExtractionError("The source files do not share one header (names and order of the columns); "
                                  f"load files of different layouts separately: {e}") from e
        raise LoadError(f"Could not write batch {load.batch_id}: {e}") from e
    return metrics, (checks.get if checks is not None else {})


def run_pipeline(spark: SparkSession, source: str | DataFrame, warehouse: str, *,
                 pipeline_name: str = PIPELINE_NAME, batch_id: str | None = None,
                 options: IngestOptions = IngestOptions(), multi_line: bool | str = "auto",
                 encoding: str = "auto", on_ragged: str = "fail", clock=utcnow,
                 truncate_watermark: bool = False, publish: str = "rename",
                 skip_loaded_keys: bool = False,
                 on_unfit: str = "skip", compact_after: int | None = None,
                 new_files_only: bool = False) -> RunResult:
    """One incremental batch from ``source`` into the warehouse.

    ``source`` is a CSV path/glob (or list), a DataFrame with the source
    columns and an orderable ``_ord``, or a function ``encoding, multi_line -> DataFrame``
    (used by the streaming driver for micro-batches). ``encoding="auto"`` reads UTF-8 and re-reads the
    whole source as ISO-8859-1 if any text was not valid UTF-8. ``multi_line="auto"`` splits
    all files and reads those again whole in which a row leaves a quote open, as a newline
    inside quotes does; ``True`` reads every file whole, ``False`` none.
    ``new_files_only`` leaves out files of a CSV path that an earlier batch of the pipeline
    has read, by path, length and change time; the row mark holds for the others.
    ``on_ragged="fail"`` rejects a source with rows longer than the header;
    ``"quarantine"`` loads the others and puts these rows, with their whole record,
    into the quarantine. ``on_unfit`` does the same for clean rows whose values do
    not fit the raw table, which are otherwise skipped and counted. ``publish="rename"``
    writes the batch into a hidden folder and renames it into place after
    the checks (atomic on HDFS-like stores); ``"direct"`` writes it in
    place, for object stores where a rename is a copy (its rows are visible
    before the checks). A ``batch_id`` that is loaded already is read again
    from where it started and replaced whole; see the module's text.
    ``skip_loaded_keys=True`` also drops clean lines whose key an earlier
    batch already loaded (the table key is otherwise not enforced). With ``compact_after``
    the batch folders are folded into the table's history whenever there are so many."""
    if on_ragged not in ON_RAGGED or on_unfit not in ON_UNFIT:
        raise ValueError(f"on_ragged must be one of {ON_RAGGED} and on_unfit one of {ON_UNFIT}")
    layout = Layout(warehouse)
    started_at = clock()
    batch_id = batch_id or make_batch_id(started_at)
    wm = WatermarkStore(spark, layout.watermark, truncate_to_seconds=truncate_watermark)
    audit = AuditLog(spark, layout.audit)
    wm.ensure()
    audit.ensure()
    recover(spark, warehouse, pipeline_name, clock, truncate_watermark)
    pending_runs = PendingRuns(spark, layout.pending)
    run = uuid.uuid4().hex
    # The in-progress audit row is independent of the batch: write it while
    # the batch runs, and wait for it before the row is closed.
    pool = ThreadPoolExecutor(max_workers=2)
    pending = [pool.submit(audit.start, batch_id, pipeline_name, started_at)]

    def settle():
        # audit writes of this run happen one after another on the table
        for f in pending:
            f.result()
        pending.clear()

    try:
        stored = wm.read(pipeline_name, RAW_TABLE)
        start = _start(spark, layout, batch_id, pipeline_name, stored)
        direct = publish == "direct" and not start.replaces
        files = None
        if new_files_only:
            if not isinstance(source, (str, list, tuple)):
                raise ExtractionError("new_files_only needs a path as the source")
            files = _new_files(spark, layout, source, pipeline_name, batch_id if start.replaces else None)
            source = [f for f, _, _ in files]
        load = Load(batch_id, pipeline_name, run, batch_folder(layout.lines, batch_id) if direct
                    else incoming_folder(layout.lines, batch_id, run), direct, started_at, on_ragged, on_unfit,
                    skip_loaded_keys, files)
        if files == ():
            log.info("No new file")
            result, mark = RunResult(batch_id, "success"), None
        else:
            result, mark = _run(spark, source, layout, start, load, options, encoding, multi_line, clock, pending_runs)
        settle()
        # the mark first: an audit row never says success for a run whose mark is old
        if mark is not None and _is_past(mark, stored):
            wm.write(pipeline_name, RAW_TABLE, *mark)
        pending_runs.remove(run)
        audit.complete(batch_id, pipeline_name, started_at, result.records_read, result.records_loaded, clock())
        if compact_after is not None:
            _compact_quietly(spark, layout, compact_after)
        return result
    except DOMAIN_ERRORS as e:
        settle()
        audit.fail(batch_id, pipeline_name, started_at, str(e), clock())
        raise
    except Exception as e:
        settle()
        audit.fail(batch_id, pipeline_name, started_at, f"{UNEXPECTED_PREFIX}{e}", clock())
        raise
    finally:
        pool.shutdown(wait=True)


def _compact_quietly(spark: SparkSession, layout: Layout, compact_after: int) -> None:
    try:
        if len(history.live_marks(spark, layout.lines)) >= compact_after:
            compact_lines(spark, layout.lines)
    except Exception as e:  # noqa: BLE001 - housekeeping never fails a run
        log.warning("Compaction of %s failed: %s", layout.lines, e)


def _new_files(spark: SparkSession, layout: Layout, source, pipeline_name: str, again: str | None) -> tuple[tuple[str, int, int], ...]:
    """Files of the source that no batch of the pipeline holds, or, of a batch that is
    read again, its own."""
    loaded = {}
    for batch, marks in history.batches(spark, layout.lines).items():
        if marks.get("pipeline") == pipeline_name and batch != again:
            loaded |= {tuple(f): batch for f in marks.get("files", ())}
    return tuple(f for f in list_files(spark, source) if f not in loaded)


def _run(spark, source, layout: Layout, start: Start, load: Load, options, encoding, multi_line, clock,
         pending: PendingRuns) -> tuple[RunResult, Mark | None]:
    """Reads, writes and publishes the batch; returns the mark that it reached."""
    batch_id = load.batch_id
    enc = UTF8 if encoding == "auto" else encoding
    published = False
    note = {"state": WRITING, "batch_id": batch_id, "pipeline": load.pipeline_name, "folder": load.folder,
            "direct": load.direct, "started_at": load.started_at.isoformat()}

    whole: bool | list[str] = False if multi_line == "auto" else bool(multi_line)

    def write(enc: str, whole: bool | list[str]):
        return _write_batch(spark, source, layout, options, start, load, enc, whole, clock)

    pending.put(load.run, **note)
    try:
        m, checks = write(enc, whole)
        again = False
        if multi_line == "auto" and checks.get("open_quote_rows", 0) > 0:
            whole, again = open_quote_files(_source_frame(spark, source, False, enc)), True
            log.warning("%d file(s) hold newlines inside quotes; reading them again whole", len(whole))
        if encoding == "auto" and checks.get("bad_text_rows", 0) > 0 and _invalid_utf8(spark, source, whole):
            log.warning("Source is not valid UTF-8; re-reading it as %s", LATIN1)
            enc, again = LATIN1, True
        if again:
            _delete_quietly(spark, load.folder)
            m, checks = write(enc, whole)
        if checks.get("overlong_rows", 0) > 0 and load.on_ragged == "fail":
            raise ExtractionError(f"{checks['overlong_rows']} row(s) of the source have more fields than its "
                                  "header; mend the file, or load it with on_ragged='quarantine'")
        records_read = int(m.get("records_read") or 0)
        if records_read == 0:
            log.info("Nothing past the stored mark")
            return RunResult(batch_id, "success", metrics={**m, **checks}), None
        if start.replaces and lines_missing(spark, layout.lines, load.folder, batch_id):
            raise LoadError(f"The source no longer holds all lines that batch {batch_id} loaded; the batch is "
                            "left as it is. Use a new batch id for other lines")
        mark = tuple(m["watermark"]) if m.get("watermark") is not None else None
        pending.put(load.run, **note | {"state": CHECKED, "end": _as_text(mark or (None, None)), "records_read": records_read})
        if not load.direct:
            publish_batch(spark, layout.lines, load.folder, batch_id)
        published = True
        unfit = int(m.get("unfit", 0)) if load.on_unfit == "quarantine" else 0
        return RunResult(batch_id, "success", records_read=records_read,
                         records_loaded=batch_count(spark, layout.lines, batch_id),
                         records_quarantined=int(m.get("rejected", 0)) + unfit,
                         records_skipped=int(m.get("skipped", 0)),
                         duplicates_removed=records_read - int(m.get("deduplicated", 0)),
                         watermark=mark, metrics={**m, **checks}), mark
    finally:
        # a published batch keeps its note until the mark has moved
        if not published:
            _delete_quietly(spark, load.folder)
            pending.remove(load.run)


def read_raw(spark: SparkSession, warehouse: str, since: dt.datetime | None = None,
             until: dt.datetime | None = None) -> DataFrame:
    return read_raw_orders(spark, Layout(warehouse).lines, since, until)


def read_quarantine(spark: SparkSession, warehouse: str) -> DataFrame:
    return _read_quarantine(spark, Layout(warehouse).lines)


def build_marts(spark: SparkSession, warehouse: str, params: ModelParams = ModelParams(),
                batches: list[str] | None = None) -> dict[str, DataFrame]:
    """Staging models as views, marts as tables; returns every model (marts
    read back from their tables).

    ``fct_orders`` is stored partitioned by ``batch_id``. It is row for row
    of raw_orders, so with ``batches`` only those batches are (re)built, by
    dynamic partition overwrite of their folders; older batches are left as
    they are, and the customer and product dimensions are brought up to date from
    the new lines and ``dim_state``, which replaces the scan of all history.
    Without ``batches``, or where these are all there is, everything is rebuilt from the
    lines. The dimension tables themselves are customer-, product- and day-sized and
    written whole: the days since the last order change for every customer."""
    layout = Layout(warehouse)
    raw = read_raw(spark, warehouse)
    models = Models(spark, raw, params)
    state = dim_state.DimensionState(spark, layout.dim_state, layout.lines) if batches is not None else None
    if state is not None and (state.exists() or set(history.batches(spark, layout.lines)) - set(batches)):
        state.update()
        models.stg_customers, models.stg_products = state.stg_customers(params.country_rule), state.stg_products()
    else:
        # The two aggregated staging views feed a mart each and are tested right
        # after the build; keep their (customer- / product-sized) results so the
        # tests of this run read them instead of aggregating the lines again.
        for name in ("stg_customers", "stg_products"):
            setattr(models, name, getattr(models, name).persist(StorageLevel.MEMORY_AND_DISK))
    models.dim_customers = marts.dim_customers(models.stg_customers, params.as_of)
    models.dim_products = marts.dim_products(models.stg_products)
    register_views({n: getattr(models, n) for n in VIEW_MODELS})
    out = {n: getattr(models, n) for n in VIEW_MODELS}

    def write_fact():
        fct = models.fct_orders
        if batches is not None:
            fct = marts.fct_orders(staging.stg_orders(raw.filter(F.col("batch_id").isin(*batches))))
        # rows in time order within each batch file (see write_incoming)
        w = fct.sortWithinPartitions("batch_id", "invoice_date").write.mode("overwrite")
        if batches is not None:
            w = w.option("partitionOverwriteMode", "dynamic")
        w.partitionBy("batch_id").parquet(layout.mart("fct_orders"))

    jobs = {"fct_orders": write_fact}
    for name in ("dim_customers", "dim_products", "dim_date"):
        jobs[name] = (lambda n: lambda: overwrite(getattr(models, n), layout.mart(n)))(name)
    # Independent jobs: submit them together so their small stages share the
    # executors instead of running one after another.
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for f in [pool.submit(j) for j in jobs.values()]:
            f.result()
    for name in TABLE_MODELS:
        out[name] = read_mart(spark, warehouse, name, getattr(models, name).schema)
    return out


def read_mart(spark: SparkSession, warehouse: str, name: str, schema=None) -> DataFrame:
    """A mart table; with the model's ``schema`` no inference job runs."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(Layout(warehouse).mart(name))
    if name == "fct_orders":
        # partition column back in the model's column order
        return df.select(*MART_COLUMNS["fct_orders"])
    return df


def read_models(spark: SparkSession, warehouse: str, params: ModelParams = ModelParams()) -> dict[str, DataFrame]:
    layout = Layout(warehouse)
    models = Models(spark, read_raw(spark, warehouse), params)
    out = {n: getattr(models, n) for n in VIEW_MODELS}
    for name in TABLE_MODELS:
        out[name] = read_mart(spark, warehouse, name, getattr(models, name).schema)
    return out


def release(models: dict[str, DataFrame]) -> None:
    """Drop the staging results kept by ``build_marts``."""
    for df in models.values():
        df.unpersist()


def run_tests(spark: SparkSession, warehouse: str, params: ModelParams = ModelParams(),
              raise_on_failure: bool = True, models: dict[str, DataFrame] | None = None,
              batches: list[str] | None = None):
    """The 34 declared data tests over the built models (those returned by
    ``build_marts`` in this run, or read from the warehouse).

    All models are tested whole, unless ``batches`` asks for less: then the
    not_null tests of stg_orders and fct_orders read only the batches' partitions (a
    failing row of an earlier batch is not reported again), while unique(order_key) holds
    for all history still: its result comes from ``key_state``, which reads the new
    batches and the keys of their months. The customer-, product- and day-sized models are
    tested whole."""
    models = dict(models if models is not None else read_models(spark, warehouse, params))
    unique_models = {}
    if batches:
        in_batches = F.col("batch_id").isin(*batches)
        models["stg_orders"] = staging.stg_orders(read_raw(spark, warehouse).filter(in_batches))
        fct_all = read_mart(spark, warehouse, "fct_orders", models["fct_orders"].schema)
        models["fct_orders"] = fct_all.filter(in_batches)
        layout = Layout(warehouse)
        keys = key_state.KeyState(spark, layout.key_state, layout.lines)
        if keys.exists() or set(history.batches(spark, layout.lines)) - set(batches):
            keys.update()
            unique_models["fct_orders"] = keys.as_lines()
    results = test_suite(models, unique_models=unique_models)
    if raise_on_failure:
        assert_suite_passes(results)
    return results


def collect_all(frames: dict[str, DataFrame]) -> dict[str, list]:
    """Collect several small results as concurrent jobs."""
    with ThreadPoolExecutor(max_workers=max(1, len(frames))) as pool:
        futures = {k: pool.submit(v.collect) for k, v in frames.items()}
        return {k: f.result() for k, f in futures.items()}


def dashboard(spark: SparkSession, warehouse: str, top_n: int = 10) -> dict[str, DataFrame]:
    """B1-B7 over the materialised marts."""
    # Schemas from the (lazy, never executed) models over raw_orders, so the
    # mart reads need no inference job.
    shapes = Models(spark, read_raw(spark, warehouse), ModelParams())
    fct = read_mart(spark, warehouse, "fct_orders", shapes.fct_orders.schema)
    dim_c = read_mart(spark, warehouse, "dim_customers", shapes.dim_customers.schema)
    dim_p = read_mart(spark, warehouse, "dim_products", shapes.dim_products.schema)
    dim_d = read_mart(spark, warehouse, "dim_date", shapes.dim_date.schema)
    monthly = reports.revenue_by_month(fct, dim_d)
    return {
        "kpi_headline": reports.kpi_headline(fct, dim_c, dim_p),
        "revenue_by_month": monthly,
        "peak_month": reports.peak_month(monthly),
        "segment_distribution": reports.segment_distribution(dim_c),
        "revenue_by_country": reports.revenue_by_country(fct),
        "top_products": reports.top_products(dim_p, top_n),
        "revenue_by_segment": reports.revenue_by_segment(fct, dim_c),
        "quarantine_breakdown": reports.quarantine_breakdown(read_quarantine(spark, warehouse)),
    }
