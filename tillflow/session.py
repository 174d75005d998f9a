"""Session construction and shared-storage locations."""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings the engine relies on. Time zone is pinned so that every
# timestamp_ntz <-> timestamp hop and every "now" is UTC.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Replace only the partitions (batches) a write touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Partition folders (batch_id=...) are text keys, never numbers.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Parse whole CSV records: with pruning on, rows with too many fields are
    # not flagged when only some columns are requested.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    # The JVM never compiles a method above 8,000 bytes of bytecode. A stage whose
    # generated code has one runs operator by operator instead, in small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def scale_conf(input_bytes: int, partition_bytes: int = 256 * 1024 * 1024,
               executor_cores: int | None = None, executors: int | None = None) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of source.

    Shuffles start with enough partitions that each holds about
    ``partition_bytes`` (and at least two waves of the cluster's cores); AQE
    then coalesces small ones to its advisory size instead of maximising
    parallelism, and splits skewed ones. Scan splits stay at 128 MB."""
    cores = (executor_cores or 1) * (executors or 1)
    partitions = max(200, -(-input_bytes // partition_bytes), 2 * cores)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def get_session(master: str | None = None, app: str = "tillflow", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.ui.enabled", "false")
    # Independent jobs (mart writes, data-test and report queries, AQE query
    # stages, the audit row next to a batch) share executors instead of
    # queueing behind the first submitted job. Set before the context starts.
    builder = builder.config("spark.scheduler.mode", "FAIR")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_free_lock = threading.Lock()
_free_open: dict[str, tuple[int, str]] = {}     # session -> scopes open, setting before the first


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes started inside remove their shuffle files as they end. Else those lie on the
    executors' disks until the driver's garbage collection drops their frames, and a run of
    several jobs holds the shuffles of all of them at once. A write makes a plan of its own,
    so its frame can be used again. Scopes may nest and overlap."""
    session = spark._jsparkSession.sessionUUID()
    with _free_lock:
        n, before = _free_open.get(session) or (0, spark.conf.get(FREE_SHUFFLES, "false"))
        _free_open[session] = (n + 1, before)
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _free_lock:
            n, before = _free_open.pop(session)
            if n > 1:
                _free_open[session] = (n - 1, before)
            else:
                spark.conf.set(FREE_SHUFFLES, before)


def shared_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The cluster's shared folder, taken from ``spark.checkpoint.dir``.

    On a cluster this must be set (HDFS / object store). Only when it is unset,
    as in local tests, ``fallback`` is used and registered as the checkpoint
    dir. A machine-local temp folder is never chosen silently."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if fallback is None and sc.master.startswith("local"):
            # local mode: driver and executors share this machine's disk
            fallback = local_test_dir("tillflow-shared-")
        if fallback is None:
            raise RuntimeError("spark.checkpoint.dir is not set; pass a shared folder")
        # spark.checkpoint.dir cannot change at run time; register the folder
        # with the context instead (read back through getCheckpointDir)
        sc.setCheckpointDir(fallback)
        d = sc.getCheckpointDir()
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for an intermediate table."""
    return f"{shared_dir(spark)}/tillflow/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or directory exists, through the cluster's Hadoop
    FileSystem (works for local, HDFS and object-store paths)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def local_test_dir(prefix: str = "tillflow-") -> str:
    import tempfile

    return tempfile.mkdtemp(prefix=prefix, dir=os.environ.get("TILLFLOW_TMP", "/tmp"))
