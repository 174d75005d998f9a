"""Tables that grow by batches, with a compacted history.

A batch is one folder ``batch_id=<id>`` of the table (the live part), which also holds
its marks. Every batch adds folders that each reader has to list, so from time to time
``compact`` folds the live batches into the history:

    _history/gen=<g>/slot=<s>/...     rows of one slot, clustered, a bounded number of files
    _layout/<n>.json                  which generation holds each slot, and the marks of
                                      all batches that the history has

A slot is a piece of the table that queries ask for, such as a month. Compaction writes
the slots that the live batches touch as a new generation, then a new layout file, and
then removes what the layout no longer names. The highest layout file is the current one
and is made with a create that fails if the file exists, so readers see the old table or
the new one, a run that is cut off changes nothing, and of two compactions one fails.

Whether the rows of a batch are read from its folder or from the history follows from
the files alone: a live folder with the marks that the layout names is a leftover of a
finished compaction and is not read; a live folder with other marks replaces the
history's rows of that batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.session import freed_shuffles

BATCH_COL = "batch_id"
MARKS_FILE = "_marks.json"
HISTORY, LAYOUT, GENERATION, SLOT = "_history", "_layout", "gen", "slot"
#: Bytes of one file of the history, about.
FILE_BYTES = 128 * 1024 * 1024


class CompactionError(Exception):
    pass


@dataclass(frozen=True)
class BatchTable:
    """``schema`` holds all columns; ``folders`` are the partition columns inside a batch
    folder; rows of the history lie in the slot that ``slot_of()`` (text, never null) gives
    and are clustered by ``order``."""

    root: str
    schema: T.StructType
    slot_of: Callable[[], Column]
    order: tuple[str, ...]
    folders: tuple[str, ...] = ()

    def batch_folder(self, batch_id: str) -> str:
        return f"{self.root.rstrip('/')}/{BATCH_COL}={batch_id}"


@dataclass
class Layout:
    number: int = -1
    slots: dict[str, str] = field(default_factory=dict)
    batches: dict[str, dict] = field(default_factory=dict)


def filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and change times below a folder; none if it is not there."""
    fs, p = filesystem(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p)]


def read_json(spark: SparkSession, path: str) -> dict | None:
    fs, p = filesystem(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value: dict, replace: bool = True) -> None:
    fs, p = filesystem(spark, path)
    out = fs.create(p, replace)
    try:
        out.write(bytearray(json.dumps(value).encode("utf-8")))
    finally:
        out.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = filesystem(spark, path)
    fs.delete(p, True)


# -- which batches are where -------------------------------------------------------

def read_layout(spark: SparkSession, root: str) -> Layout:
    numbers = sorted((int(n.removesuffix(".json")) for n, _ in names(spark, f"{root}/{LAYOUT}") if n.removesuffix(".json").isdigit()),
                     reverse=True)
    for n in numbers:  # the highest that was written to its end
        try:
            found = read_json(spark, f"{root}/{LAYOUT}/{n}.json")
        except ValueError:
            continue
        return Layout(n, found["slots"], found["batches"])
    return Layout(numbers[0] if numbers else -1)


def _folder_marks(spark: SparkSession, folder: str, changed: int) -> dict:
    """A batch folder's marks. A folder without them is known by its change time."""
    return read_json(spark, f"{folder}/{MARKS_FILE}") or {"run": f"changed-{changed}"}


def live_marks(spark: SparkSession, root: str) -> dict[str, dict]:
    """Marks of the batch folders."""
    return {name.split("=", 1)[1]: _folder_marks(spark, f"{root}/{name}", changed)
            for name, changed in names(spark, root) if name.startswith(f"{BATCH_COL}=")}


def batches(spark: SparkSession, root: str) -> dict[str, dict]:
    """All batches of a table, live or in the history, with their marks."""
    return read_layout(spark, root).batches | live_marks(spark, root)


def run_of(marks: dict) -> str:
    """What tells two writes of one batch apart."""
    return marks.get("run") or json.dumps(marks, sort_keys=True)


def marks_of(spark: SparkSession, root: str, batch_id: str) -> dict | None:
    """The marks of one batch; None if the table has no such batch or does not know them."""
    return read_json(spark, f"{root}/{BATCH_COL}={batch_id}/{MARKS_FILE}") or read_layout(spark, root).batches.get(batch_id)


# -- reading -----------------------------------------------------------------------

def read(spark: SparkSession, table: BatchTable, slots: tuple[str, str] | None = None) -> DataFrame:
    """The rows of all batches. ``slots``: of the history only the slots from the first to
    the last of these names; live rows are not cut."""
    root = table.root.rstrip("/")
    there = dict(names(spark, root))
    live = {n.split("=", 1)[1]: changed for n, changed in there.items() if n.startswith(f"{BATCH_COL}=")}
    layout = read_layout(spark, root) if LAYOUT in there else Layout()
    both = [b for b in live if b in layout.batches]
    leftover = [b for b in both if run_of(_folder_marks(spark, table.batch_folder(b), live[b])) == run_of(layout.batches[b])]
    replaced = [b for b in both if b not in leftover]
    columns, parts = table.schema.fieldNames(), []
    if len(live) > len(leftover):
        new = spark.read.schema(table.schema).parquet(root)
        parts.append((new.filter(~F.col(BATCH_COL).isin(leftover)) if leftover else new).select(*columns))
    wanted = sorted(s for s in layout.slots if slots is None or slots[0] <= s <= slots[1])
    if wanted:
        old = _history(spark, table, layout, wanted)
        parts.append(old.filter(~F.col(BATCH_COL).isin(replaced)) if replaced else old)
    if not parts:
        return spark.createDataFrame([], table.schema)
    return reduce(DataFrame.unionAll, parts)


# -- compaction --------------------------------------------------------------------

def _bytes(spark: SparkSession, path: str) -> int:
    fs, p = filesystem(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def compact(spark: SparkSession, table: BatchTable, file_bytes: int = FILE_BYTES) -> Layout:
    """Folds all live batches into the history; returns the layout that holds.

    Only slots with rows of live batches, or of batches that they replace, are written
    again. Rows are dealt by ranges of (slot, ``folders``, ``order``), so each file holds a
    short range of its slot and a slot of any size is the work of several tasks."""
    root = table.root.rstrip("/")
    old, live = read_layout(spark, root), live_marks(spark, root)
    leftover = [b for b, m in live.items() if b in old.batches and run_of(m) == run_of(old.batches[b])]
    new = {b: m for b, m in live.items() if b not in leftover}
    if not new:
        _sweep(spark, root, old, leftover)
        return old
    slot = table.slot_of().alias(SLOT)
    rows = spark.read.schema(table.schema).parquet(root)
    if leftover:
        rows = rows.filter(~F.col(BATCH_COL).isin(leftover))
    replaced = [b for b in new if b in old.batches]
    with freed_shuffles(spark):
        touched = {r[0] for r in rows.select(slot).distinct().collect()}  # as many as there are slots
        if replaced and old.slots:
            held = _history(spark, table, old, sorted(old.slots)).filter(F.col(BATCH_COL).isin(replaced))
            touched |= {r[0] for r in held.select(slot).distinct().collect()}
    kept = sorted(touched & set(old.slots))
    size = sum(_bytes(spark, table.batch_folder(b)) for b in new)
    if kept:
        before = _history(spark, table, old, kept)
        rows = rows.unionByName(before.filter(~F.col(BATCH_COL).isin(replaced)) if replaced else before)
        size += sum(_bytes(spark, f"{root}/{HISTORY}/{GENERATION}={old.slots[s]}/{SLOT}={s}") for s in kept)
    number = old.number + 1
    generation = f"{number}-{uuid.uuid4().hex[:8]}"
    target = f"{root}/{HISTORY}/{GENERATION}={generation}"
    dealt = (SLOT, *table.folders, *table.order)
    with freed_shuffles(spark):
        (rows.withColumn(SLOT, table.slot_of()).repartitionByRange(max(1, -(-size // file_bytes)), *dealt).sortWithinPartitions(*dealt)
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(SLOT, *table.folders).parquet(target))
    written = {n.split("=", 1)[1] for n, _ in names(spark, target) if n.startswith(f"{SLOT}=")}
    slots = {s: g for s, g in old.slots.items() if s not in touched} | {s: generation for s in written}
    layout = Layout(number, slots, old.batches | new)
    try:
        write_json(spark, f"{root}/{LAYOUT}/{number}.json", {"slots": slots, "batches": layout.batches}, replace=False)
    except Exception as e:  # noqa: BLE001
        delete(spark, target)
        raise CompactionError(f"The table was changed by another compaction: {root}") from e
    _sweep(spark, root, layout, list(new) + leftover)
    return layout


def _history(spark: SparkSession, table: BatchTable, layout: Layout, slots: list[str]) -> DataFrame:
    root = table.root.rstrip("/")
    paths = [f"{root}/{HISTORY}/{GENERATION}={layout.slots[s]}/{SLOT}={s}" for s in slots]
    return (spark.read.schema(table.schema).option("basePath", f"{root}/{HISTORY}").parquet(*paths)
            .select(*table.schema.fieldNames()))


def _sweep(spark: SparkSession, root: str, layout: Layout, folded: list[str]) -> None:
    """Removes what the layout no longer names. A folder is hidden by a rename before its
    files go, so that it is never seen in part."""
    for b in folded:
        fs, folder = filesystem(spark, f"{root}/{BATCH_COL}={b}")
        fs.rename(folder, filesystem(spark, f"{root}/_gone_{b}")[1])
    for name, _ in names(spark, root):
        if name.startswith("_gone_"):
            delete(spark, f"{root}/{name}")
    for gen, _ in names(spark, f"{root}/{HISTORY}"):
        held = {f"{SLOT}={s}" for s, g in layout.slots.items() if f"{GENERATION}={g}" == gen}
        if not held:
            delete(spark, f"{root}/{HISTORY}/{gen}")
            continue
        for name, _ in names(spark, f"{root}/{HISTORY}/{gen}"):
            if name.startswith(f"{SLOT}=") and name not in held:
                delete(spark, f"{root}/{HISTORY}/{gen}/{name}")
    for name, _ in names(spark, f"{root}/{LAYOUT}"):
        if name.removesuffix(".json").isdigit() and int(name.removesuffix(".json")) < layout.number:
            delete(spark, f"{root}/{LAYOUT}/{name}")


def file_count(spark: SparkSession, root: str) -> int:
    """Data files of a table, for reports."""
    fs, p = filesystem(spark, root)
    if not fs.exists(p):
        return 0
    found, files = 0, fs.listFiles(p, True)
    while files.hasNext():
        found += files.next().getPath().getName().endswith(".parquet")
    return found
