"""Token counts kept as delta-maintained rollups.

A batch of changes (inserts, deletes, revised counts) becomes signed rows; their sums
by source, language and tokenizer version are one delta. A delta is committed once
under its batch id: a repeated commit changes nothing, and one that was cut off can be
sent again. Totals are the sums of the committed deltas, whoever committed them.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.sinks import history
from tillflow.sinks.history import BATCH_COL, MARKS_FILE, BatchTable

from .frames import ship

KEYS = ["source", "lang", "version"]
SUMS = ["documents", "tokens", "chars"]


def count_tokens(docs: DataFrame, vocabulary: str, pattern: str, version: str) -> DataFrame:
    """``doc_id, source, lang, version, tokens, chars`` of every row under a byte-level
    BPE vocabulary of ranks. The file is read on the driver (under 2 MB) and shared.

    Null text: 0 tokens, 0 characters. Whole texts; special tokens are plain text. Every
    row counts, also one that repeats another or has no id; null sources and languages are
    groups of their own. Empty table: empty result. Other columns are not read."""
    ship(docs.sparkSession)
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast((f.read(), pattern))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        data, pat = shared.value
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        encoding = tiktoken.Encoding("counted", pat_str=pat, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            own = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "source", "lang")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array([len(encoding.encode_ordinary(t)) if t else 0 for t in texts], pa.int64()),
                 pa.array([len(t or "") for t in texts], pa.int64())], ["doc_id", "source", "lang", "tokens", "chars"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "source", "lang", "text").mapInArrow(
        counted, f"doc_id {kind}, source string, lang string, tokens long, chars long")
    return out.withColumn("version", F.lit(version))


def signed(counts: DataFrame, sign: int) -> DataFrame:
    """Counts as inserts (1) or deletes (-1)."""
    return counts.select(*KEYS, F.lit(sign).cast("long").alias("documents"),
                         (F.col("tokens") * sign).alias("tokens"), (F.col("chars") * sign).alias("chars"))


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    """Counts that replace others: the old ones taken away, the new ones added."""
    return signed(before, -1).unionByName(signed(after, 1))


class Rollup:
    """Committed deltas in a folder that all executors share. The folder is all the state
    there is: a rollup that is opened again has the same batches and totals."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        kinds = [*[T.StructField(c, T.StringType()) for c in KEYS], *[T.StructField(c, T.LongType()) for c in SUMS]]
        self.table = BatchTable(path.rstrip("/"), T.StructType([*kinds, T.StructField(BATCH_COL, T.StringType())]),
                                lambda: F.lit("all"), tuple(KEYS))

    def batches(self) -> list[str]:
        return sorted(history.batches(self.spark, self.table.root))

    def committed(self, batch: str) -> bool:
        return history.marks_of(self.spark, self.table.root, batch) is not None

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds a batch of signed rows; False where it has been committed before.

        The delta is written beside the table and renamed into it whole: a commit that is
        cut off leaves nothing that counts, and of two writers of one batch one is told
        False."""
        if self.committed(batch):
            return False
        aside = f"{self.table.root}/_incoming_{uuid.uuid4().hex}"
        changes.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).write.parquet(aside)
        history.write_json(self.spark, f"{aside}/{MARKS_FILE}", {"run": uuid.uuid4().hex})
        fs, source = history.filesystem(self.spark, aside)
        _, target = history.filesystem(self.spark, self.table.batch_folder(batch))
        if fs.exists(target) or not fs.rename(source, target):
            history.delete(self.spark, aside)
            return False
        return True

    def compact(self) -> None:
        """Folds the batches' files together; they stay committed."""
        history.compact(self.spark, self.table)

    def totals(self) -> DataFrame:
        """Sums by source, language and version; groups that came down to nothing go. No
        batch: empty."""
        return (history.read(self.spark, self.table).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
                .where((F.col("documents") != 0) | (F.col("tokens") != 0) | (F.col("chars") != 0)))
