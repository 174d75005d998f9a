"""unique(order_key) over all history without reading all of it.

An order key holds its line's time, so keys can only repeat within a month. The state
keeps for every batch its keys with their month, and for every month the keys that occur
more than once. An update reads the lines of new batches and then the keys of the months
that they, or batches that were replaced or removed, have lines in; only these months'
repeated keys are written again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.plans import marts, staging
from tillflow.plans.batch_state import BatchState
from tillflow.sinks import history
from tillflow.sinks.history import BATCH_COL, MARKS_FILE, BatchTable
from tillflow.sinks.tables import read_raw_orders

#: Batch folders before they are folded into the history of the keys.
FOLD_AFTER = 50
KEYS = T.StructType([T.StructField("order_key", T.StringType()), T.StructField("n", T.LongType()),
                     T.StructField("month", T.StringType()), T.StructField(BATCH_COL, T.StringType())])
REPEATED = T.StructType([T.StructField("order_key", T.StringType()), T.StructField("n_records", T.LongType()),
                         T.StructField("month", T.StringType())])


class KeyState(BatchState):
    def __init__(self, spark: SparkSession, path: str, lines: str):
        super().__init__(spark, path, lines)
        self.table = BatchTable(f"{self.path}/keys", KEYS, lambda: F.col("month"), ("order_key",))

    def update(self) -> dict[str, int]:
        """Brings the repeated keys up to the published batches; returns how many batches
        were read from their lines and how many months were counted again."""
        published, new, gone = self.changes()
        number, held = self.manifest()
        if not new and not gone and number >= 0:
            return {"batches_read": 0, "months": 0}
        # months that lose rows first: the old rows of batches that are replaced or gone
        before = [b for b in (*new, *gone) if b in held]
        months = self._months(before)
        if new:
            fct = marts.fct_orders(staging.stg_orders(read_raw_orders(self.spark, self.lines).filter(F.col(BATCH_COL).isin(new))))
            rows = (fct.filter(F.col("order_key").isNotNull())
                    .groupBy(BATCH_COL, "order_key", F.date_format("invoice_date", "yyyy-MM").alias("month"))
                    .agg(F.count(F.lit(1)).alias("n")))
            for b in new:
                history.delete(self.spark, self.table.batch_folder(b))
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COL).parquet(self.table.root))
        for b in (*new, *gone):
            folder = self.table.batch_folder(b)
            if b in gone:
                history.delete(self.spark, folder)
            history.write_json(self.spark, f"{folder}/{MARKS_FILE}", {"run": published.get(b, "gone")})
        months |= self._months(new)
        self._count_again(months)
        self.store(number + 1, published)
        if len(history.live_marks(self.spark, self.table.root)) >= FOLD_AFTER:
            history.compact(self.spark, self.table)
        return {"batches_read": len(new), "months": len(months)}

    def _months(self, batches: list[str]) -> set[str]:
        """As many as there are months."""
        if not batches:
            return set()
        rows = history.read(self.spark, self.table).filter(F.col(BATCH_COL).isin(batches))
        return {r[0] for r in rows.select("month").distinct().collect()}

    def _count_again(self, months: set[str]) -> None:
        if not months:
            return
        rows = history.read(self.spark, self.table, (min(months), max(months))).filter(F.col("month").isin(sorted(months)))
        repeated = rows.groupBy("month", "order_key").agg(F.sum("n").alias("n_records")).filter(F.col("n_records") > 1)
        for m in months:    # a month without repeated keys gets no folder
            history.delete(self.spark, f"{self.path}/repeated/month={m}")
        (repeated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month")
         .parquet(f"{self.path}/repeated"))

    def repeated(self) -> DataFrame:
        """``order_key, n_records`` of every key that occurs more than once."""
        if not history.names(self.spark, f"{self.path}/repeated"):
            return self.spark.createDataFrame([], REPEATED).select("order_key", "n_records")
        return self.spark.read.schema(REPEATED).parquet(f"{self.path}/repeated").select("order_key", "n_records")

    def as_lines(self) -> DataFrame:
        """Each repeated key twice: a frame that fails a unique test as all lines do."""
        return self.repeated().select(F.explode(F.array_repeat("order_key", 2)).alias("order_key"))
