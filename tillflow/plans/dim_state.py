"""Customer and product dimensions from new batches and a state, without the old lines.

The staging aggregates mix sums, minima and maxima, which merge, with distinct counts,
which do not. So the state holds for every batch

* ``customers`` / ``products``: one row for each key with what merges;
* ``customer_invoices``, ``product_invoices``, ``product_customers``: the distinct pairs
  behind the distinct counts;

and, for all batches together, ``totals``: the merged rows with the distinct counts. An
update reads the lines of new batches only. A pair counts when no earlier batch holds it
(one anti-join of the batch's pairs with the stored ones), then old totals, the batch's
rows and the new pair counts are folded by key in one shuffle.

When a batch was replaced or is gone, its minima and maxima cannot be taken back from the
totals; the totals are then folded again from the state of all batches. Lines of other
batches are not read for that either.

The totals name the batches, and the write of each batch, that they hold. A cut-off update
leaves the old totals in place; the next one does its work again.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions import is_sale
from tillflow.plans import staging
from tillflow.plans.batch_state import BatchState
from tillflow.sinks import history
from tillflow.sinks.history import BATCH_COL, MARKS_FILE, BatchTable
from tillflow.sinks.tables import read_raw_orders

#: Slots of the state's history, by hash of the key.
BUCKETS = 32
#: Batch folders of a state table before they are folded into its history.
FOLD_AFTER = 50




def _customer_lines(raw: DataFrame) -> DataFrame:
    return raw.filter(staging.customer_filter()).withColumn("key", F.trim("customer_id"))


def _product_lines(raw: DataFrame) -> DataFrame:
    return raw.filter(staging.product_filter()).withColumn("key", F.upper(F.trim("stock_code")))


def _customer_rows(raw: DataFrame, *by: str) -> DataFrame:
    sale, qty, price = is_sale("invoice_no", "quantity"), F.col("quantity"), F.col("unit_price")
    return _customer_lines(raw).groupBy(*by, "key").agg(
        F.max(F.trim("country")).alias("country"),
        F.max(F.struct("invoice_date", "invoice_no", F.trim("country").alias("country"))).alias("latest"),
        F.min("invoice_date").alias("first_date"), F.max("invoice_date").alias("last_date"),
        F.count(F.when(sale, F.lit(1))).alias("items"),
        F.sum(F.when(sale, qty).otherwise(F.lit(0))).alias("units"),
        F.sum(F.when(sale, qty * price).otherwise(F.lit(0))).alias("revenue"))


def _product_rows(raw: DataFrame, *by: str) -> DataFrame:
    sale, price = is_sale("invoice_no", "quantity"), F.col("unit_price")
    positive = F.when(price > 0, price)
    return _product_lines(raw).groupBy(*by, "key").agg(
        F.max(F.trim("description")).alias("description"),
        F.sum(positive).alias("price_sum"), F.count(positive).alias("prices"),
        F.min(positive).alias("least"), F.max(price).alias("most"),
        F.sum(F.when(sale, F.col("quantity")).otherwise(F.lit(0))).alias("units"),
        F.min("invoice_date").alias("first_date"), F.max("invoice_date").alias("last_date"))


def _pairs(lines: DataFrame, value: Column, *by: str) -> DataFrame:
    return lines.select(*by, "key", value.alias("value")).filter(F.col("value").isNotNull()).distinct()


def _customer_invoices(raw: DataFrame, *by: str) -> DataFrame:
    return _pairs(_customer_lines(raw), F.when(is_sale("invoice_no", "quantity"), F.col("invoice_no")), *by)


def _product_invoices(raw: DataFrame, *by: str) -> DataFrame:
    return _pairs(_product_lines(raw), F.col("invoice_no"), *by)


def _product_customers(raw: DataFrame, *by: str) -> DataFrame:
    return _pairs(_product_lines(raw), F.col("customer_id"), *by)


@dataclass(frozen=True)
class Dimension:
    """``rows`` merge by ``merge`` (how each of their columns folds); each count is the
    number of distinct pairs of a table."""
    name: str
    rows: object
    merge: dict[str, object]
    counts: dict[str, tuple[str, object]]


CUSTOMERS = Dimension("customers", _customer_rows,
                      {"country": F.max, "latest": F.max, "first_date": F.min, "last_date": F.max, "items": F.sum,
                       "units": F.sum, "revenue": F.sum},
                      {"orders": ("customer_invoices", _customer_invoices)})
PRODUCTS = Dimension("products", _product_rows,
                     {"description": F.max, "price_sum": F.sum, "prices": F.sum, "least": F.min, "most": F.max, "units": F.sum,
                      "first_date": F.min, "last_date": F.max},
                     {"invoices": ("product_invoices", _product_invoices),
                      "customers": ("product_customers", _product_customers)})
DIMENSIONS = (CUSTOMERS, PRODUCTS)


class DimensionState(BatchState):
    """State of the two dimensions below ``path`` for the order lines at ``lines``."""

    @cached_property
    def _raw(self) -> DataFrame:
        return read_raw_orders(self.spark, self.lines).limit(0)

    @cached_property
    def schemas(self) -> dict[str, T.StructType]:
        out = {d.name: d.rows(self._raw, BATCH_COL).schema for d in DIMENSIONS}
        return out | {table: pairs(self._raw, BATCH_COL).schema for d in DIMENSIONS for table, pairs in d.counts.values()}

    @cached_property
    def staged(self) -> dict[str, T.StructType]:
        return {"customers": staging.stg_customers(self._raw).schema, "products": staging.stg_products(self._raw).schema}

    def table(self, name: str) -> BatchTable:
        fields = [f for f in self.schemas[name].fields if f.name != BATCH_COL] + [T.StructField(BATCH_COL, T.StringType())]
        order = ("key", "value") if "value" in self.schemas[name].fieldNames() else ("key",)
        return BatchTable(f"{self.path}/{name}", T.StructType(fields),
                          lambda: F.lpad(F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("string"), 3, "0"), order)

    def _totals(self, number: int, d: Dimension) -> DataFrame:
        kept = [f for f in self.schemas[d.name].fields if f.name != BATCH_COL]
        schema = T.StructType(kept + [T.StructField(c, T.LongType()) for c in d.counts])
        return self.spark.read.schema(schema).parquet(f"{self.path}/totals/{d.name}-{number}")

    # -- update --------------------------------------------------------------------

    def update(self) -> dict[str, int]:
        """Brings the totals up to the published batches. Returns how many batches were
        read from their lines, and whether the totals were folded anew."""
        published, new, gone = self.changes()
        number, held = self.manifest()
        if not new and not gone and number >= 0:
            return {"batches_read": 0, "folded_anew": 0}
        anew = bool(gone) or any(b in held for b in new)
        if new:
            self._write_batches({b: published[b] for b in new})
        for b in gone:
            for name in self.schemas:
                self._forget(name, b)
        self._together([lambda d=d: self._fold(d, list(published) if anew else new, list(held), number, anew) for d in DIMENSIONS])
        self.store(number + 1, published)
        for name, _ in history.names(self.spark, f"{self.path}/totals"):
            if name.rpartition("-")[2].isdigit() and int(name.rpartition("-")[2]) <= number:
                history.delete(self.spark, f"{self.path}/totals/{name}")
        self._compact()
        return {"batches_read": len(new), "folded_anew": int(anew)}

    def _write_batches(self, runs: dict[str, str]) -> None:
        """Rows and pairs of the batches, each in a folder of its own."""
        raw = read_raw_orders(self.spark, self.lines).filter(F.col(BATCH_COL).isin(list(runs)))
        made = {d.name: d.rows for d in DIMENSIONS} | {t: p for d in DIMENSIONS for t, p in d.counts.values()}

        def write(name, make):
            table = self.table(name)
            for b in runs:  # a batch that has no such rows still replaces its older ones
                history.delete(self.spark, table.batch_folder(b))
            # as the aggregation leaves the rows; dealing them out by key again makes no fewer files
            (make(raw, BATCH_COL).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(BATCH_COL).parquet(table.root))
            for b, run in runs.items():
                history.write_json(self.spark, f"{table.batch_folder(b)}/{MARKS_FILE}", {"run": run})

        self._together([lambda name=name, make=make: write(name, make) for name, make in made.items()])

    @staticmethod
    def _together(jobs: list) -> None:
        """Runs jobs that do not read each other's output at once: the tasks of one fill the
        cores that the last tasks of another leave idle."""
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            for f in [pool.submit(job) for job in jobs]:
                f.result()

    def _forget(self, name: str, batch_id: str) -> None:
        """A batch that is gone has no rows any more, live or in the state's history."""
        folder = self.table(name).batch_folder(batch_id)
        history.delete(self.spark, folder)
        history.write_json(self.spark, f"{folder}/{MARKS_FILE}", {"run": "gone"})

    def _rows(self, name: str, batches: list[str]) -> DataFrame:
        return history.read(self.spark, self.table(name)).filter(F.col(BATCH_COL).isin(batches))

    def _fold(self, d: Dimension, batches: list[str], before: list[str], number: int, anew: bool) -> None:
        """Writes the totals ``number + 1``: of ``batches`` alone if ``anew``, else with the
        old totals."""
        measures, counts = list(d.merge), list(d.counts)
        types = {f.name: f.dataType for f in self.schemas[d.name].fields}
        none = {c: F.lit(None).cast(types[c]) for c in measures} | {c: F.lit(0).cast("long") for c in counts}

        def shaped(df: DataFrame, **given: Column) -> DataFrame:
            return df.select("key", *[given.get(c, none[c]).alias(c) for c in (*measures, *counts)])

        parts = [shaped(self._rows(d.name, batches), **{c: F.col(c) for c in measures})]
        if not anew and number >= 0:
            parts.append(shaped(self._totals(number, d), **{c: F.col(c) for c in (*measures, *counts)}))
        for c, (name, _) in d.counts.items():
            pairs = self._rows(name, batches).select("key", "value")
            if len(batches) > 1:        # of one batch they are distinct as stored
                pairs = pairs.distinct()
            if not anew and before:
                pairs = pairs.join(self._rows(name, before).select("key", "value"), ["key", "value"], "left_anti")
            parts.append(shaped(pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n")), **{c: F.col("n")}))
        folded = reduce(DataFrame.unionAll, parts).groupBy("key").agg(
            *[how(c).cast(types[c]).alias(c) for c, how in d.merge.items()], *[F.sum(c).alias(c) for c in counts])
        folded.write.mode("overwrite").parquet(f"{self.path}/totals/{d.name}-{number + 1}")

    def _compact(self) -> None:
        for name in self.schemas:
            table = self.table(name)
            if len(history.live_marks(self.spark, table.root)) >= FOLD_AFTER:
                history.compact(self.spark, table)

    # -- staging models from the totals ----------------------------------------------

    def stg_customers(self, country_rule: str = "max") -> DataFrame:
        """``staging.stg_customers`` of all batches that the totals hold."""
        t = self._totals(self.manifest()[0], CUSTOMERS)
        country = F.col("latest.country") if country_rule == "latest" else F.col("country")
        return self._as_staged(t, "customers", {
            "customer_id": F.col("key"), "country": country, "first_order_date": F.col("first_date"),
            "last_order_date": F.col("last_date"), "total_orders": F.col("orders"), "total_line_items": F.col("items"),
            "total_units_purchased": F.col("units"), "lifetime_revenue": F.col("revenue")})

    def stg_products(self) -> DataFrame:
        """``staging.stg_products`` of all batches that the totals hold."""
        t = self._totals(self.manifest()[0], PRODUCTS)
        return self._as_staged(t, "products", {
            "stock_code": F.col("key"), "description": F.nullif(F.col("description"), F.lit("nan")),
            "avg_unit_price": F.when(F.col("prices") > 0, F.col("price_sum") / F.col("prices").cast("decimal(20,0)")),
            "min_unit_price": F.col("least"), "max_unit_price": F.col("most"), "total_units_sold": F.col("units"),
            "times_ordered": F.col("invoices"), "unique_customers": F.col("customers"),
            "first_sold_date": F.col("first_date"), "last_sold_date": F.col("last_date")})

    def _as_staged(self, totals: DataFrame, name: str, columns: dict[str, Column]) -> DataFrame:
        return totals.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in self.staged[name].fields])
