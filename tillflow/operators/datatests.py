"""Declarative data tests (V1-V10): not_null and unique.

A test returns failing rows: ``not_null`` the rows where the column is NULL,
``unique`` the non-NULL values that occur more than once. It passes when the
count is zero. All tests of one model run in one pass over it (see
``distinct_counts``): null counts and the occurrences of unique values are
combined map-side, so a value repeated a billion times is one row for each task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.operators.distinct_counts import OCCURS, PLAIN, TAG, tagged


class DataTestFailure(Exception):
    pass


@dataclass(frozen=True)
class ModelTests:
    model: str
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()


# ---------------------------------------------------------------------------
# FIXED VALUES: the test declarations of the source project (28 not_null,
# 6 unique), per model and column.
# ---------------------------------------------------------------------------
DECLARED_TESTS = (
    ModelTests("stg_orders", not_null=("invoice_no", "stock_code", "is_cancelled", "quantity",
                                       "unit_price", "line_total", "invoice_date", "country")),
    ModelTests("stg_customers", not_null=("customer_id", "country", "first_order_date",
                                          "last_order_date", "total_orders", "lifetime_revenue"),
               unique=("customer_id",)),
    ModelTests("stg_products", not_null=("stock_code", "total_units_sold", "times_ordered"),
               unique=("stock_code",)),
    ModelTests("dim_date", not_null=("date_id", "full_date"), unique=("date_id",)),
    ModelTests("dim_customers", not_null=("customer_id", "country", "customer_segment"),
               unique=("customer_id",)),
    ModelTests("dim_products", not_null=("stock_code",), unique=("stock_code",)),
    ModelTests("fct_orders", not_null=("order_key", "invoice_no", "date_id", "quantity", "line_total"),
               unique=("order_key",)),
)


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """V1 failing rows."""
    return df.filter(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """V2 failing rows: (value, occurrences) for repeated non-NULL values."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def _result_row(model: str, column: str, test: str, failures):
    return F.struct(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                    F.lit(test).alias("test"), failures.cast("long").alias("failures"))


def not_null_results(df: DataFrame, model: str, columns) -> DataFrame:
    """All not_null tests of a model in one pass, one result row per column."""
    rows = [_result_row(model, c, "not_null", F.count_if(F.col(c).isNull())) for c in columns]
    return df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def run_model_tests(df: DataFrame, spec: ModelTests, unique_df: DataFrame | None = None) -> DataFrame:
    """All tests of a model from one pass over it; unique tests over another frame
    (``unique_df``) read that one too."""
    if unique_df is not None and spec.unique:
        return (run_model_tests(df, ModelTests(spec.model, spec.not_null))
                .unionByName(run_model_tests(unique_df, ModelTests(spec.model, unique=spec.unique))))
    if not spec.unique:
        return not_null_results(df, spec.model, spec.not_null)
    missing = {f"_null_{i}": F.when(F.col(c).isNull(), F.lit(1)).otherwise(F.lit(0)) for i, c in enumerate(spec.not_null)}
    seen = tagged(df, {c: F.col(c) for c in spec.unique}, missing)
    rows = [_result_row(spec.model, c, "not_null", F.coalesce(F.max(F.when(F.col(TAG) == PLAIN, F.col(n))), F.lit(0)))
            for c, n in zip(spec.not_null, missing)]
    rows += [_result_row(spec.model, c, "unique", F.count_if((F.col(TAG) == i + 1) & (F.col(OCCURS) > 1)))
             for i, c in enumerate(spec.unique)]
    return seen.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def test_suite(models: dict[str, DataFrame], specs=DECLARED_TESTS,
               unique_models: dict[str, DataFrame] | None = None) -> DataFrame:
    """One DataFrame (model, column_name, test, failures, passed) for
    every declared test whose model is given. ``unique_models`` optionally
    gives a model a different frame for its unique tests (the batch-scoped
    run uses a time slice there)."""
    unique_models = unique_models or {}
    parts = [run_model_tests(models[s.model], s, unique_models.get(s.model)) for s in specs if s.model in models]
    res = reduce(DataFrame.unionByName, parts)
    return res.withColumn("passed", F.col("failures") == 0)


def assert_suite_passes(results: DataFrame) -> list:
    """Collect the (small, one row per declared test) result and raise on any
    failure, like a test runner's exit status."""
    rows = results.collect()
    failed = [r for r in rows if not r["passed"]]
    if failed:
        desc = ", ".join(f"{r['model']}.{r['column_name']}:{r['test']}={r['failures']}" for r in failed)
        raise DataTestFailure(f"{len(failed)} data test(s) failed: {desc}")
    return rows
