"""Staging models over the raw order table (views: functions of a DataFrame).

stg_orders is a row-for-row projection; stg_customers and stg_products are
hash aggregations with map-side partial aggregation, so a customer or a
product with a huge share of the lines is pre-combined in every map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.config import EXCLUDED_STOCK_CODES
from tillflow.functions import is_cancelled, is_sale


def stg_orders(raw: DataFrame) -> DataFrame:
    """Cleaned order lines: flags, decimal measures, day key, blanked ids."""
    qty, price = F.col("quantity"), F.col("unit_price")
    return raw.select(
        F.col("invoice_no"),
        F.col("stock_code"),
        is_cancelled("invoice_no").alias("is_cancelled"),
        F.trim("description").alias("description"),
        # A value that does not fit becomes NULL (the not_null data tests on
        # these columns then report it) instead of failing the whole build.
        qty.try_cast("decimal(10,2)").alias("quantity"),
        price.try_cast("decimal(10,4)").alias("unit_price"),
        (qty * price).try_cast("decimal(12,4)").alias("line_total"),
        F.col("invoice_date").cast("timestamp_ntz").alias("invoice_date"),
        F.to_date("invoice_date").alias("invoice_date_key"),
        F.nullif(F.trim("customer_id"), F.lit("")).alias("customer_id"),
        F.upper(F.trim("country")).alias("country"),
        F.col("batch_id"),
        F.col("ingested_at"),
    )


def customer_filter():
    cid = F.col("customer_id")
    return cid.isNotNull() & (F.trim(cid) != "") & (F.lower(F.trim(cid)) != "nan")


def stg_customers(raw: DataFrame, country_rule: str = "max") -> DataFrame:
    """One row per trimmed customer id.

    country_rule "max" is the lexicographic maximum of the trimmed country
    (what the source model computes); "latest" takes the country of the most
    recent line (what its documentation says)."""
    sale = is_sale("invoice_no", "quantity")
    qty, price = F.col("quantity"), F.col("unit_price")
    if country_rule == "latest":
        country = F.max_by(F.trim("country"), F.struct("invoice_date", "invoice_no"))
    else:
        country = F.max(F.trim("country"))
    return (raw.filter(customer_filter())
            .groupBy(F.trim("customer_id").alias("customer_id"))
            .agg(country.alias("country"),
                 F.min("invoice_date").alias("first_order_date"),
                 F.max("invoice_date").alias("last_order_date"),
                 F.count_distinct(F.when(sale, F.col("invoice_no"))).alias("total_orders"),
                 F.count(F.when(sale, F.lit(1))).alias("total_line_items"),
                 F.sum(F.when(sale, qty).otherwise(F.lit(0))).alias("total_units_purchased"),
                 F.sum(F.when(sale, qty * price).otherwise(F.lit(0))).alias("lifetime_revenue")))


def product_filter():
    sc = F.col("stock_code")
    return (sc.isNotNull() & (F.trim(sc) != "") & (F.trim(sc) != "nan")
            & ~sc.isin(*EXCLUDED_STOCK_CODES))


def stg_products(raw: DataFrame) -> DataFrame:
    """One row per upper-cased, trimmed stock code (service codes excluded,
    compared untrimmed and case-sensitively as in the source model).

    The text maximum (description) is aggregated on its own and joined back
    on the product code: a string buffer would force the whole aggregation,
    including the two distinct counts and their ``Expand``, onto the slower
    sort-based path, while the numeric part runs as a code-generated hash
    aggregation. The join is between two product-level results."""
    sale = is_sale("invoice_no", "quantity")
    price = F.col("unit_price")
    positive = F.when(price > 0, price)
    lines = raw.filter(product_filter()).withColumn("_code", F.upper(F.trim("stock_code")))
    measures = lines.groupBy("_code").agg(
        F.avg(positive).alias("avg_unit_price"),
        F.min(positive).alias("min_unit_price"),
        F.max(price).alias("max_unit_price"),
        F.sum(F.when(sale, F.col("quantity")).otherwise(F.lit(0))).alias("total_units_sold"),
        F.count_distinct("invoice_no").alias("times_ordered"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.min("invoice_date").alias("first_sold_date"),
        F.max("invoice_date").alias("last_sold_date"))
    texts = lines.groupBy("_code").agg(F.nullif(F.max(F.trim("description")), F.lit("nan")).alias("description"))
    return (measures.join(texts, "_code")
            .select(F.col("_code").alias("stock_code"), "description", "avg_unit_price", "min_unit_price",
                    "max_unit_price", "total_units_sold", "times_ordered", "unique_customers",
                    "first_sold_date", "last_sold_date"))
