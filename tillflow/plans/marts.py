"""Star-schema marts: fct_orders, dim_customers, dim_products, dim_date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.config import (
    DATE_SPINE_DAYS,
    DATE_SPINE_START,
    SEGMENT_DEFAULT,
    SEGMENT_LOYAL,
    SEGMENT_REGULAR,
    SEGMENT_VIP,
    STATUS_ACTIVE,
    STATUS_DEFAULT,
    STATUS_WARM,
    TIER_BESTSELLER,
    TIER_DEFAULT,
    TIER_POPULAR,
    TIER_REGULAR,
    YEAR_MONTH_FORMAT,
)
from tillflow.functions import date_key, order_key


def fct_orders(stg: DataFrame) -> DataFrame:
    """One row per order line, keyed by an MD5 surrogate."""
    lt = F.col("line_total")
    return stg.select(
        order_key("invoice_no", "stock_code", "invoice_date").alias("order_key"),
        "invoice_no",
        "stock_code",
        "customer_id",
        date_key("invoice_date").alias("date_id"),
        "is_cancelled",
        "invoice_date",
        "quantity",
        "unit_price",
        F.round(lt, 2).alias("line_total"),
        F.when(F.col("is_cancelled"), F.abs(lt) * F.lit(-1)).otherwise(lt).alias("net_line_total"),
        "country",
        "batch_id",
        "ingested_at",
    )


def _as_of_col(as_of: dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def customer_segment(revenue: Column, orders: Column) -> Column:
    vip, vip_rev, vip_orders = SEGMENT_VIP
    loyal, loyal_orders = SEGMENT_LOYAL
    regular, regular_orders = SEGMENT_REGULAR
    return (F.when((revenue >= vip_rev) & (orders >= vip_orders), F.lit(vip))
            .when(orders >= loyal_orders, F.lit(loyal))
            .when(orders >= regular_orders, F.lit(regular))
            .otherwise(F.lit(SEGMENT_DEFAULT)))


def customer_status(days_since: Column) -> Column:
    active, active_days = STATUS_ACTIVE
    warm, warm_days = STATUS_WARM
    return (F.when(days_since <= active_days, F.lit(active))
            .when(days_since <= warm_days, F.lit(warm))
            .otherwise(F.lit(STATUS_DEFAULT)))


def dim_customers(stg: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Customer dimension. ``as_of`` is the reporting day (default: today).
    Segments use the unrounded revenue; the stored revenue is rounded."""
    rev, orders = F.col("lifetime_revenue"), F.col("total_orders")
    days_since = F.datediff(_as_of_col(as_of), F.to_date("last_order_date"))
    return (stg.withColumn("_days_since", days_since)
            .select(
                "customer_id", "country", "first_order_date", "last_order_date",
                "total_orders", "total_line_items", "total_units_purchased",
                F.round(rev, 2).alias("lifetime_revenue"),
                F.round(rev / F.nullif(orders, F.lit(0)).cast("decimal(20,0)"), 2).alias("avg_order_value"),
                F.col("_days_since").alias("days_since_last_order"),
                F.datediff(F.to_date("last_order_date"), F.to_date("first_order_date")).alias("customer_lifetime_days"),
                customer_segment(rev, orders).alias("customer_segment"),
                customer_status(F.col("_days_since")).alias("customer_status"),
            ))


def product_tier(units: Column) -> Column:
    best, best_n = TIER_BESTSELLER
    pop, pop_n = TIER_POPULAR
    reg, reg_n = TIER_REGULAR
    return (F.when(units >= best_n, F.lit(best))
            .when(units >= pop_n, F.lit(pop))
            .when(units >= reg_n, F.lit(reg))
            .otherwise(F.lit(TIER_DEFAULT)))


def dim_products(stg: DataFrame) -> DataFrame:
    return stg.select(
        "stock_code", "description",
        F.round("avg_unit_price", 2).alias("avg_unit_price"),
        F.round("min_unit_price", 2).alias("min_unit_price"),
        F.round("max_unit_price", 2).alias("max_unit_price"),
        "total_units_sold", "times_ordered", "unique_customers",
        "first_sold_date", "last_sold_date",
        product_tier(F.col("total_units_sold")).alias("product_tier"),
    )


def date_spine(spark: SparkSession, start: dt.date = DATE_SPINE_START, days: int = DATE_SPINE_DAYS) -> DataFrame:
    """``days`` consecutive dates from ``start``, gap-free. The row count is a
    parameter, so its size is known when the plan is built."""
    end = start + dt.timedelta(days=days - 1)
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias("full_date"))


def date_spine_covering(orders: DataFrame, ts_col: str = "invoice_date") -> DataFrame:
    """Every day of the whole calendar years that the order dates touch.
    min / max combine map-side; the one-row result expands to at most one row
    per day of the covered years."""
    bounds = orders.agg(F.trunc(F.min(ts_col), "year").alias("lo"),
                        F.trunc(F.max(ts_col), "year").alias("hi"))
    end = F.date_sub(F.add_months("hi", 12), 1)
    return bounds.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", end, F.expr("INTERVAL 1 DAY"))).alias("full_date"))


def calendar_attributes(spine: DataFrame) -> DataFrame:
    d = F.col("full_date")
    dow = F.dayofweek(d) - 1  # Sunday = 0 ... Saturday = 6
    return spine.select(
        date_key(d).alias("date_id"),
        d.alias("full_date"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week_number"),
        F.dayname(d).alias("day_of_week_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        F.monthname(d).alias("month_name"),
        F.quarter(d).alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.year(d).alias("year"),
        dow.isin(0, 6).alias("is_weekend"),
        F.date_format(d, YEAR_MONTH_FORMAT).alias("year_month"),
    )


def dim_date(spark: SparkSession, start: dt.date = DATE_SPINE_START, days: int = DATE_SPINE_DAYS) -> DataFrame:
    """Calendar dimension over a parameterised spine (default 2009-01-01,
    1,461 days)."""
    return calendar_attributes(date_spine(spark, start, days))


def dim_date_covering(orders: DataFrame, ts_col: str = "invoice_date") -> DataFrame:
    """Calendar dimension over the years present in ``orders``."""
    return calendar_attributes(date_spine_covering(orders, ts_col))
