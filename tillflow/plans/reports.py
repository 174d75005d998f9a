"""Star joins (J3-J5) and the dashboard queries.

Scale notes. Facts are pre-aggregated on the join key before they meet a
dimension wherever the report only needs totals, so the join sees at most one
row per key instead of one per order line, and a hot key (guest orders with a
NULL customer, a best-selling product) is combined map-side. No broadcast is
forced on a dimension that grows with the data: Catalyst's size statistics
and AQE's runtime sizes pick broadcast or sort-merge, also for the calendar. Shares of a
total use a window over the already grouped result, whose size is the number
of groups (segments, countries), not the number of lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.operators.distinct_counts import distinct_counts
from tillflow.operators.spread_join import left_join_spread
from tillflow.plans.staging import product_filter


def _share(value_col: str, out: str = "share_pct"):
    """Percentage of the total; NULL when the total is zero (for example when
    every sale was cancelled)."""
    total = F.sum(F.col(value_col)).over(Window.partitionBy())
    return (F.col(value_col).cast("double") * F.lit(100.0)
            / F.nullif(total.cast("double"), F.lit(0.0))).alias(out)


# -- star joins --------------------------------------------------------------

def star_orders_customers(fct: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Every fact line with its customer's segment and status; guests
    (NULL id) and ids without a dimension row keep NULL attributes."""
    dim = dim_customers.select("customer_id", "customer_segment", "customer_status",
                               F.col("country").alias("customer_country"))
    return left_join_spread(fct.select("order_key", "customer_id", "net_line_total"), dim, "customer_id")


def star_orders_products(fct: DataFrame, dim_products: DataFrame) -> DataFrame:
    """The fact holds the raw stock code, the dimension the upper-cased,
    trimmed one; join on the normalised code."""
    dim = dim_products.select(F.col("stock_code").alias("product_code"), "product_tier",
                              F.col("description").alias("product_description"))
    f = fct.select("order_key", "stock_code", "quantity",
                   F.upper(F.trim("stock_code")).alias("product_code"))
    return left_join_spread(f, dim, "product_code")


def star_orders_dates(fct: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact lines with their calendar attributes (left join: lines
    outside the calendar keep NULLs)."""
    dim = dim_date.select("date_id", "year_month", "quarter_name", "day_of_week_name", "is_weekend")
    return fct.select("order_key", "date_id", "net_line_total").join(dim, "date_id", "left")


# -- dashboard queries ---------------------------------------------------------

def kpi_headline(fct: DataFrame, dim_customers: DataFrame | None = None,
                 dim_products: DataFrame | None = None) -> DataFrame:
    """B1: revenue, customers, invoices, products, countries and lines.

    Customers and products are counted as the staging models define them:
    the rows of the dimensions when given, else the valid trimmed ids and the
    normalised product codes of the fact. The fact is read once: its sums and all its
    distinct counts come from one pass (``distinct_counts``)."""
    cid = F.col("customer_id")
    counted = {"total_invoices": F.col("invoice_no"), "total_countries": F.col("country")}
    if dim_customers is None:
        counted["total_customers"] = F.when(cid.isNotNull() & (F.lower(cid) != "nan"), cid)
    if dim_products is None:
        counted["total_products"] = F.when(product_filter(), F.upper(F.trim("stock_code")))
    row = distinct_counts(fct, counted, {"total_revenue": F.col("net_line_total")}, rows="total_lines")
    for name, dim in (("total_customers", dim_customers), ("total_products", dim_products)):
        if dim is not None:
            row = row.crossJoin(dim.agg(F.count(F.lit(1)).alias(name)))     # one row each
    return row.select(F.col("total_revenue").cast("decimal(28,4)").alias("total_revenue"), "total_customers",
                      "total_invoices", "total_products", "total_countries", "total_lines")


def revenue_by_month(fct: DataFrame, dim_date: DataFrame) -> DataFrame:
    """B2: revenue and lines per calendar month. Facts are summed per day
    first, so the join sees one row per day."""
    daily = fct.groupBy("date_id").agg(F.sum("net_line_total").alias("revenue"),
                                       F.count(F.lit(1)).alias("lines"))
    dim = dim_date.select("date_id", "year_month")
    return (daily.join(dim, "date_id")
            .groupBy("year_month")
            .agg(F.sum("revenue").alias("revenue"), F.sum("lines").alias("lines")))


def peak_month(monthly: DataFrame, n: int = 1) -> DataFrame:
    """B2 peak: top-n months by revenue (ties broken by month)."""
    return monthly.orderBy(F.desc("revenue"), F.asc("year_month")).limit(n)


def segment_distribution(dim_customers: DataFrame) -> DataFrame:
    """Customers per segment and their share."""
    return (dim_customers.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customers"))
            .select("customer_segment", "customers", _share("customers")))


def revenue_by_country(fct: DataFrame) -> DataFrame:
    """Revenue per country and share of the total."""
    return (fct.groupBy("country").agg(F.sum("net_line_total").alias("revenue"))
            .select("country", "revenue", _share("revenue")))


def top_products(dim_products: DataFrame, n: int = 10, measure: str = "total_units_sold") -> DataFrame:
    """Top-n products by a measure, ties by code (TakeOrderedAndProject:
    each task keeps n rows, the driver merges n per task)."""
    return dim_products.orderBy(F.desc(measure), F.asc("stock_code")).limit(n)


def revenue_by_segment(fct: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Revenue per customer segment and its share. Lines are summed per
    customer before the join (guest lines form one NULL-key group that is
    combined map-side); customers outside the dimension form the NULL
    segment."""
    per_customer = fct.groupBy("customer_id").agg(F.sum("net_line_total").alias("revenue"))
    dim = dim_customers.select("customer_id", "customer_segment")
    return (per_customer.join(dim, "customer_id", "left")
            .groupBy("customer_segment").agg(F.sum("revenue").alias("revenue"))
            .select("customer_segment", "revenue", _share("revenue")))


def quarantine_breakdown(rejected: DataFrame) -> DataFrame:
    """Rejected rows per failed rule (a row with two failures counts
    under both)."""
    return (rejected.select(F.explode(F.split("error_reason", "; ")).alias("reason"))
            .filter(F.col("reason") != "")
            .groupBy("reason").agg(F.count(F.lit(1)).alias("rejected_rows")))
