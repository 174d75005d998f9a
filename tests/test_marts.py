"""Model semantics on hand-made raw rows: segments, tiers, status, calendar."""

import datetime as dt
from decimal import Decimal

from tillflow.operators.datatests import not_null_failures, unique_failures
from tillflow.operators.datatests import test_suite as run_suite
from tillflow.plans import marts, staging
from tillflow.plans.catalog import ModelParams, Models
from tillflow.sinks.tables import RAW_SCHEMA


def _raw(spark, rows):
    full = []
    for inv, stock, qty, ts, price, cid in rows:
        full.append((inv, stock, "d", Decimal(str(qty)), ts, Decimal(str(price)), cid, "UK", "b", dt.datetime(2020, 1, 1)))
    return spark.createDataFrame(full, RAW_SCHEMA)


def test_customer_segments_and_status(spark):
    day = dt.datetime(2011, 1, 1)
    rows = []
    # c_vip: 50 invoices, revenue 10,000 exactly
    rows += [(f"V{i}", "A", 1, day, 200, "c_vip") for i in range(50)]
    # c_loyal: 20 invoices; c_reg: 5; c_new: 4 (+ cancellations do not count)
    rows += [(f"L{i}", "A", 1, day, 1, "c_loyal") for i in range(20)]
    rows += [(f"R{i}", "A", 1, day, 1, "c_reg") for i in range(5)]
    rows += [(f"N{i}", "A", 1, day, 1, "c_new") for i in range(4)]
    rows += [("C9", "A", -1, day, 1, "c_new")]
    # only cancellations: no orders, avg_order_value NULL
    rows += [("C7", "A", -2, day, 3, "c_cancel")]
    dim = marts.dim_customers(staging.stg_customers(_raw(spark, rows)), as_of=dt.date(2011, 1, 31))
    got = {r.customer_id: r for r in dim.collect()}
    assert got["c_vip"].customer_segment == "VIP"
    assert got["c_loyal"].customer_segment == "LOYAL"
    assert got["c_reg"].customer_segment == "REGULAR"
    assert got["c_new"].customer_segment == "NEW" and got["c_new"].total_orders == 4
    assert got["c_cancel"].avg_order_value is None and got["c_cancel"].total_orders == 0
    assert got["c_vip"].avg_order_value == Decimal("200.00")
    assert got["c_vip"].days_since_last_order == 30 and got["c_vip"].customer_status == "ACTIVE"
    dim2 = marts.dim_customers(staging.stg_customers(_raw(spark, rows)), as_of=dt.date(2011, 2, 1))
    assert {r.customer_status for r in dim2.collect()} == {"WARM"}
    # 90 days since the last order is still WARM, 91 is CHURN_RISK
    dim90 = marts.dim_customers(staging.stg_customers(_raw(spark, rows)), as_of=dt.date(2011, 4, 1))
    dim91 = marts.dim_customers(staging.stg_customers(_raw(spark, rows)), as_of=dt.date(2011, 4, 2))
    assert {r.customer_status for r in dim90.collect()} == {"WARM"}
    assert {r.customer_status for r in dim91.collect()} == {"CHURN_RISK"}


def test_revenue_just_below_vip(spark):
    day = dt.datetime(2011, 1, 1)
    rows = [(f"V{i}", "A", 1, day, 200, "c") for i in range(49)] + [("V49", "A", 1, day, "199.99", "c")]
    dim = marts.dim_customers(staging.stg_customers(_raw(spark, rows)), as_of=dt.date(2011, 1, 2))
    assert dim.first().customer_segment == "LOYAL"


def test_product_tiers_and_exclusions(spark):
    day = dt.datetime(2011, 1, 1)
    rows = [("1", "BEST", 10000, day, 1, "c"), ("2", "POP", 999, day, 1, "c"), ("3", "POP", 1, day, 1, "c"),
            ("4", "REG", 100, day, 1, "c"), ("5", "SLOW", 99, day, 1, "c"),
            ("6", "POST", 5, day, 1, "c"), ("7", "post", 5, day, 1, "c"), ("8", "nan", 1, day, 1, "c"),
            ("C9", "SLOW", -5, day, 0, "c")]
    dim = {r.stock_code: r for r in marts.dim_products(staging.stg_products(_raw(spark, rows))).collect()}
    assert dim["BEST"].product_tier == "BESTSELLER"
    assert dim["POP"].product_tier == "POPULAR" and dim["POP"].times_ordered == 2
    assert dim["REG"].product_tier == "REGULAR" and dim["SLOW"].product_tier == "SLOW_MOVER"
    assert "POST" in dim and dim["POST"].total_units_sold == 5   # 'post' passes, grouped as POST
    assert "NAN" not in dim and "nan" not in dim
    assert dim["SLOW"].min_unit_price == Decimal("1.00")         # zero price ignored
    assert dim["SLOW"].max_unit_price == Decimal("1.00")


def test_calendar(spark):
    d = {r.full_date: r for r in marts.dim_date(spark).collect()}
    assert len(d) == 1461
    assert min(d) == dt.date(2009, 1, 1) and max(d) == dt.date(2012, 12, 31)
    r = d[dt.date(2010, 1, 1)]
    assert (r.date_id, r.week_of_year, r.day_of_week_name, r.day_of_week_number) == (20100101, 53, "Fri", 5)
    assert d[dt.date(2012, 2, 29)].month_name == "Feb"
    sat, sun = d[dt.date(2011, 1, 1)], d[dt.date(2011, 1, 2)]
    assert (sat.day_of_week_number, sat.is_weekend, sun.day_of_week_number, sun.is_weekend) == (6, True, 0, True)
    assert d[dt.date(2011, 1, 3)].is_weekend is False
    assert (r.quarter_name, r.year_month) == ("Q1", "2010-01")


def test_fact_net_total_and_key(spark):
    day = dt.datetime(2011, 1, 1, 12, 30, 15)
    rows = [("C1", "A", -2, day, "1.25", "c"), ("2", "A", 3, day, "1.25", None)]
    fct = {r.invoice_no: r for r in marts.fct_orders(staging.stg_orders(_raw(spark, rows))).collect()}
    assert fct["C1"].net_line_total == Decimal("-2.5000") and fct["C1"].line_total == Decimal("-2.50")
    assert fct["2"].net_line_total == Decimal("3.7500") and fct["2"].date_id == 20110101
    assert fct["C1"].is_cancelled and not fct["2"].is_cancelled


def test_data_tests_pass_and_fail(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, None), (2, "d")], "k int, v string")
    assert not_null_failures(df, "k").count() == 2
    dup = unique_failures(df, "k").collect()
    assert [(r.k, r.n_records) for r in dup] == [(1, 2)]      # NULL keys are not duplicates
    day = dt.datetime(2011, 1, 1)
    raw = _raw(spark, [("1", "A", 1, day, 1, "c"), ("2", "B", 1, day, 1, "d")])
    res = run_suite(Models(spark, raw, ModelParams()).as_dict())
    rows = res.collect()
    assert len(rows) == 34 and all(r.passed for r in rows)
    assert sum(1 for r in rows if r.test == "unique") == 6


def test_oversized_values_surface_in_data_tests(spark):
    day = dt.datetime(2011, 1, 1)
    raw = _raw(spark, [("1", "A", 1, day, "1500000.00", "c"), ("2", "B", 50000, day, "9000.00", "c")])
    stg = staging.stg_orders(raw)
    rows = {r.invoice_no: r for r in stg.collect()}
    assert rows["1"].unit_price is None                      # does not fit decimal(10,4)
    assert rows["2"].line_total is None                      # 450,000,000 does not fit decimal(12,4)
    assert not_null_failures(stg, "unit_price").count() == 1
    assert not_null_failures(stg, "line_total").count() == 1
