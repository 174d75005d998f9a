"""Clean, dedup, quality split and conform on hand-made source rows."""

import datetime as dt

from pyspark.sql import functions as F

from tillflow.config import IngestOptions
from tillflow.operators.clean import clean
from tillflow.operators.conform import LOADABLE_COL, conform_raw
from tillflow.operators.dedup import dedup_keep_last, duplicate_count
from tillflow.operators.quality import add_audit_columns, validate_quality
from tillflow.plans import ingest
from tillflow.sources.csv_source import read_source_csv

T0 = "2010-01-01 10:00:00"


def test_dedup_keeps_last_in_file_order(spark, write_csv):
    p = write_csv(
        f"1,A,first,1,{T0},1.0,7,UK\n"
        f"1,A,second,2,{T0},1.0,7,UK\n"
        f"2,B,only,1,{T0},1.0,7,UK\n"
        f"1,A,third,3,{T0},1.0,7,UK\n"
        "3,Z,nodate-a,1,,1.0,7,UK\n"
        "3,Z,nodate-b,2,,1.0,7,UK\n")
    src = read_source_csv(spark, p).drop("_overlong", "_bad_text")
    d = dedup_keep_last(clean(src))
    rows = {(r.invoice_no, r.description): r for r in d.collect()}
    assert set(rows) == {("1", "third"), ("2", "only"), ("3", "nodate-b")}
    assert rows[("1", "third")].quantity == 3.0
    counts = duplicate_count(clean(src), d).first()
    assert (counts.rows_before, counts.rows_after, counts.duplicates_removed) == (6, 3, 3)


def test_quality_reasons_in_rule_order(spark, write_csv):
    p = write_csv(
        f"1,A,ok,1,{T0},1.0,7,UK\n"
        f",A,no invoice,1,{T0},1.0,7,UK\n"
        f"2,,no stock,1,{T0},1.0,7,UK\n"
        "3,A,no date,1,,1.0,7,UK\n"
        f"4,A,no qty,,{T0},1.0,7,UK\n"
        f"5,A,no price,1,{T0},,7,UK\n"
        f"6,A,negative,1,{T0},-1.0,7,UK\n"
        f"7,,two,abc,{T0},1.0,7,UK\n"
        f"8,A,null and negative,,{T0},-2,7,UK\n")
    src = read_source_csv(spark, p).drop("_overlong", "_bad_text")
    good, bad = validate_quality(dedup_keep_last(clean(src)))
    assert [r.invoice_no for r in good.collect()] == ["1"]
    reasons = {r.description: r.error_reason for r in bad.collect()}
    assert reasons == {
        "no invoice": "invoice_no is null; ",
        "no stock": "stock_code is null; ",
        "no date": "invoice_date is null; ",
        "no qty": "quantity is null; ",
        "no price": "unit_price is null; ",
        "negative": "unit_price is negative; ",
        "two": "stock_code is null; quantity is null; ",
        "null and negative": "quantity is null; unit_price is negative; ",
    }


def test_string_nulls_modes(spark, write_csv):
    p = write_csv(f",NA,None,1,{T0},1.0,nan,\n")
    src = read_source_csv(spark, p).drop("_overlong", "_bad_text")
    r = clean(src).first()
    assert (r.invoice_no, r.stock_code, r.description, r.customer_id, r.country) == (None,) * 5
    r = clean(src, IngestOptions(string_nulls="nan")).first()
    assert (r.invoice_no, r.stock_code, r.description, r.country) == ("nan",) * 4
    assert r.customer_id is None
    # in 'nan' mode the null rules cannot fire on text columns
    good, bad = validate_quality(clean(src, IngestOptions(string_nulls="nan")))
    assert good.count() == 1 and bad.count() == 0


def test_customer_id_float_rendering(spark):
    df = spark.createDataFrame([("13085.0",), (" 12 ",), ("nan",)], "cid string").select(
        F.lit("1").alias("Invoice"), F.lit("A").alias("StockCode"), F.lit("d").alias("Description"),
        F.lit("1").alias("Quantity"), F.lit(T0).alias("InvoiceDate"), F.lit("1").alias("Price"),
        F.col("cid").alias("Customer ID"), F.lit("UK").alias("Country"))
    assert [r.customer_id for r in clean(df).collect()] == ["13085.0", "12", None]
    assert [r.customer_id for r in clean(df, IngestOptions(normalize_ids=True)).collect()] == ["13085", "12", None]


def test_conform_skips_rows_that_do_not_fit(spark, write_csv):
    long_desc = "x" * 501
    p = write_csv(
        f"1,A,{long_desc},1,{T0},1.0,7,UK\n"
        f"2,A,ok,1,{T0},123456789.00,7,UK\n"
        f"3,A,NULL,1,{T0}.750,1.005,7,UK\n"
        f"4,A,fine,1,{T0},2.5,7,UK\n")
    src = read_source_csv(spark, p).drop("_overlong", "_bad_text")
    c = conform_raw(add_audit_columns(clean(src), "b", dt.datetime(2020, 1, 1)))
    rows = {r.invoice_no: r for r in c.collect()}
    assert not rows["1"][LOADABLE_COL] and not rows["2"][LOADABLE_COL]
    assert rows["3"][LOADABLE_COL] and rows["4"][LOADABLE_COL]
    assert rows["3"].description is None                      # 'NULL' token
    assert rows["3"].invoice_date == dt.datetime(2010, 1, 1, 10, 0, 0)  # whole seconds
    assert str(rows["3"].unit_price) == "1.01"                # half-up to 2 dp


def test_clean_plus_rejected_equals_deduplicated(spark):
    from tillflow.plans import queries

    f = queries.flagged(spark, "/root/testdata/sf0.001")
    clean_n = ingest.clean_output(f, "b", dt.datetime(2020, 1, 1)).count()
    rej_n = ingest.quarantine(f, "b", dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1)).count()
    assert clean_n + rej_n == f.count()


def test_source_without_file_order_is_rejected(spark):
    import pytest

    from tillflow.operators.clean import ValidationError

    df = spark.createDataFrame([("1", "A", "d", "1", T0, "1", "7", "UK")],
                               "Invoice string, StockCode string, Description string, Quantity string, "
                               "InvoiceDate string, Price string, `Customer ID` string, Country string")
    with pytest.raises(ValidationError, match="_ord"):
        ingest.prepare(df)
    with pytest.raises(ValueError):
        IngestOptions(string_nulls="none")
