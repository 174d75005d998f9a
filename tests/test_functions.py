import datetime as dt

from pyspark.sql import functions as F

from tillflow.functions import coerce_numeric, coerce_timestamp, is_cancelled, is_sale, order_key, py_strip


def _one(spark, expr, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("y")).collect()]


def test_py_strip_matches_python(spark):
    samples = ["  a  ", "\tb\n", "\x0bc\x1c", "　d ", "e", "", None, "  "]
    got = _one(spark, py_strip("x"), [(s,) for s in samples])
    assert got == [None if s is None else s.strip() for s in samples]


def test_coerce_numeric_lenient_text(spark):
    cases = ["12d", "1e3", " 12 ", "+5", "1,000", "0x1A", "inf", "-2.5", "", None, "NaN", ".5"]
    got = _one(spark, coerce_numeric("x"), [(c,) for c in cases])
    assert got[:6] == [None, 1000.0, 12.0, 5.0, None, None]
    assert got[6] == float("inf")
    assert got[7:] == [-2.5, None, None, None, 0.5]


def test_one_order_of_day_and_month(spark):
    rows = [("01/02/2010 08:00",), ("13/02/2010 08:00",), ("2/13/2010 8:00",), ("2010-02-03",)]
    df = spark.createDataFrame(rows, "x string")
    got = {f: [r[0].strftime("%m-%d") if r[0] else None for r in df.select(coerce_timestamp("x", first=f)).collect()]
           for f in ("month", "day")}
    assert got == {"month": ["01-02", None, "02-13", "02-03"], "day": ["02-01", "02-13", None, "02-03"]}


def test_coerce_timestamp_formats(spark):
    rows = [("2010-12-01 08:26:00",), ("12/1/2010 8:26",), ("not a date",), (None,)]
    got = _one(spark, coerce_timestamp("x"), rows)
    assert got == [dt.datetime(2010, 12, 1, 8, 26), dt.datetime(2010, 12, 1, 8, 26), None, None]


def test_cancelled_and_sale(spark):
    rows = [("C123", 5.0), ("123", 5.0), ("c123", 5.0), (None, 5.0), ("123", -1.0), ("123", None)]
    df = spark.createDataFrame(rows, "inv string, q double")
    got = df.select(is_cancelled("inv").alias("c"), F.coalesce(is_sale("inv", "q"), F.lit(False)).alias("s")).collect()
    assert [r.c for r in got] == [True, False, False, False, False, False]
    assert [r.s for r in got] == [False, True, True, False, False, False]


def test_order_key_null_propagates_and_formats(spark):
    df = spark.createDataFrame([("1", "A", dt.datetime(2010, 1, 2, 3, 4, 5)), ("1", None, dt.datetime(2010, 1, 1))],
                               "i string, s string, t timestamp_ntz")
    got = [r[0] for r in df.select(order_key("i", "s", "t")).collect()]
    import hashlib

    assert got[0] == hashlib.md5(b"1-A-2010-01-02 03:04:05").hexdigest()
    assert got[1] is None


def test_scale_conf_sizes_partitions():
    from tillflow.session import scale_conf

    tb = 1024 ** 4
    c = scale_conf(100 * tb, executor_cores=8, executors=1000)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * tb // (256 * 1024 ** 2)
    assert c["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    assert int(scale_conf(1024, executor_cores=4, executors=100)["spark.sql.shuffle.partitions"]) == 800
