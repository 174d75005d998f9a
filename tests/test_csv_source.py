"""CSV source edge cases (quotes, encodings, schema, ragged rows, order)."""

import datetime as dt

import pytest

from tillflow.operators.clean import clean
from tillflow.sources.csv_source import ExtractionError, read_source_csv, source_header, validate_schema

T0 = "2010-01-01 10:00:00"


def _rows(spark, path, **kw):
    return read_source_csv(spark, path, **kw).drop("_ord").collect()


def test_basic_sale_cancel_guest(spark, write_csv):
    p = write_csv(f"100,A,WHITE HEART,6,{T0},2.55,13085,United Kingdom\n"
                  f"C101,A,WHITE HEART,-6,{T0},2.55,13085,United Kingdom\n"
                  f"102,B,GUEST ITEM,1,{T0},1.00,,France\n")
    got = clean(read_source_csv(spark, p)).orderBy("invoice_no").collect()
    assert [r.invoice_no for r in got] == ["100", "102", "C101"]
    assert got[1].customer_id is None
    assert got[2].quantity == -6.0
    assert got[0].invoice_date == dt.datetime(2010, 1, 1, 10, 0)


def test_quotes_and_multiline(spark, write_csv):
    p = write_csv('1,A,"say ""hi"", ok",1,' + T0 + ',1.0,7,UK\n'
                  '2,B,"line one\nline two",1,' + T0 + ',1.0,7,UK\n')
    rows = {r.Invoice: r for r in _rows(spark, p, multi_line=True)}
    assert rows["1"].Description == 'say "hi", ok'
    assert rows["2"].Description == "line one\nline two"


def test_latin1_flagged_then_readable(spark, write_csv):
    body = ("1,A,caf\xe9,1," + T0 + ",1.0,7,UK\n").encode("latin-1")
    p = write_csv(b"Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n" + body)
    utf = read_source_csv(spark, p).collect()
    assert utf[0]._bad_text is True
    lat = read_source_csv(spark, p, encoding="ISO-8859-1").collect()
    assert lat[0].Description == "café" and lat[0]._bad_text is False


def test_missing_column_is_an_error(spark, write_csv):
    p = write_csv(f"1,A,x,1,{T0},1.0,7,UK\n",
                  header="Invoice,StockCode,Description,Quantity,InvoiceDate,Price,CustomerID,Country")
    with pytest.raises(ExtractionError, match="Customer ID"):
        read_source_csv(spark, p)


def test_missing_file_is_an_error(spark):
    with pytest.raises(ExtractionError, match="no source at"):
        source_header(spark, "/tmp/definitely/not/here.csv")


def test_extra_and_reordered_columns_bind_by_name(spark, write_csv):
    p = write_csv(f"UK,7,1.0,{T0},1,x,A,1,extra\n",
                  header="Country,Customer ID,Price,InvoiceDate,Quantity,Description,StockCode,Invoice,Note")
    r = clean(read_source_csv(spark, p)).first()
    assert (r.invoice_no, r.stock_code, r.country, r.customer_id, r.unit_price) == ("1", "A", "UK", "7", 1.0)


def test_ragged_rows(spark, write_csv):
    p = write_csv(f"1,A,x,1,{T0},1.0,7,UK,EXTRA\n2,B,short\n3,C,ok,1,{T0},1.0,7,UK\n")
    rows = {r.Invoice: r for r in _rows(spark, p)}
    assert rows["1"]._overlong is True
    assert rows["2"]._overlong is False and rows["2"].Country is None
    assert rows["3"]._overlong is False


def test_overlong_rows_with_bare_quotes_and_long_fields(spark, write_csv):
    long = "x" * 200_000
    p = write_csv(f'1,A,5" x,1,{T0},1.0,7" y,UK,EXTRA\n2,B,"{long}, ""q"", z",1,{T0},1.0,7,UK,EXTRA\n'
                  f'3,C,"a,""b"",c",1,{T0},1.0,7,UK\n4,D,5" x,1,{T0},1.0,7" y,UK\n')
    assert {r.Invoice: r._overlong for r in _rows(spark, p)} == {"1": True, "2": True, "3": False, "4": False}


def test_legal_replacement_char_stays_utf8(spark, write_csv, tmpdir_path):
    from tillflow.plans import pipeline
    from tillflow.sources.csv_source import detect_encoding

    p = write_csv(f"1,A,caf\xe9 \ufffd,1,{T0},1.0,7,UK\n")
    assert detect_encoding(spark, p) == "UTF-8"
    pipeline.run_pipeline(spark, p, f"{tmpdir_path}/wh", batch_id="u")
    assert pipeline.read_raw(spark, f"{tmpdir_path}/wh").first().description == "caf\xe9 \ufffd"


def test_files_with_another_header_order_fail(spark, tmpdir_path):
    import os

    from tillflow.plans import pipeline

    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    names = ["Invoice,StockCode", "StockCode,Invoice"]
    for i, first in enumerate(names):
        with open(os.path.join(src, f"{i}.csv"), "w") as f:
            f.write(f"{first},Description,Quantity,InvoiceDate,Price,Customer ID,Country\n{i},A,x,1,{T0},1.0,7,UK\n")
    with pytest.raises(ExtractionError, match="one header"):
        pipeline.run_pipeline(spark, src, os.path.join(tmpdir_path, "wh"), batch_id="h")
    assert pipeline.read_raw(spark, os.path.join(tmpdir_path, "wh")).count() == 0


def test_na_tokens_become_null(spark, write_csv):
    p = write_csv(f"1,NA,N/A,1,{T0},1.0,NULL,nan\n")
    r = _rows(spark, p)[0]
    assert (r.StockCode, r.Description, r["Customer ID"], r.Country) == (None, None, None, None)


def test_file_order_is_monotone(spark, write_csv):
    body = "".join(f"{i},A,x,1,{T0},1.0,7,UK\n" for i in range(200))
    p = write_csv(body)
    rows = read_source_csv(spark, p).select("Invoice", "_ord").collect()
    ords = [(r._ord.file, r._ord.block, r._ord.pos) for r in sorted(rows, key=lambda r: int(r.Invoice))]
    assert ords == sorted(ords)


def test_validate_schema_allows_extras():
    validate_schema(["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price",
                     "Customer ID", "Country", "Extra"])


def test_parquet_source_keeps_last_in_file_order(spark, tmpdir_path):
    import os

    from tillflow.operators.dedup import dedup_keep_last
    from tillflow.plans import pipeline
    from tillflow.sources.parquet_source import read_source_parquet

    rows = [(str(i % 3), "A", f"d{i}", float(i), dt.datetime(2010, 1, 1, 10), 1.5, "7", "UK") for i in range(9)]
    cols = "Invoice string, StockCode string, Description string, Quantity double, InvoiceDate timestamp_ntz, " \
           "Price double, `Customer ID` string, Country string"
    path = os.path.join(tmpdir_path, "landing")
    spark.createDataFrame(rows, cols).coalesce(1).write.parquet(path)
    src = read_source_parquet(spark, path)
    kept = {r.invoice_no: r.description for r in dedup_keep_last(clean(src)).collect()}
    assert kept == {"0": "d6", "1": "d7", "2": "d8"}          # the last of each key in the file
    r = pipeline.run_pipeline(spark, src, os.path.join(tmpdir_path, "wh"), batch_id="pq")
    assert (r.records_read, r.records_loaded, r.duplicates_removed) == (9, 3, 6)


# -- newlines inside quotes, and files that were read before ----------------------

def test_only_files_with_an_open_quote_are_read_whole(spark, tmpdir_path):
    import os

    from tillflow.plans import pipeline
    from tillflow.sources.csv_source import drop_check_columns, open_quote_files, read_source_csv

    head = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    src, wh = os.path.join(tmpdir_path, "src dir"), os.path.join(tmpdir_path, "wh")
    os.makedirs(src)
    files = {"a.csv": '1,A,"two\nlines",1,2010-01-01 10:00:00,1.0,7,UK\n2,B,"say ""hi""",1,2010-01-01 10:00:00,1.0,7,UK\n',
             "b.csv": '3,C,plain 5" pipe,1,2010-01-01 10:00:00,1.0,7,UK\n1,A,later,1,2010-01-01 10:00:00,1.0,7,UK\n',
             "c.csv": '4,D,x,1,2010-01-01 10:00:00,1.0,7,"U\nK"\n'}
    for name, body in files.items():
        with open(os.path.join(src, name), "w") as f:
            f.write(head + body)
    plain = read_source_csv(spark, src)
    assert [os.path.basename(f) for f in open_quote_files(plain)] == ["a.csv", "c.csv"]
    whole = read_source_csv(spark, src, multi_line=open_quote_files(plain))
    assert sorted(r.Description for r in drop_check_columns(whole).collect()) == ["later", 'plain 5" pipe', 'say "hi"', "two\nlines", "x"]
    r = pipeline.run_pipeline(spark, src, wh, batch_id="a")
    assert (r.records_read, r.records_loaded, r.records_quarantined, r.duplicates_removed) == (5, 4, 0, 1)
    got = {x.invoice_no: (x.description, x.country) for x in pipeline.read_raw(spark, wh).collect()}
    # the line of the later file is kept: file order holds across both kinds of reads
    assert got == {"1": ("later", "UK"), "2": ('say "hi"', "UK"), "3": ('plain 5" pipe', "UK"), "4": ("x", "U\nK")}


def test_new_files_only(spark, tmpdir_path, monkeypatch):
    import os

    from tillflow.plans import pipeline

    head = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    src, wh = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "wh")
    os.makedirs(src)

    def put(name, *rows):
        with open(os.path.join(src, name), "w") as f:
            f.write(head + "".join(f"{i},{s},x,1,{t},1.0,7,UK\n" for i, s, t in rows))
    read = []
    real = pipeline.read_source_csv
    monkeypatch.setattr(pipeline, "read_source_csv", lambda spark, path, **k: read.append([os.path.basename(p) for p in path]) or
                        real(spark, path, **k))
    run = lambda b, **k: pipeline.run_pipeline(spark, src, wh, batch_id=b, new_files_only=True, **k)
    put("a.csv", ("1", "A", "2010-01-01 10:00:00"))
    put("b.csv", ("2", "B", "2010-01-02 10:00:00"))
    assert run("x").records_loaded == 2 and read.pop() == ["a.csv", "b.csv"]
    assert run("y").records_read == 0 and not read              # nothing new: nothing is read
    put("c.csv", ("3", "C", "2010-01-03 10:00:00"), ("0", "late", "2009-01-01 10:00:00"))
    r = run("z")
    assert (r.records_read, r.records_loaded) == (1, 1) and read.pop() == ["c.csv"]     # the mark is the second guard
    put("a.csv", ("9", "A", "2010-01-05 10:00:00"), ("1", "A", "2010-01-01 10:00:00"))    # a file that changed is new
    assert run("w").records_loaded == 1 and read.pop() == ["a.csv"]
    pipeline.compact_lines(spark, pipeline.Layout(wh).lines)
    put("d.csv", ("10", "D", "2010-01-06 10:00:00"))
    assert run("v", compact_after=1).records_loaded == 1 and read.pop() == ["d.csv"]
    assert run("z").records_loaded == 1 and read.pop() == ["c.csv"]       # a batch again: its own files
    assert sorted((x.invoice_no, x.batch_id) for x in pipeline.read_raw(spark, wh).collect()) == [
        ("1", "x"), ("10", "v"), ("2", "x"), ("3", "z"), ("9", "w")]
