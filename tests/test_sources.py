from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import text
from shelfwise.sources import files, ingest, sinks
from shelfwise.streaming.ingest import ingest_stream, stream_files


def test_transform_steps(spark):
    df = spark.createDataFrame([(" (1,200) ", "3/4/24 9:05", "2024-05", " 00012.0 ", "x"), ("5-", "bad", "13", None, None)], "n string, d string, m string, po string, z string")
    out = ingest.apply_steps(df, "trim_all; numeric_clean:n|absent; date_parse:d; month_parse:m->per_year; po_fix; nonsense").collect()
    assert (out[0].n, out[0].d, out[0].per_year, out[0].po) == ("-1200", "2024-03-04 09:05:00", dt.date(2024, 5, 1), "00012")
    assert (out[1].n, out[1].d, out[1].per_year) == ("-5", None, None)
    months = spark.createDataFrame([("202405",), ("2024-13",), ("2024/05/01",), (None,)], "m string")
    assert [r[0] for r in months.select(ingest.month_start(F.col("m"))).collect()] == [dt.date(2024, 5, 1), None, dt.date(2024, 5, 1), None]


def test_shape_helpers(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    assert ingest.apply_header(df, ["x", "y", "z"]).first().asDict() == {"x": "1", "y": "2", "z": None}
    assert ingest.apply_header(df, ["x"]).columns == ["x"]
    assert ingest.align(df, ["B", "c"]).first().asDict() == {"B": "2", "c": None}
    with pytest.raises(ValueError):
        ingest.check_width(df, ["one"])
    ingest.check_width(df, ["one", "two", "load_current_timestamp"])
    assert ingest.filter_text(df, "FULL").count() == 1 and ingest.filter_text(df, "a = '9'").count() == 0
    got = ingest.project(spark.createDataFrame([("yes", "7", "x")], "F string, N string, t string"), {"f": "f", "n": "n", "q": "nope"}, {"k": "c"}, ["f", "n"]).first()
    assert tuple(got) == (1.0, 7.0, None, "c")


def test_file_choice():
    names = ["Sales_2023.csv", "sales_2024.csv", "other.txt"]
    assert ingest.pick_latest(names, "sales_*.csv") == "sales_2024.csv" and ingest.pick_latest(names, "OTHER.TXT") == "other.txt"
    assert ingest.pick_latest(names, r"2023\.csv$") == "Sales_2023.csv" and ingest.pick_latest(names, "[") is None
    assert ingest.choose_files(names, ["other.txt", "gone"]) == (["other.txt"], ["gone"])


def test_run_of_feeds(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a_1.csv").write_text("x~|~ 1,5 \ny~|~2-\n")
    meta = "SOURCE_TABLE_NAME\tLOAD_FREQUENCY\tPRIORITY\tLOCAL_PATH\tLATEST_REGEX\tMULTI_DELIMITER\tHEADER\tTRANSFORMS\n"
    meta += f"good\t1\t2\t{tmp_path}/in\ta_*.csv\t~|~\tname,amount,extra\ttrim_all;numeric_clean:amount\n"
    meta += f"off\t0\t1\t{tmp_path}/in\ta_*.csv\t\t\t\nmissing\t1\tbad\t{tmp_path}/in\tzz*\t\t\t\n"
    (tmp_path / "meta.tsv").write_text(meta)
    feeds = [r.asDict() for r in ingest.load_metadata(spark, f"{tmp_path}/meta.tsv").collect()]
    assert [f["SOURCE_TABLE_NAME"] for f in feeds] == ["good", "missing"]
    log = ingest.RunLog(spark, f"file://{tmp_path}/log")
    out = ingest.run_feeds(spark, feeds, ingest.HadoopStore(spark), lambda df, m: sinks.write_parquet(df, f"file://{tmp_path}/out"), log)
    assert [(r.feed, r.status, r.n_rows) for r in out.collect()] == [("good", "STARTED", 0), ("good", "SUCCESS", 2), ("missing", "FAILED", 0)]
    assert sorted((r.name, r.amount, r.extra) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [("x", "15", None), ("y", "-2", None)]
    assert spark.read.parquet(f"{tmp_path}/log").count() == 3
    assert not ingest.run_hook(spark, " TRUE ") and ingest.run_hook(spark, "SELECT 1")


def test_encodings_and_sniffing(spark, tmp_path):
    (tmp_path / "u.csv").write_bytes("a,b\né,1\n".encode())
    (tmp_path / "l.csv").write_bytes("a,b\né,1\n".encode("latin-1"))
    for name in ("u", "l"):
        assert files.read_any_encoding(spark, f"{tmp_path}/{name}.csv").first().a == "é"
    assert files.pick_encoding(spark, f"{tmp_path}/l.csv") == "latin-1"
    heads = spark.createDataFrame([(i, b) for i, b in enumerate((b"PK\x03", b"\xd0\xcf\x11\xe0", b" <html>", b"<?xml", b"a,b", b"\xff\xfe"))], "i int, b binary")
    assert [r.f for r in heads.orderBy("i").select(files.sniff_format(F.col("b")).alias("f")).collect()] == ["xlsx", "xls", "html", "xml", "text", "text"]


def test_html_tables(spark):
    page = "<html><table><tr><th>a</th><td> b  c </td></tr><tr><td>1<b>2</b></td></tr></table>"
    df = files.read_html_tables(spark.createDataFrame([(1, page), (2, None)], "id long, html string"), "id", "html")
    assert sorted((r.row_no, r.cells) for r in df.collect()) == [(0, ["a", "b c"]), (1, ["12"])]


def test_headers(spark):
    groups = files.column_groups(["Item Code", "Brand", "Product Group", "Item Name", "Barcode", "Supplier description"])
    assert groups == {"code": ["Item Code", "Barcode"], "category": ["Product Group"], "description": ["Item Name"]}
    assert files.find_column(["Mat Desc", "Bar Code"], ["bar_code"]) == "Bar Code" and text.clean_header(" A  b ") == "a_b"
    raw = spark.createDataFrame([(0, "junk", None), (1, "Item Name", "Brand"), (2, "milk", "x")], "row_id long, a string, b string")
    number, cells = files.find_header(raw.drop("row_id"), "item name")
    assert files.apply_header_row(raw, number, cells).first().asDict() == {"row_id": 2, "Item Name": "milk", "Brand": "x"}
    with pytest.raises(ValueError):
        sinks.text_table_ddl("t", ["A b", "A-b"])


def test_feed_reader_and_sheets(spark):
    df = spark.createDataFrame([(1, "Milk", "B", "1"), (2, "milk", "B", "2"), (3, None, "B", "3")], "row_id long, `Product name` string, Brand string, `Item barcode` string")
    got = files.read_feed(df, files.FEEDS["plain"], "L").collect()
    assert [(r.material_name, r.barcode, r.source_customer) for r in got] == [("MILK", "1", "L")]
    both = files.read_sheets(spark, {"one": df.select("Brand"), "two": df.select("row_id")}, "f.xlsx")
    assert both.count() == 6 and {r._source_sheet for r in both.collect()} == {"one", "two"}
    with pytest.raises(RuntimeError):
        files.read_excel(spark, "/none.xlsx")
    assert files.read_with_fallback([("bad", lambda: 1 / 0), ("good", lambda: df)])[0] == "good"


def test_caches(spark, tmp_path):
    (tmp_path / "c.csv").write_text("a\n1\n")
    reads = []

    def read():
        reads.append(1)
        return files.read_delimited(spark, f"{tmp_path}/c.csv")

    for _ in range(2):
        assert files.conversion_cache(spark, f"file://{tmp_path}/c.csv", f"file://{tmp_path}/cache", read).first().a == "1"
    assert len(reads) == 1
    done = []

    def work(df):
        done.extend(r.k for r in df.collect())
        return df.select("k", F.concat("k", F.lit("!")).alias("v"))

    for keys in (["a", "b"], ["b", "c"]):
        out = sinks.cached_by_key(spark.createDataFrame([(k,) for k in keys], "k string"), f"file://{tmp_path}/kv", "k", work)
        assert sorted(r.v for r in out.collect()) == [f"{k}!" for k in keys]
    assert done == ["a", "b", "c"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id long, t string")
    assert sinks.write_parquet(df, f"file://{tmp_path}/p", "replace") == 2
    assert len(sinks.write_report({"Matched rows": df, "Summary": df}, f"file://{tmp_path}/r", "csv")) == 2
    assert spark.read.csv(f"{tmp_path}/r/matched_rows", header=True).count() == 2
    assert [r.highlight for r in sinks.with_highlight(df, {"red": "id = 1"}).orderBy("id").collect()] == ["red", None]
    sinks.result_view(df, df.withColumnRenamed("t", "u"), "id", "joined_view")
    assert spark.table("joined_view").columns == ["id", "t", "u"]
    pairs = spark.createDataFrame([(1, 2)], "our_id long, cust_id long")
    got = sinks.prefixed(df.withColumnRenamed("id", "our_id"), df.withColumnRenamed("id", "cust_id"), pairs, ["t"], ["t"]).first()
    assert (got.OUR_t, got.CUST_t) == ("x", "y")


def test_streaming_ingest_takes_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    at = {k: f"file://{tmp_path}/{k}" for k in ("out", "log", "check")}

    def run():
        stream = stream_files(spark, f"{tmp_path}/in", ["a", "n"])
        ingest_stream(stream, "trim_all; numeric_clean:n", at["out"], at["log"], at["check"]).awaitTermination()

    (tmp_path / "in" / "1.csv").write_text("a,n\nx,(5)\n")
    run()
    (tmp_path / "in" / "2.csv").write_text("a,n\ny,7\nz,8-\n")
    run()
    run()
    assert sorted(r.n for r in spark.read.parquet(at["out"]).collect()) == ["-5", "-8", "7"]
    assert sorted((r._source_file, r.n_rows) for r in spark.read.parquet(at["log"]).collect()) == [("1.csv", 1), ("2.csv", 2)]
