"""Registered queries of readers, writers, caches and runs: tables are written as files of each kind and read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import adjudicate, category, rows
from shelfwise.plans.inputs import table
from shelfwise.plans.queries import query
from shelfwise.session import Scratch
from shelfwise.sources import files, ingest, sinks, workbook


def put(spark: SparkSession, path: str, content: bytes) -> None:
    """Write a small file."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    out.write(bytearray(content))
    out.close()


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as text cells; every tenth row is null throughout, and names hold separators, quotes and an accent."""
    c = table(spark, sf_dir, "customer")
    kept = F.col("c_custkey") % 10 != 0
    return c.select(
        F.when(kept, F.col("c_custkey").cast("string")).alias("key"),
        F.when(kept, F.concat("c_name", F.lit(', "é"'))).alias("name"),
        F.when(kept & (F.col("c_custkey") % 3 != 0), F.col("c_mktsegment")).alias("segment"),
    )


CELLS = "SELECT CAST(c_custkey AS VARCHAR) AS key, c_name || ', \"é\"' AS name, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS segment FROM customer WHERE c_custkey % 10 <> 0"


@query("delimited_scan", CELLS)
def delimited_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV result read back as text, without rows of nulls."""
    scratch = Scratch(spark, "csv")
    sinks.write_csv(_cells(spark, sf_dir), scratch.path("c"))
    return files.read_delimited(spark, scratch.path("c")).withColumn("name", F.replace("name", F.lit('\\"'), F.lit('"')))


@query("encoded_scan", CELLS)
def encoded_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tab-separated file in Latin-1, whose encoding is found from its bytes."""
    scratch = Scratch(spark, "latin")
    _cells(spark, sf_dir).na.drop("all").write.csv(scratch.path("l"), sep="\t", header=True, encoding="ISO-8859-1", quote="'")
    return files.read_delimited(spark, scratch.path("l"), "\t", encoding=files.pick_encoding(spark, f"{scratch.path('l')}/*.csv")).withColumn("name", F.btrim("name", F.lit("'")))


@query(
    "headerless_feed",
    """SELECT CAST(c_custkey AS VARCHAR) AS "KEY", c_name AS "NAME", CASE WHEN c_custkey % 2 = 0 THEN '-' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS "AMOUNT", NULL::VARCHAR AS "EXTRA", TIMESTAMP '2024-05-01 10:00:00' AS "LOADED_AT" FROM customer WHERE c_custkey < 1000""",
)
def headerless_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file without header and with a separator of three characters, through a whole feed plan."""
    scratch, c = Scratch(spark, "feed"), table(spark, sf_dir, "customer")
    amount = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("("), F.col("c_custkey").cast("string"), F.lit(")"))).otherwise(F.col("c_custkey").cast("string"))
    c.select(F.concat_ws("~|~", F.col("c_custkey").cast("string"), F.concat(F.lit(" "), "c_name"), amount)).write.text(scratch.path("t"))
    meta = {"HEADER": "KEY,NAME,AMOUNT", "MULTI_DELIMITER": "~|~", "TRANSFORMS": "trim_all; numeric_clean:AMOUNT", "WHERE": "CAST(KEY AS INT) < 1000", "AUDIT_TS_COL": "LOADED_AT"}
    ingest.check_width(ingest.read_source(spark, scratch.path("t"), meta), ["KEY", "NAME", "AMOUNT", "load_current_timestamp"])
    return ingest.build_feed(spark, scratch.path("t"), meta, ["KEY", "NAME", "AMOUNT", "EXTRA", "LOADED_AT"], dt.datetime(2024, 5, 1, 10))


@query(
    "workbook_rows",
    """SELECT 'parts' AS sheet, p_partkey::VARCHAR AS a, p_name AS b, NULL::VARCHAR AS c FROM part WHERE p_partkey % 3 <> 0 UNION ALL SELECT 'all nations', n_nationkey::VARCHAR, NULL, n_name FROM nation""",
)
def workbook_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A workbook of two sheets is written and read back, with the sheet each row comes from."""
    scratch = Scratch(spark, "book")
    parts = table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("a"), F.col("p_name").alias("b"), F.when(F.col("p_size") > 40, "FFC7CE").alias("tint"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("a"), F.col("n_name").alias("c"))
    workbook.write_workbook({"parts": parts, "all nations": nations}, scratch.path("b.xlsx"), "tint")
    cells = scratch.table(workbook.read_workbooks(spark, scratch.path("b.xlsx")), "cells")
    sheets = {name: workbook.as_table(cells.where(F.col("sheet") == name)).drop("row_no") for name in ("parts", "all nations")}
    both = files.read_sheets(spark, sheets, "b.xlsx")
    return both.select(F.col("_source_sheet").alias("sheet"), "a", "b", "c")


@query("workbook_sheets", "SELECT 'nations' AS sheet, (SELECT count(*) FROM nation) + 1 AS n_rows UNION ALL SELECT 'regions', (SELECT count(*) FROM region) + 1")
def workbook_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sheets of a workbook."""
    scratch = Scratch(spark, "sheets")
    workbook.write_workbook({"nations": table(spark, sf_dir, "nation"), "regions": table(spark, sf_dir, "region")}, scratch.path("s.xlsx"))
    return workbook.list_sheets(spark, scratch.path("s.xlsx")).select("sheet", "n_rows")


@query(
    "sniffed_formats",
    "SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'xlsx' WHEN 1 THEN 'xls' WHEN 2 THEN 'html' WHEN 3 THEN 'xml' WHEN 4 THEN 'html' ELSE 'text' END AS format FROM part",
)
def sniffed_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats by first bytes."""
    p = F.col("p_partkey") % 6
    head = (
        F.when(p == 0, F.lit(b"PK\x03\x04rest")).when(p == 1, F.lit(b"\xd0\xcf\x11\xe0\xa1\xb1")).when(p == 2, F.lit(b"\r\n <HTML><body>")).when(p == 3, F.lit(b"<?xml version='1.0'?>"))
        .when(p == 4, F.lit(b"<!DOCTYPE html>")).otherwise(F.encode("p_name", "utf-8"))
    )
    return table(spark, sf_dir, "part").select("p_partkey", files.sniff_format(head).alias("format"))


@query("sniffed_files", "SELECT * FROM (VALUES ('a.bin', 'xlsx'), ('b.bin', 'xls'), ('c.bin', 'html'), ('d.bin', 'text')) AS v(file, format)")
def sniffed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 over files."""
    scratch = Scratch(spark, "sniff")
    for name, content in (("a", b"PK\x03\x04"), ("b", b"\xd0\xcf\x11\xe0"), ("c", b" <table><tr>"), ("d", b"x,y\n1,2\n")):
        put(spark, scratch.path(f"in/{name}.bin"), content)
    return files.sniff_files(spark, scratch.path("in")).select(F.element_at(F.split("path", "/"), -1).alias("file"), "format")


@query(
    "html_sheets",
    """WITH t AS (SELECT r_regionkey AS id, 0 AS row_no, 'nation' AS a, 'key' AS b FROM region UNION ALL
  SELECT n_regionkey, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS INTEGER), n_name, n_nationkey::VARCHAR FROM nation) SELECT CAST(id AS BIGINT) AS id, row_no, a, b FROM t""",
)
def html_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables in pages, such as workbooks that are HTML."""
    line = F.concat(F.lit("<tr><td> "), "n_name", F.lit("\n</td><td><b>"), F.col("n_nationkey").cast("string"), F.lit("</b></td></tr>"))
    body = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", line.alias("l")))).alias("ls"))
    regions = table(spark, sf_dir, "region").join(body, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    page = F.concat(F.lit("<html><table><tr><th>nation</th><th>key</th></tr>"), F.coalesce(F.array_join(F.transform("ls", lambda x: x["l"]), ""), F.lit("")), F.lit("</table></html>"))
    cells = files.read_html_tables(regions.select(F.col("r_regionkey").cast("long").alias("id"), page.alias("html")), "id", "html")
    return cells.select("id", "row_no", F.get("cells", F.lit(0)).alias("a"), F.get("cells", F.lit(1)).alias("b"))


@query("fallback_reader", "SELECT 'delimited' AS reader, CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation")
def fallback_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readers in order, the first that works."""
    scratch = Scratch(spark, "fallback")
    sinks.write_csv(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), scratch.path("n"))
    readers = [("excel", lambda: files.read_excel(spark, scratch.path("n"))), ("gone", lambda: files.read_delimited(spark, scratch.path("gone"))), ("delimited", lambda: files.read_delimited(spark, scratch.path("n")))]
    name, df = files.read_with_fallback(readers)
    return df.select(F.lit(name).alias("reader"), "*")


def _with_junk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts below three rows of junk and a header row, by row id."""
    junk = spark.createDataFrame([(0, "Report", None, None), (1, None, None, None), (2, "made by", "x", None), (3, "Item Name", "Brand", None)], "row_id long, a string, b string, c string")
    body = table(spark, sf_dir, "part").select((F.col("p_partkey") + 4).alias("row_id"), F.col("p_name").alias("a"), F.col("p_brand").alias("b"), F.col("p_type").alias("c"))
    return junk.unionByName(body)


@query("found_header", 'SELECT p_partkey + 4 AS row_id, p_name AS "Item Name", p_brand AS "Brand", p_type AS unnamed_2 FROM part')
def found_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header row is found by a name among the leading rows."""
    raw = _with_junk(spark, sf_dir)
    number, cells = files.find_header(raw.orderBy("row_id").drop("row_id"), "item  name")
    return files.apply_header_row(raw, number, cells)


@query("column_by_place", "SELECT p_partkey + 4 AS row_id, p_brand AS brand FROM part")
def column_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column by its place, below a fixed number of rows."""
    return files.by_position(_with_junk(spark, sf_dir), 4, 1, "brand")


@query(
    "customer_feeds",
    """WITH s AS (SELECT *, row_number() OVER (PARTITION BY upper(p_name) ORDER BY p_partkey) AS k, row_number() OVER (PARTITION BY upper(p_brand || ' ' || p_type) ORDER BY p_partkey) AS f FROM part WHERE p_partkey % 11 <> 0)
SELECT feed AS source_customer, upper(p_name) AS material_name, p_brand AS brand, CASE WHEN feed IN ('plain', 'items') THEN CAST(p_partkey AS VARCHAR) END AS barcode FROM s, (VALUES ('plain'), ('items'), ('named'), ('lower'), ('placed')) AS v(feed) WHERE k = 1
UNION ALL SELECT 'family', upper(p_brand || ' ' || p_type), p_brand, NULL FROM s WHERE f = 1""",
)
def customer_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All kinds of customer feeds, whose columns are found by name or place, as one frame."""
    p = table(spark, sf_dir, "part").withColumn("name", F.when(F.col("p_partkey") % 11 != 0, F.col("p_name")))
    code, kept = F.col("p_partkey").cast("string"), F.when(F.col("p_partkey") % 11 != 0, F.col("p_type"))
    own = F.when(F.col("p_partkey") % 11 != 0, F.col("p_brand"))
    raw = {
        "plain": p.select(F.col("p_partkey").alias("row_id"), F.col("name").alias("Product name"), F.col("p_brand").alias("Brand"), code.alias("Item barcode"), F.lit(1).alias("Unnamed: 3"), F.lit(2).alias("_helper")),
        "items": p.select(F.col("p_partkey").alias("row_id"), F.col("name").alias("Item Name"), F.col("p_brand").alias("Brand"), code.alias("BARCODE")),
        "named": p.select(F.col("p_partkey").alias("row_id"), F.col("name").alias("Product name"), F.col("p_brand").alias("Brand")),
        "lower": p.select(F.col("p_partkey").alias("row_id"), F.col("name").alias("product name"), F.col("p_brand").alias("BRAND")),
        "placed": p.select(F.col("p_partkey").alias("row_id"), F.lit("a").alias("a"), F.lit("b").alias("b"), F.lit("c").alias("c"), F.col("p_brand").alias("Brand"), F.col("name").alias("what it is")),
        "family": p.select(F.col("p_partkey").alias("row_id"), kept.alias("Family Text"), own.alias("Retail Article Brand Description Text")),
    }
    assert files.drop_helpers(files.drop_unnamed(raw["plain"])).columns == ["row_id", "Product name", "Brand", "Item barcode"]
    assert files.find_column(raw["items"].columns, ["item_name"]) == "Item Name"
    return rows.union_all([files.read_feed(df, files.FEEDS[name], name).drop("row_id") for name, df in raw.items()])


@query("converted_source", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders")
def converted_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second read of an unchanged source comes from its Parquet copy; a reader that fails is not asked."""
    scratch = Scratch(spark, "conversion")
    sinks.write_csv(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), scratch.path("o"))
    source, cache = f"{scratch.path('o')}/*.csv", scratch.path("cache")
    files.conversion_cache(spark, source, cache, lambda: files.read_delimited(spark, scratch.path("o")))

    def never() -> DataFrame:
        raise AssertionError("the cached copy was not used")

    return files.conversion_cache(spark, source, cache, never)


@query("pruned_table", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0")
def pruned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by name, its columns and a filter."""
    name = f"suppliers_{uuid.uuid4().hex}"
    table(spark, sf_dir, "supplier").createOrReplaceTempView(name)
    return files.read_table(spark, name, ["s_suppkey", "s_name"], "s_acctbal > 0")


@query("latest_file", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, 'Sales_2024.csv' AS picked, 2 AS n_chosen, 1 AS n_missing FROM nation WHERE n_regionkey = 2")
def latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest of the files that fit a pattern."""
    scratch, nation = Scratch(spark, "latest"), table(spark, sf_dir, "nation")
    for year, region in ((2022, 0), (2023, 1), (2024, 2)):
        lines = [f"{r.n_nationkey},{r.n_name}" for r in nation.where(F.col("n_regionkey") == region).collect()]
        put(spark, scratch.path(f"in/Sales_{year}.csv"), "\n".join(["n_nationkey,n_name", *lines]).encode())
    put(spark, scratch.path("in/notes.txt"), b"x")
    store = ingest.HadoopStore(spark)
    names = store.list(scratch.path("in"))
    picked = ingest.pick_latest(names, "sales_*.csv")
    chosen, missing = ingest.choose_files(names, ["Sales_2022.csv", "notes.txt", "gone.csv"])
    return files.read_delimited(spark, store.path(scratch.path("in"), picked)).select("*", F.lit(picked).alias("picked"), F.lit(len(chosen)).alias("n_chosen"), F.lit(len(missing)).alias("n_missing"))


@query(
    "metadata_file",
    """SELECT c_name AS "SOURCE_TABLE_NAME", coalesce(TRY_CAST(CASE WHEN c_custkey % 3 = 0 THEN 'bad' ELSE CAST(c_custkey % 50 AS VARCHAR) END AS INTEGER), 9999) AS "PRIORITY_NO" FROM customer WHERE c_nationkey % 4 <> 0""",
)
def metadata_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of feeds from a tab-separated file."""
    scratch, c = Scratch(spark, "meta"), table(spark, sf_dir, "customer")
    priority = F.when(F.col("c_custkey") % 3 == 0, "bad").otherwise((F.col("c_custkey") % 50).cast("string"))
    c.select(F.concat(F.lit(" "), "c_name").alias("source_table_name"), priority.alias(" priority"), (F.col("c_nationkey") % 4).cast("string").alias("load_frequency")).write.csv(scratch.path("m"), sep="\t", header=True)
    return ingest.load_metadata(spark, scratch.path("m")).select("SOURCE_TABLE_NAME", "PRIORITY_NO")


@query("taxonomy_list", "SELECT category, lower(category) AS key FROM (SELECT DISTINCT trim(p_type) AS category FROM part) WHERE category <> ''")
def taxonomy_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct category names with their keys."""
    names = [r.p_type for r in table(spark, sf_dir, "part").select("p_type").distinct().collect()]
    return files.taxonomy(spark, [*names, *[f" {n} " for n in names], "", None])


@query("restored_cache", "SELECT c_custkey AS key, CASE WHEN c_custkey % 3 = 0 THEN 'current' ELSE 'earlier' END AS source FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 2 = 0")
def restored_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier session's cache under the current one."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    return rows.restore_cache(c.where("key % 3 = 0").withColumn("source", F.lit("current")), c.where("key % 2 = 0").withColumn("source", F.lit("earlier")), ["key"])


# ---- sinks ----------------------------------------------------------------------------


@query(
    "table_modes",
    """SELECT 'appended' AS step, count(*) * 2 AS n FROM nation UNION ALL SELECT 'emptied', count(*) FROM region UNION ALL SELECT 'replaced', count(*) FROM nation
UNION ALL SELECT 'checked', count(*) + count(*) FROM nation UNION ALL SELECT 'dry', count(*) FROM nation""",
)
def table_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append, truncate, replace, and append with types, each counted after it."""
    schema, tag = f"shelf_{uuid.uuid4().hex[:12]}", Scratch(spark, "warehouse")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("name"))
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("key"), F.col("r_name").alias("name"))
    spark.sql(f"CREATE SCHEMA `{schema}` LOCATION '{tag.path('schema')}'")
    sinks.create_schema(spark, schema)
    name, counts = f"{schema}.items", []
    sinks.create_text_table(spark, name, ["Key", " Name "])

    def count(step: str) -> None:
        spark.catalog.refreshTable(name)
        counts.append((step, spark.table(name).count()))

    for _ in range(2):
        sinks.write_table(nation, name)
    count("appended")
    sinks.write_table(region, name, "truncate")
    count("emptied")
    sinks.write_table(nation, name, "replace")
    count("replaced")
    dry = sinks.append_checked(nation, name, {"key": "string"}, dry_run=True).count()
    sinks.append_checked(nation.select("name", "key"), name, {"key": "string"})
    count("checked")
    spark.sql(f"DROP SCHEMA `{schema}` CASCADE")
    return spark.createDataFrame([*counts, ("dry", dry)], "step string, n long")


@query("whole_loads", "SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'even_csv' ELSE 'odd_csv' END AS load, o_orderkey FROM orders")
def whole_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: each file's rows come into sight by one rename; a load that runs again is not doubled, a staged one not seen."""
    scratch, orders = Scratch(spark, "loads"), table(spark, sf_dir, "orders").select("o_orderkey")
    for name, part in (("even.csv", 0), ("odd.csv", 1), ("even.csv", 0)):
        sinks.append_whole(orders.where(F.col("o_orderkey") % 2 == part), scratch.path("loads"), name)
    orders.limit(3).write.parquet(scratch.path("loads/_staged-broken"))
    return spark.read.parquet(scratch.path("loads")).select("load", "o_orderkey")


@query(
    "report_folders",
    """SELECT 'matched' AS sheet, count(*) AS n, count(*) FILTER (WHERE c_acctbal < 0) AS n_red FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'unmatched', count(*), count(*) FILTER (WHERE c_acctbal < 0) FROM customer WHERE c_custkey % 2 = 1""",
)
def report_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report sheets as folders, with the columns that took part and a colour."""
    scratch, c = Scratch(spark, "report"), table(spark, sf_dir, "customer").withColumn("our_id", F.col("c_custkey")).withColumn("cust_id", F.col("c_custkey"))
    wide = sinks.prefixed(c.select("our_id", "c_name"), c.select("cust_id", "c_acctbal"), c.select("our_id", "cust_id"), ["c_name"], ["c_acctbal"])
    tinted = sinks.with_highlight(wide, {"red": "CUST_c_acctbal < 0"})
    targets = sinks.write_report({"Matched": tinted.where("our_id % 2 = 0"), "Unmatched": tinted.where("our_id % 2 = 1")}, scratch.path("r"))
    read = [spark.read.parquet(t).agg(F.count("*").alias("n"), F.count(F.when(F.col("highlight") == "red", 1)).alias("n_red")).select(F.lit(t.rsplit("/", 1)[-1]).alias("sheet"), "n", "n_red") for t in targets]
    return rows.union_all(read)


@query("joined_view", "SELECT n_nationkey, n_name, r_name AS result FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey % 2 = 0")
def joined_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view of the base with a result's columns."""
    result = table(spark, sf_dir, "region").where("r_regionkey % 2 = 0").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("result"))
    name = f"view_{uuid.uuid4().hex}"
    sinks.result_view(table(spark, sf_dir, "nation"), result, "n_regionkey", name)
    return spark.table(name).select("n_nationkey", "n_name", "result")


@query(
    "feed_run",
    """SELECT 'bad' AS feed, 'FAILED' AS status, 0::BIGINT AS n_rows UNION ALL SELECT 'hooked', 'SUCCESS', 0 UNION ALL SELECT 'idle', 'SKIPPED', 0 UNION ALL SELECT 'off', 'SKIPPED', 0 UNION ALL SELECT 'good', 'SUCCESS', count(*) FROM nation""",
)
def feed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over feeds that load, fail, are off or only run SQL; its log, and the summary that is mailed."""
    scratch = Scratch(spark, "run")
    lines = [f"{r.n_nationkey},{r.n_name}" for r in table(spark, sf_dir, "nation").collect()]
    put(spark, scratch.path("in/n_1.csv"), "\n".join(["key,name", *lines]).encode())
    feeds = [
        {"SOURCE_TABLE_NAME": "good", "LOCAL_PATH": scratch.path("in"), "LATEST_REGEX": "n_*.csv", "PRE_SQL": "SELECT 1", "POST_SQL": "TRUE"},
        {"SOURCE_TABLE_NAME": "bad", "LOCAL_PATH": scratch.path("in"), "LATEST_REGEX": "zz*"},
        {"SOURCE_TABLE_NAME": "off", "LOAD_FREQUENCY": "0"},
        {"SOURCE_TABLE_NAME": "hooked", "READER_TYPE": "POST_SQL_ONLY", "SQL_TEXT": "SELECT 1"},
        {"SOURCE_TABLE_NAME": "idle", "READER_TYPE": "FUNC"},
    ]
    log = ingest.RunLog(spark, scratch.path("log"))
    ingest.run_feeds(spark, feeds, ingest.HadoopStore(spark), lambda df, m: sinks.append_whole(df, scratch.path("out"), m["SOURCE_TABLE_NAME"]), log)
    summary = ingest.run_summary(spark.read.parquet(scratch.path("log")))
    assert ingest.summary_mail(summary, "a@example.com", ["b@example.com"])["Subject"] == "Feed run: 1 FAILED, 2 SKIPPED, 2 SUCCESS"
    return summary.select("feed", "status", "n_rows")


@query("result_cache", "SELECT c_custkey AS key, c_nationkey, CASE WHEN c_nationkey % 2 = 0 THEN 'first run' ELSE 'second run' END AS made FROM customer WHERE c_nationkey <> 7")
def result_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results by key, committed batch by batch; failures are not kept, and a second run works on the rest only."""
    scratch = Scratch(spark, "results")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_nationkey")
    work = lambda name: lambda df: df.where("c_nationkey <> 7").select("c_nationkey", F.lit(name).alias("made"))
    sinks.cached_in_batches(c.where("c_nationkey % 2 = 0"), scratch.path("kv"), "c_nationkey", work("first run"), 3)
    return sinks.cached_in_batches(c, scratch.path("kv"), "c_nationkey", work("second run"), 3).select("key", "c_nationkey", "made")


# ---- filters and judges ---------------------------------------------------------------


@query("valid_labels", "SELECT p_partkey AS row_id, CASE WHEN p_type IN ('PROMO', 'LARGE') THEN p_type END AS verdict FROM part WHERE length(p_name) <= 10")
def valid_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an overlong label go, and labels outside the allowed list are null."""
    allowed = files.taxonomy(spark, ["PROMO", "LARGE"])
    kept = ingest.drop_corrupt_labels(table(spark, sf_dir, "part"), "p_name", 10)
    return adjudicate.valid_only(kept.select(F.col("p_partkey").alias("row_id"), F.col("p_type").alias("verdict")), allowed)


@query("review_rows", "SELECT event_id, event_type || CASE WHEN event_id % 4 = 0 THEN ' - REVIEW weight' ELSE '' END AS status FROM events WHERE event_id % 4 = 0 AND event_type IS NOT NULL")
def review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose status text speaks of REVIEW."""
    status = F.concat("event_type", F.when(F.col("event_id") % 4 == 0, " - REVIEW weight").otherwise(""))
    return category.flagged_for_review(table(spark, sf_dir, "events").select("event_id", status.alias("status")))


@query(
    "second_opinions",
    """SELECT p_partkey AS row_id, p_type AS verdict, CAST(p_size AS DOUBLE) AS confidence, p_partkey % 3 <> 0 AND p_size >= 20 AS verified FROM part""",
)
def second_opinions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first verdict stands as verified where a second judge gives the same and is sure enough."""
    first = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), F.col("p_type").alias("verdict"), F.col("p_size").cast("double").alias("confidence"))
    second = first.withColumns({"verdict": F.when(F.col("row_id") % 3 == 0, "OTHER").otherwise(F.col("verdict")), "confidence": F.col("confidence") + 40})
    return adjudicate.second_opinion(first, second)


class _Unsure:
    """Fails once in a while, so that calls are tried again."""

    def __init__(self) -> None:
        self.calls = 0
        self.judge = adjudicate.RuleJudge()

    def answer(self, questions: list[dict]) -> list[dict]:
        self.calls += 1
        if self.calls % 2:
            raise ConnectionError("try again")
        return self.judge.answer(questions)


@query(
    "judged_within_budget",
    """WITH q AS (SELECT p_partkey AS row_id, p_name AS a, split_part(p_name, ' ', 1) AS b FROM part), d AS (SELECT DISTINCT a, b FROM q), k AS (SELECT *, row_number() OVER (ORDER BY sha256('{"a":"' || a || '","b":"' || b || '"}')) AS n FROM d)
SELECT row_id, CASE WHEN n <= 40 THEN 'yes' END AS verdict, CASE WHEN n <= 40 THEN 50.0::DOUBLE END AS confidence, CASE WHEN n > 40 THEN 'budget' END AS error FROM q JOIN k USING (a, b)""",
)
def judged_within_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal questions are asked once, calls are tried again, and a run asks no more than its budget."""
    pairs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), F.col("p_name").alias("a"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("b"))
    return adjudicate.ask(pairs, _Unsure(), ["a", "b"], budget=40).select("row_id", "verdict", "confidence", "error")


@query(
    "picked_candidates",
    """WITH a AS (SELECT p_partkey AS row_id, string_split(upper(p_name), ' ') AS w FROM part), c AS (SELECT p_partkey AS row_id, i AS rank, (p_partkey + i * 3) % (SELECT count(*) FROM part) AS src_id FROM part, range(1, 8) AS r(i)),
s AS (SELECT c.*, len(list_intersect(list_distinct(w), string_split(upper(p_name), ' '))) AS n, len(list_distinct(w)) AS m FROM c JOIN a USING (row_id) JOIN part ON p_partkey = src_id WHERE rank <= 5),
k AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY n DESC, rank) AS o FROM s) SELECT row_id, CASE WHEN n > 0 THEN src_id END AS src_id, CASE WHEN n > 0 THEN round_even(100.0 * n / m, 0) ELSE 0.0::DOUBLE END AS confidence, NULL::VARCHAR AS error FROM k WHERE o = 1""",
)
def picked_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A judge picks one of at most five candidates, or none."""
    part = table(spark, sf_dir, "part")
    n = part.count()
    asked = part.select(F.col("p_partkey").alias("row_id"), F.col("p_name").alias("name"))
    listed = part.select(F.col("p_partkey").alias("row_id"), F.explode(F.sequence(F.lit(1), F.lit(7))).alias("rank")).withColumn("src_id", (F.col("row_id") + F.col("rank") * 3) % n)
    candidates = listed.join(asked.withColumnRenamed("row_id", "src_id"), "src_id")
    return adjudicate.pick_candidates(asked, candidates, adjudicate.OverlapPicker())
