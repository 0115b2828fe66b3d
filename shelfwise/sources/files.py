"""File readers: delimited text, sheets, HTML tables, parquet caches, tables; and the header rules."""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import fixed
from shelfwise.functions.text import clean_header, normalize
from shelfwise.operators.rows import union_all
from shelfwise.session import written

ENCODINGS = ("utf-8", "utf-8-sig", "latin-1", "cp1252")


def read_delimited(spark: SparkSession, path: str, sep: str = ",", header: bool = True, encoding: str = "utf-8", drop_empty: bool = True, multiline: bool = False) -> DataFrame:
    """All columns as strings; separators may have several characters; rows of nulls only are dropped.

    ``multiline`` allows line feeds inside quotes, at the cost that a file is read by one task.
    """
    name = {"utf-8-sig": "utf-8", "latin-1": "ISO-8859-1", "cp1252": "windows-1252"}.get(encoding, encoding)
    df = spark.read.csv(path, sep=sep, header=header, inferSchema=False, encoding=name, multiLine=multiline)
    return df.na.drop("all") if drop_empty else df


def pick_encoding(spark: SparkSession, path: str, sample: int = 1 << 20) -> str:
    """The first encoding of the list that decodes the heads of all files without error."""

    @F.pandas_udf("int")
    def first(heads: pd.Series) -> pd.Series:
        return heads.map(lambda raw: ENCODINGS.index(encoding_of(bytes(raw), len(raw) == sample)))

    heads = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, sample).alias("head"))
    found = heads.agg(F.max(first("head")).alias("k")).first()
    return ENCODINGS[found.k or 0]


def encoding_of(raw: bytes, cut_off: bool = False) -> str:
    """The first encoding of the list that decodes some bytes; if they are cut off, the end may lie inside a character."""
    for encoding in ENCODINGS:
        for cut in range(4 if cut_off else 1):
            try:
                raw[: len(raw) - cut].decode(encoding)
                return "utf-8-sig" if encoding == "utf-8" and raw.startswith(b"\xef\xbb\xbf") else encoding
            except UnicodeDecodeError:
                continue
    return ENCODINGS[-1]


def read_any_encoding(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return read_delimited(spark, path, sep, encoding=pick_encoding(spark, path))


def sniff_format(head: Column) -> Column:
    """Format by the first bytes (binary): zip workbook, legacy workbook, html, xml, else text."""
    start = F.lower(F.ltrim(head.cast("string"), F.lit(" \t\r\n\x0b\x0c")))
    return (
        F.when(head.startswith(F.lit(b"PK")), "xlsx")
        .when(head.startswith(F.lit(b"\xd0\xcf\x11\xe0")), "xls")
        .when(start.startswith("<html") | start.startswith("<!doctype html") | start.startswith("<table"), "html")
        .when(start.startswith("<?xml"), "xml")
        .otherwise("text")
    )


def sniff_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, format) of all files under a path."""
    return spark.read.format("binaryFile").load(path).select("path", sniff_format(F.substring("content", 1, 256)).alias("format"))


class _Tables(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.rows: list[list[str]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            if not self.rows:
                self.rows.append([])
            self.cell = []

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th") and self.cell is not None:
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)


def html_rows(html: str | None) -> list[list[str]]:
    """Cells of all table rows of a page."""
    parser = _Tables()
    parser.feed(html or "")
    return [r for r in parser.rows if r]


def read_html_tables(pages: DataFrame, id_col: str, html: str) -> DataFrame:
    """(id, row_no, cells) of tables in pages, a text column of HTML."""

    @F.pandas_udf("array<array<string>>")
    def rows(s):  # noqa: ANN001, ANN202
        return s.map(html_rows)

    return pages.select(F.col(id_col).alias("id"), F.posexplode(rows(html)).alias("row_no", "cells"))


def read_sheets(spark: SparkSession, sheets: dict[str, DataFrame], file_name: str) -> DataFrame:
    """Sheets with the superset of columns, and where each row comes from."""
    return union_all([df.withColumns({"_source_file": F.lit(file_name), "_source_sheet": F.lit(name)}) for name, df in sheets.items()])


def read_excel(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """One sheet through a spreadsheet data source, where the cluster has one; a clear error where not."""
    for source in ("com.crealytics.spark.excel", "excel"):
        try:
            reader = spark.read.format(source).option("header", "true").option("inferSchema", "false")
            return (reader.option("dataAddress", f"'{sheet}'!A1") if sheet else reader).load(path)
        except Exception as e:  # noqa: BLE001
            if "DATA_SOURCE_NOT_FOUND" not in str(e) and "ClassNotFound" not in str(e):
                raise
    raise RuntimeError("no spreadsheet data source on this cluster: export the sheet as delimited text")


def read_with_fallback(readers: list[tuple[str, Callable[[], DataFrame]]]) -> tuple[str, DataFrame]:
    """The first reader that works, and its name."""
    errors = []
    for name, read in readers:
        try:
            return name, read()
        except Exception as e:  # noqa: BLE001
            errors.append(f"{name}: {str(e).splitlines()[0] if str(e) else type(e).__name__}")
    raise RuntimeError("no reader could open the source; " + "; ".join(errors))


def with_lineage(df: DataFrame) -> DataFrame:
    return df.withColumn("_source_file", F.col("_metadata.file_name"))


def find_header(df: DataFrame, wanted: str, rows: int = 30) -> tuple[int, list[str]] | None:
    """Number and cells of the first of the leading rows in which a cell equals the wanted name; only those rows are read."""
    target = " ".join(wanted.lower().split())
    for i, row in enumerate(df.limit(rows).collect()):
        cells = ["" if v is None else str(v).strip() for v in row]
        if any(" ".join(c.lower().split()) == target for c in cells):
            return i, cells
    return None


def apply_header_row(df: DataFrame, number: int, cells: list[str], row_id: str = "row_id") -> DataFrame:
    """Rows below the header row, named by its cells; ``df`` has a row id besides the cells."""
    plain = [c for c in df.columns if c != row_id]
    names = [c or f"unnamed_{i}" for i, c in enumerate(cells)]
    return df.where(F.col(row_id) > number).select(row_id, *[F.col(c).alias(n) for c, n in zip(plain, names)])


def by_position(df: DataFrame, skip: int, column: int, name: str, row_id: str = "row_id") -> DataFrame:
    """One column by its place, below ``skip`` rows."""
    plain = [c for c in df.columns if c != row_id]
    return df.where(F.col(row_id) >= skip).select(row_id, F.col(plain[column]).alias(name)).where(F.col(name).isNotNull())


#: How each kind of customer feed is read: description columns (joined), brand column, code column, and, where the
#: description is found by its place, that place.
FEEDS = {
    "plain": {"description": ["Product name"], "brand": "Brand", "code": "Item barcode"},
    "items": {"description": ["Item Name"], "brand": "Brand", "code": "BARCODE"},
    "named": {"description": ["Product name"], "brand": "Brand", "code": None},
    "lower": {"description": ["product name"], "brand": "BRAND", "code": None},
    "placed": {"description": [4], "brand": "Brand", "code": None},
    "family": {"description": ["Retail Article Brand Description Text", "Family Text"], "brand": "Retail Article Brand Description Text", "code": None},
}


def read_feed(df: DataFrame, feed: dict, label: str) -> DataFrame:
    """(source_customer, material_name, brand, barcode): upper-case description without nulls, first of equal ones (row_id)."""
    plain = [c for c in df.columns if c != "row_id"]
    wanted = [plain[c] if isinstance(c, int) else c for c in feed["description"]]
    named = df.select(
        "row_id",
        F.lit(label).alias("source_customer"),
        F.nullif(F.upper(F.concat_ws(" ", *[F.trim(F.col(f"`{c}`")) for c in wanted])), F.lit("")).alias("material_name"),
        F.col(f"`{feed['brand']}`").alias("brand"),
        (F.col(f"`{feed['code']}`").cast("string") if feed["code"] else F.lit(None).cast("string")).alias("barcode"),
    )
    from shelfwise.operators.rows import keep_first

    return keep_first(named.where("material_name is not null"), ["material_name"])


def conversion_cache(spark: SparkSession, path: str, cache_dir: str, read: Callable[[], DataFrame]) -> DataFrame:
    """Parquet copy of a source, kept under a key of the files' paths, sizes and times; read once per state of the files."""
    status = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    line = F.concat_ws("|", "path", "length", F.col("modificationTime").cast("string"))
    parts = [F.sum(F.xxhash64(F.lit(seed), line).cast("decimal(38,0)")) for seed in (1, 2)]  # no order, no list of files
    key = status.agg(F.sha2(F.concat_ws("|", F.count("*"), *parts), 256).alias("k")).first().k[:20]
    target = f"{cache_dir.rstrip('/')}/{key}"
    if not written(spark, target):
        read().write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None, where: str | None = None, url: str | None = None, properties: dict | None = None) -> DataFrame:
    """A catalogue or JDBC table; columns and filter are pushed to the source."""
    df = spark.read.jdbc(url, name, properties=properties or {}) if url else spark.table(name)
    df = df.where(where) if where else df
    return df.select(*columns) if columns else df


# ---- header rules ---------------------------------------------------------------------


def matches_any(name: str, patterns: list[str]) -> bool:
    return any(re.search(p, name.strip(), re.I) for p in patterns)


def column_groups(columns: list[str]) -> dict[str, list[str]]:
    """Columns that hold codes, categories and descriptions; a column belongs to the first group that fits, brand columns to none."""
    groups: dict[str, list[str]] = {"code": [], "category": [], "description": []}
    for c in columns:
        if matches_any(c, fixed.CODE_HEADERS):
            groups["code"].append(c)
        elif matches_any(c, fixed.CATEGORY_HEADERS):
            groups["category"].append(c)
        elif matches_any(c, fixed.DESCRIPTION_HEADERS) and not matches_any(c, fixed.BRAND_HEADERS):
            groups["description"].append(c)
    return groups


def pick_column(columns: list[str], patterns: list[str]) -> str | None:
    """The first column that fits the earliest pattern."""
    return next((c for p in patterns for c in columns if re.search(p, c.strip(), re.I)), None)


def find_column(columns: list[str], keywords: list[str]) -> str | None:
    """The first column whose clean name contains a keyword."""
    return next((c for c in columns if any(k in clean_header(c) for k in keywords)), None)


def drop_unnamed(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.lower().startswith("unnamed")])


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def clean_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_header(c) for c in df.columns])


def sql_name(header: str) -> str:
    return re.sub(r"\W+", "_", header.strip()).strip("_").lower()


def taxonomy(spark: SparkSession, names: list[str]) -> DataFrame:
    """(category, key) of a list of category names, without repeats."""
    rows = spark.createDataFrame([(n,) for n in dict.fromkeys(n.strip() for n in names if n and n.strip())], "category string")
    return rows.withColumn("key", normalize(F.col("category")))
