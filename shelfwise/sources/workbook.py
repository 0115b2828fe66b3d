"""Spreadsheet files (Office Open XML) read with the standard library, many files in parallel.

A workbook is a zip of XML parts; a file is opened by one task, row by row, so only its
shared strings are held at once.  Cells come out as text, as nothing is inferred.
"""

from __future__ import annotations

import io
import itertools
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import Scratch, ship

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"


def column_number(reference: str) -> int:
    """Column of a cell reference, from 0: A1 is 0, AB7 is 27."""
    n = 0
    for c in re.match(r"[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_parts(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(sheet name, part) in the order of the workbook."""
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")).iter(f"{PACKAGE}Relationship")}
    sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{MAIN}sheet")
    return [(s.get("name"), "xl/" + targets[s.get(LINK)].removeprefix("/xl/").removeprefix("xl/")) for s in sheets]


def _shared(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    items = ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{MAIN}si")
    return ["".join(t.text or "" for t in i.iter(f"{MAIN}t")) for i in items]


def sheet_rows(book: zipfile.ZipFile, part: str, shared: list[str]) -> Iterator[tuple[int, list[str | None]]]:
    """(row number from 0, cells) of a sheet; gaps are null."""
    with book.open(part) as stream:
        for _, row in ElementTree.iterparse(stream):
            if row.tag != f"{MAIN}row":
                continue
            cells: list[str | None] = []
            for cell in row.iter(f"{MAIN}c"):
                at = column_number(cell.get("r")) if cell.get("r") else len(cells)
                cells += [None] * (at + 1 - len(cells))
                kind, value = cell.get("t"), cell.find(f"{MAIN}v")
                if kind == "inlineStr":
                    cells[at] = "".join(t.text or "" for t in cell.iter(f"{MAIN}t"))
                elif value is not None and value.text is not None:
                    cells[at] = shared[int(value.text)] if kind == "s" else value.text
            yield int(row.get("r", "1")) - 1, cells
            row.clear()


def read_workbooks(spark: SparkSession, path: str, sheet: str | None = None, batch_rows: int = 5000) -> DataFrame:
    """(file, sheet, row_no, cells) of all sheets, or of one, of the workbooks under a path."""
    ship(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                book = zipfile.ZipFile(io.BytesIO(content.as_buffer()))
                shared = _shared(book)
                for name, part in sheet_parts(book):
                    if sheet is not None and name != sheet:
                        continue
                    held: list[dict] = []
                    for number, cells in sheet_rows(book, part, shared):
                        held.append({"file": file, "sheet": name, "row_no": number, "cells": cells})
                        if len(held) == batch_rows:
                            yield pa.RecordBatch.from_pylist(held, SCHEMA)
                            held = []
                    if held:
                        yield pa.RecordBatch.from_pylist(held, SCHEMA)

    found = spark.read.format("binaryFile").load(path).select("path", "content")
    return found.mapInArrow(read, "file string, sheet string, row_no long, cells array<string>")


SCHEMA = pa.schema([("file", pa.string()), ("sheet", pa.string()), ("row_no", pa.int64()), ("cells", pa.list_(pa.string()))])


def list_sheets(spark: SparkSession, path: str) -> DataFrame:
    """(file, sheet, n_rows) of the workbooks under a path."""
    return read_workbooks(spark, path).groupBy("file", "sheet").agg(F.count("*").alias("n_rows"))


def as_table(cells: DataFrame, header_row: int = 0) -> DataFrame:
    """Columns of one sheet named by its header row, with row_no; only that row is looked at on the driver."""
    head = cells.where(F.col("row_no") == header_row).select("cells").first()
    names = [(h or f"unnamed_{i}").strip() for i, h in enumerate(head.cells if head else [])]
    body = cells.where(F.col("row_no") > header_row)
    return body.select("row_no", *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)])


#: Rows of a sheet, by the format.
MOST_ROWS = 1_048_576


def column_letters(n: int) -> str:
    """Letters of a column, from 0: the inverse of ``column_number``."""
    out, n = "", n + 1
    while n:
        n, rest = divmod(n - 1, 26)
        out = chr(65 + rest) + out
    return out


#: Rows of a sheet that are deflated together, and bytes of deflated rows that the driver holds.
BLOCK_ROWS, HELD_BYTES = 20_000, 32 << 20


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2) modulo that of crc32, bits reversed."""
    out, bit = 0, 1 << 31
    while bit:
        if a & bit:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        bit >>= 1
    return out


def crc_joined(first: int, second: int, length: int) -> int:
    """crc32 of two texts behind each other, from the crc32 of each and the second one's length in bytes."""
    shift, power, n = 1 << 31, 1 << 30, 8 * length  # the polynomials 1 and x
    while n:
        shift = _times(shift, power) if n & 1 else shift
        power, n = _times(power, power), n >> 1
    return _times(shift, first) ^ second


def _deflated(text: bytes, last: bool = False) -> bytes:
    """A piece of a deflate stream; pieces stand behind each other, and the last one ends the stream."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
    return squeeze.compress(text) + squeeze.flush(zlib.Z_FINISH if last else zlib.Z_FULL_FLUSH)


def _sheet_blocks(df: DataFrame, colour: str | None, style: dict[str, int], scratch: Scratch, label: str) -> DataFrame:
    """(block, data, crc, size, rows): the rows of a sheet as deflated XML, BLOCK_ROWS of them in a block, made by tasks."""
    from xml.sax.saxutils import escape

    names = [c for c in df.columns if c != colour]
    rows = df.select(F.array(*[F.col(f"`{c}`").cast("string") for c in names]).alias("cells"), (F.col(colour) if colour in df.columns else F.lit(None)).cast("string").alias("tint"))
    # Stored first, so that a task that runs again sees the same rows in the same places.
    stored = scratch.table(rows.withColumns({"_p": F.spark_partition_id(), "_m": F.monotonically_increasing_id()}), label)
    starts, total = {}, 0
    for p, n in sorted((r._p, r.n) for r in stored.groupBy("_p").agg(F.count("*").alias("n")).collect()):
        starts[p], total = total, total + n
    if total >= MOST_ROWS:
        raise ValueError(f"a sheet holds at most {MOST_ROWS} rows")
    table = F.create_map(*[F.lit(x).cast("long") for pair in starts.items() for x in pair]) if starts else F.lit(None).cast("map<bigint,bigint>")
    number = F.element_at(table, F.col("_p").cast("long")) + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)) + 2  # the header is row 1
    numbered = stored.select("cells", "tint", number.alias("n")).withColumn("block", F.floor((F.col("n") - 2) / BLOCK_ROWS))
    letters = [column_letters(j) for j in range(len(names))]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []

        def made() -> pa.RecordBatch:
            text = "".join(held).encode()
            values = ([block], [_deflated(text)], [zlib.crc32(text)], [len(text)], [len(held)])
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["block", "data", "crc", "size", "rows"])

        for batch in batches:
            for values, tint, n, own in zip(*(batch.column(c).to_pylist() for c in ("cells", "tint", "n", "block"))):
                if own != block and held:
                    yield made()
                    held = []
                block, s = own, style.get(tint, 0)
                cells = "".join(
                    f'<c r="{letters[j]}{n}"' + (f' s="{s}"' if s else "") + f' t="inlineStr"><is><t xml:space="preserve">{escape(_UNPRINTABLE.sub("", v))}</t></is></c>'
                    for j, v in enumerate(values) if v is not None
                )
                held.append(f'<row r="{n}">{cells}</row>')
        if held:
            yield made()

    dealt = numbered.repartition("block").sortWithinPartitions("block", "n")
    return scratch.table(dealt.mapInArrow(write, "block long, data binary, crc long, size long, rows long"), f"{label}-blocks")


def _windows(blocks: DataFrame, sizes: list[tuple[int, int]]) -> Iterator[bytes]:
    """The deflated blocks in order, fetched HELD_BYTES at a time (one block at least)."""
    at = 0
    while at < len(sizes):
        to, held = at, 0
        while to < len(sizes) and (to == at or held + sizes[to][1] <= HELD_BYTES):
            held, to = held + sizes[to][1], to + 1
        for r in blocks.where(F.col("block").between(sizes[at][0], sizes[to - 1][0])).orderBy("block").select("data").collect():
            yield bytes(r.data)
        at = to


class _Archive:
    """A zip file written front to back, of parts whose sizes are known before."""

    def __init__(self, write):
        self.write, self.at, self.directory = write, 0, []

    def _put(self, data: bytes) -> None:
        self.write(data)
        self.at += len(data)

    def add(self, name: str, crc: int, size: int, packed: int, pieces: Iterator[bytes]) -> None:
        """A deflated part; sizes beyond 32 bits go to the extra field, as the format has it."""
        raw, start, most = name.encode(), self.at, 0xFFFFFFFF
        large = size >= most or packed >= most
        extra = struct.pack("<HHQQ", 1, 16, size, packed) if large else b""
        common = struct.pack("<HHHHHIIIHH", 45 if large else 20, 0x800, 8, 0, 33, crc, most if large else packed, most if large else size, len(raw), len(extra))
        self._put(b"PK\3\4" + common + raw + extra)
        for piece in pieces:
            self._put(piece)
        far = start >= most
        if large or far:
            more = struct.pack("<QQQ", size, packed, start) if large else struct.pack("<Q", start)
            extra = struct.pack("<HH", 1, len(more)) + more
        head = struct.pack("<HHHHHHIIIHHHHHII", 45, 45 if large else 20, 0x800, 8, 0, 33, crc, most if large else packed, most if large else size, len(raw), len(extra), 0, 0, 0, 0, most if far or large else start)
        self.directory.append(b"PK\1\2" + head + raw + extra)

    def close(self) -> None:
        start, n = self.at, len(self.directory)
        for entry in self.directory:
            self._put(entry)
        size, end = self.at - start, self.at
        if start >= 0xFFFFFFFF:
            self._put(b"PK\6\6" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, start) + b"PK\6\7" + struct.pack("<IQI", 0, end, 1))
        self._put(b"PK\5\6" + struct.pack("<HHHHIIH", 0, 0, n, n, size, min(start, 0xFFFFFFFF), 0))


def write_workbook(sheets: dict[str, DataFrame], path: str, colour: str | None = None) -> None:
    """One workbook with a sheet for each frame, its columns as a header row, all cells as text.

    A sheet holds at most MOST_ROWS rows by its format; a larger frame is an error, not a cut.
    Tasks turn rows into deflated blocks; the driver puts blocks behind each other, a bounded
    part of them at a time, and works out the checksum of a sheet from theirs.  ``colour`` names a
    column of hexadecimal colours (RRGGBB, null for none) that is not written but fills its row.
    """
    from xml.sax.saxutils import escape, quoteattr

    some = next(iter(sheets.values()))
    spark = some.sparkSession
    ship(spark)
    scratch = Scratch(spark, "workbook")
    colours = sorted({r[0] for df in sheets.values() if colour in df.columns for r in df.select(colour).distinct().where(F.col(colour).isNotNull()).collect()}) if colour else []
    style = {c: i + 1 for i, c in enumerate(colours)}
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    main, rels = MAIN[1:-1], PACKAGE[1:-1]
    office = LINK[1 : LINK.index("}")]
    fills = "".join(f'<fill><patternFill patternType="solid"><fgColor rgb="FF{c}"/></patternFill></fill>' for c in colours)
    xfs = "".join(f'<xf fillId="{i + 2}" applyFill="1"/>' for i in range(len(colours)))
    parts = {
        "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
        '<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
        + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
        + "</Types>",
        "_rels/.rels": f'<Relationships xmlns="{rels}"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>' + "".join(f'<sheet name={quoteattr(name[:31])} sheetId="{i}" r:id="r{i}"/>' for i, name in enumerate(sheets, 1)) + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{rels}">' + "".join(f'<Relationship Id="r{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        + f'<Relationship Id="s" Type="{office}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><fonts><font/></fonts><fills><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>{fills}</fills>'
        f"<borders><border/></borders><cellXfs><xf/>{xfs}</cellXfs></styleSheet>",
    }
    made = [_sheet_blocks(df, colour, style, scratch, f"sheet-{i}") for i, df in enumerate(sheets.values(), 1)]
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    try:
        book = _Archive(lambda data: out.write(bytearray(data)))
        for name, text in parts.items():
            raw = (head + text).encode()
            packed = _deflated(raw, last=True)
            book.add(name, zlib.crc32(raw), len(raw), len(packed), iter([packed]))
        for i, (df, blocks) in enumerate(zip(sheets.values(), made), 1):
            names = [c for c in df.columns if c != colour]
            cells = "".join(f'<c r="{column_letters(j)}1" t="inlineStr"><is><t xml:space="preserve">{escape(_UNPRINTABLE.sub("", v))}</t></is></c>' for j, v in enumerate(names))
            opening, closing = f'{head}<worksheet xmlns="{main}"><sheetData><row r="1">{cells}</row>'.encode(), b"</sheetData></worksheet>"
            facts = blocks.select("block", F.length("data").alias("packed"), "crc", "size").orderBy("block").collect()
            first, last = _deflated(opening), _deflated(closing, last=True)
            crc, size = zlib.crc32(opening), len(opening)
            for f in [*((f.crc, f["size"]) for f in facts), (zlib.crc32(closing), len(closing))]:
                crc, size = crc_joined(crc, *f), size + f[1]
            packed = len(first) + sum(f.packed for f in facts) + len(last)
            book.add(f"xl/worksheets/sheet{i}.xml", crc, size, packed, itertools.chain([first], _windows(blocks, [(f.block, f.packed) for f in facts]), [last]))
        book.close()
    finally:
        out.close()
    scratch.drop()


_UNPRINTABLE = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")
