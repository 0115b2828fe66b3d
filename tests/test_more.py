from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import parse, text
from shelfwise.operators import adjudicate
from shelfwise.sources import workbook


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "t string").select(make(F.col("t")).alias("x")).first().x


@pytest.mark.parametrize(
    "raw,want",
    [
        ("AMCANA CKN NUGGETS 12X400GM", "americana chicken nuggets 12 x 400 g"),
        ("Londondairy Choco 500 ML (2 free)", "london dairy chocolate 500 ml"),
        ("The ORNGE Juice 1 Ltr 20% off", "orange juice 1 l"),
        (None, ""),
    ],
)
def test_retail_text(spark, raw, want):
    assert one(spark, raw, text.retail_text) == want


def test_names_and_brands(spark):
    assert one(spark, "The Fresh Milk of 2 Litres & x", text.normalize_name) == "milk"
    got = one(spark, "old el paso nachos", lambda c: text.extract_brand(c, ["old el paso"]))
    assert (got.brand, got["product"]) == ("old el paso", "nachos")
    got = one(spark, "ame burger", lambda c: text.extract_brand(c, ["americana"], {"ame": "americana"}))
    assert (got.brand, got["product"]) == ("americana", "burger")
    got = one(spark, "plain", lambda c: text.extract_brand(c, ["x"]))
    assert got.brand is None and got["product"] == "plain"


def test_hints_numbers_and_answers(spark):
    df = spark.createDataFrame([("a", "nan", " b "), (None, None, None)], "x string, y string, z string")
    out = df.select(text.hint_text(F.col("x"), F.col("y"), F.col("z")).alias("t"), text.hint_map({"x": F.col("x"), "y": F.col("y")}).alias("m"), text.first_filled(F.col("y"), F.col("z")).alias("f")).collect()
    assert (out[0].t, out[0].m, out[0].f) == ("a | b", {"x": "a"}, "b") and (out[1].t, out[1].m, out[1].f) == ("", {}, None)
    n = spark.createDataFrame([("0.8",), ("true",), (None,), ("x",)], "v string")
    assert [r[0] for r in n.select(text.safe_float(F.col("v"))).collect()] == [0.8, 0.0, 0.0, 0.0]
    j = spark.createDataFrame([('{"match": "yes"}',), ('Sure! {"match": "no"} ok',), ("nothing",), (None,)], "v string")
    assert [r[0] and r[0]["match"] for r in j.select(text.json_answer(F.col("v"), "match string")).collect()] == ["yes", "no", None, None]


@pytest.mark.parametrize(
    "raw,mode,want",
    [
        ("Milk 2kg 500 g 4x6x", "last", ("milk 2kg", "4x6", "500g")),
        ("Tea 4x12x50g", "packed", ("tea", "", "50g")),
        ("Tea 25gx16 box", "packed", ("tea box", "", "25g")),
        ("Rice 2x 5kg", "packed", ("rice", "", "5kg")),
        ("Bar 24x81g", "bounded", ("bar", "24", "81g")),
        (None, "last", ("", "", "")),
    ],
)
def test_loose_parsing(spark, raw, mode, want):
    assert tuple(one(spark, raw, lambda c: parse.parse_loose(c, mode))) == want


@pytest.mark.parametrize("raw,want", [("888 TOMATO PASTE (308203)", "TOMATO PASTE"), ("500GR FLOUR (400G X 2) [new]", "500GR FLOUR 400G X 2 new"), ("30005-20081 THERMISTOR", "THERMISTOR"), (None, "")])
def test_description_cleaning(spark, raw, want):
    assert one(spark, raw, parse.clean_description) == want


def test_workbooks(spark, tmp_path):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main}><sheets><sheet name="Items" r:id="r1"/><sheet name="Two" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>Name</t></si><si><r><t>Mi</t></r><r><t>lk</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {main}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>Code</t></is></c></row><row r="3"><c r="A3" t="s"><v>1</v></c><c r="C3"><v>0629</v></c></row></sheetData></worksheet>')
        z.writestr("xl/worksheets/sheet2.xml", f"<worksheet {main}><sheetData><row><c><v>7</v></c></row></sheetData></worksheet>")
    assert {(r.sheet, r.n_rows) for r in workbook.list_sheets(spark, f"{tmp_path}/*.xlsx").collect()} == {("Items", 2), ("Two", 1)}
    table = workbook.as_table(workbook.read_workbooks(spark, f"{tmp_path}/*.xlsx", "Items"))
    assert table.collect()[0].asDict() == {"row_no": 2, "Name": "Milk", "unnamed_1": None, "Code": "0629"}
    assert [workbook.column_number(r) for r in ("A1", "Z9", "AB7")] == [0, 25, 27]


class Failing:
    def answer(self, questions):
        raise OSError("down")


def test_judges(spark):
    df = spark.createDataFrame([(1, "RED TEA", "red tea"), (2, "RED TEA", "red tea"), (3, "A", "B")], "row_id long, a string, b string")
    got = {r.row_id: (r.verdict, r.confidence, r.error) for r in adjudicate.ask(df, adjudicate.RuleJudge(), ["a", "b"]).collect()}
    assert got == {1: ("yes", 100.0, None), 2: ("yes", 100.0, None), 3: ("no", 0.0, None)}
    failed = adjudicate.ask(df, Failing(), ["a", "b"], attempts=2).collect()
    assert all(r.verdict is None and "down" in r.error for r in failed) and len(failed) == 3
    assert all(r.error == "budget" for r in adjudicate.ask(df, adjudicate.RuleJudge(), ["a", "b"], budget=0).collect())
    checked = adjudicate.second_opinion(adjudicate.ask(df, adjudicate.RuleJudge(), ["a", "b"]), adjudicate.ask(df, adjudicate.RuleJudge(), ["a", "b"]))
    assert {r.row_id: r.verified for r in checked.collect()} == {1: True, 2: True, 3: False}
    allowed = spark.createDataFrame([("yes",)], "category string")
    assert {r.row_id: r.verdict for r in adjudicate.valid_only(checked, allowed).collect()} == {1: "yes", 2: "yes", 3: None}


def test_backoff_and_answers():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("no")
        return "ok"

    assert adjudicate.with_backoff(flaky, sleep=waits.append) == "ok" and len(waits) == 2 and waits[1] > waits[0]
    with pytest.raises(adjudicate.CallFailed):
        adjudicate.with_backoff(lambda: 1 / 0, attempts=2, sleep=waits.append)
    assert adjudicate.parse_items('{"items": [{"a": 1}]}') == [{"a": 1}] == adjudicate.parse_items('x {"a": 1} y') == adjudicate.parse_items('{"a": 1}')
    assert adjudicate.parse_items("nothing") == []
