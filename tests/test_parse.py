from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import parse
from shelfwise.functions.barcode import normalize_barcode
from shelfwise.functions.brand import brand_from_name, brand_key, brand_label, brand_tokens, brands_overlap, variant_conflict

GOLDEN = [
    ("TIFFANY DIGESTIVE NATURAL 6X3X250G", 250.0, "mass", "6X3"),
    ("TIFF CREAM EVDAY CHOCO 4X6X 90G", 90.0, "mass", "4X6"),
    ("ROYAL CLASSIC BUTTER COOKIES 454GX12", 454.0, "mass", "12"),
    ("DEEMAH DIGESTIVE BISCUIT 1X24X230GR", 230.0, "mass", "1X24"),
    ("TIFF CREAM EVDAY STRWBRY 24X84G WS", 84.0, "mass", "24"),
    ("SANDWICH BISCUITS CHOCOLATE 90GR X 24", 90.0, "mass", "24"),
    ("TIFF GLUCOSE MILK AND HONEY BISC 4X12X50", None, None, "4X12X50"),
]


@pytest.mark.parametrize("text,weight,kind,pack", GOLDEN)
def test_golden_descriptions(spark, text, weight, kind, pack):
    p = spark.createDataFrame([(text,)], "t string").select(parse.parse_description(F.col("t")).alias("p")).first().p
    assert (p.weight, p.kind, p.pack) == (weight, kind, pack)


def test_names_and_nulls(spark):
    df = spark.createDataFrame([("BISC CHOC (123456) 90G",), (None,), ("",), ("a&b 2KG 500G",)], "t string")
    out = [r.p for r in df.select(parse.parse_description(F.col("t")).alias("p"), parse.parse_description(F.col("t"), "last")["weight"].alias("l")).collect()]
    assert out[0].name == "BISCUIT CHOCOLATE" and out[1].name == "" and out[1].weight is None
    assert out[3].name == "AandB" and out[3].weight == 500.0


def test_weights(spark):
    df = spark.createDataFrame([(100.0, 99.0), (100.0, 90.0), (None, 5.0), (0.0, 5.0)], "a double, b double")
    out = df.select(parse.weights_match(F.col("a"), F.col("b")).alias("m"), parse.size_band(F.col("a")).alias("s"), parse.weight_label(F.col("a"), F.col("b")).alias("l")).collect()
    assert [r.m for r in out] == [True, False, None, None]
    assert [r.s for r in out] == [40, 40, None, None]
    assert out[0].l == "Matched – both 100.0" and out[2].l == "Customer only – 5.0"
    w = spark.createDataFrame([("1.5 kg",), ("2 oz",), ("30 cl",), ("7",), ("x",), (None,)], "w string")
    assert [r.v for r in w.select(parse.normalize_weight(F.col("w")).alias("v")).collect()] == [1500.0, 56.7, 300.0, None, None, None]
    assert spark.range(1).select(parse.normalize_pack(F.lit("24x"))).first()[0] == "24"


def test_barcodes(spark):
    df = spark.createDataFrame([("0629 111-2.0",), ("nan",), ("6.29e12",), ("0",), (None,), ("00123",)], "b string")
    assert [r[0] for r in df.select(normalize_barcode(F.col("b"))).collect()] == ["6291112", None, "6290000000000", None, None, "123"]
    assert [r[0] for r in df.select(normalize_barcode(F.col("b"), "padded")).collect()][-1] is None
    assert [r[0] for r in df.select(normalize_barcode(F.col("b"), "compact")).collect()][0] == "06291112.0"
    with pytest.raises(ValueError):
        normalize_barcode(F.col("b"), "other")


def test_brands(spark):
    df = spark.createDataFrame([("Foster Clark's", ["FOSTERCLARK"], "X - AL NOOR IMP"), (None, [], None), ("AL", ["ALPHA"], "AL-NOOR")], "b string, o array<string>, k string")
    out = df.select(brand_tokens(F.col("b")).alias("t"), brands_overlap(brand_tokens(F.col("b")), F.col("o")).alias("x"), brand_key(F.col("k")).alias("k")).collect()
    assert "FOSTERCLARK" in out[0].t and out[0].x and out[0].k == "ALNOOR" == out[2].k
    assert out[1].t == [] and not out[1].x and out[2].t == []
    r = spark.range(1).select(
        brand_from_name(F.lit("FRESH NADEC MILK")).alias("n"),
        brand_label(F.lit("a b"), F.lit("b a"), F.lit(100.0)).alias("l"),
        brand_label(F.lit("nan"), F.lit("x"), F.lit(0.0)).alias("na"),
        variant_conflict(F.array(F.lit("WHITE")), F.array(F.lit("BROWN"))).alias("c"),
        variant_conflict(F.array(F.lit("WHITE")), F.array(F.lit("EGG"))).alias("ok"),
    ).first()
    assert r.n == ["NADEC"] and r.l == "Fuzzy" and r.na == "N/A" and r.c and not r.ok
