from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import brands, category, joins, match, report, rows, tfidf, vectors
from shelfwise.session import Scratch


def test_row_ids_are_consecutive(spark):
    df = rows.with_row_id(spark.range(0, 1000, 1, 7).where("id % 3 = 0"))
    got = [(r.id, r.row_id) for r in df.orderBy("id").collect()]
    assert [b for _, b in got] == list(range(len(got)))
    assert rows.with_row_id(spark.range(0)).count() == 0


def test_dedup(spark, rows):
    from shelfwise.operators import rows as R

    df = spark.createDataFrame([(1, "A b"), (2, "A b"), (3, "a  B!"), (4, None), (5, None)], "row_id long, t string")
    kept, removed = R.dedup_with_log(df, ["t"])
    assert rows(kept.select("row_id")) == [(1,), (4,)]
    assert rows(removed.select("row_id", "reason")) == [(2, "exact duplicate"), (3, "normalised duplicate"), (5, "exact duplicate")]
    again, none = R.dedup_with_log(kept, ["t"])
    assert again.count() == 2 and none.count() == 0
    both = R.restore_cache(spark.createDataFrame([("a", 1)], "k string, v int"), spark.createDataFrame([("a", 9), ("b", 2)], "k string, v int"), ["k"])
    assert rows(both) == [("a", 1), ("b", 2)]


def test_code_match_is_a_disjunction_of_columns(spark, rows):
    ours = spark.createDataFrame([(1, "A1", "x"), (2, None, "B2"), (3, "", "c")], "id long, sku string, ean string")
    theirs = spark.createDataFrame([(10, "b2", "a1"), (11, None, None), (12, "zz", "x")], "id long, code string, code2 string")
    got = joins.code_match(ours, theirs, "id", "id", ["sku", "ean"], ["code", "code2"])
    assert rows(got.select("our_id", "cust_id", "our_column", "cust_column")) == [(1, 10, "sku", "code2"), (1, 12, "ean", "code2"), (2, 10, "ean", "code")]


def test_bridge_skips_ambiguous_names(spark, rows):
    index = spark.createDataFrame([("1", 100), ("2", 200)], "bc string, src_id long")
    seen = spark.createDataFrame([("Milk", "1"), ("milk ", "01"), ("Tea", "1"), ("tea", "2"), ("Rice", None)], "material_name string, barcode string")
    assert rows(joins.name_bridge(seen, index)) == [("MILK", 100, "1")]


def test_band_candidates_equal_the_nested_loop(spark, rows):
    cust = [(i, k, b) for i, (k, b) in enumerate([("mass", 10), ("mass", None), (None, None), ("vol", 3)])]
    cat = [(i, k, b) for i, (k, b) in enumerate([("mass", 9), ("mass", 12), ("mass", None), (None, None), ("vol", 4), ("count", 3)])]
    got = rows(joins.band_candidates(spark.createDataFrame(cust, "row_id long, kind string, band int"), spark.createDataFrame(cat, "src_id long, kind string, band int")))
    want = sorted((r, s) for r, k, b in cust for s, kk, bb in cat if (b is not None and k == kk and bb is not None and abs(b - bb) <= 1) or (bb is None and kk in (k, None)))
    assert got == want


def test_full_scan_is_guarded(spark):
    many = spark.range(50).withColumnRenamed("id", "row_id")
    cat = spark.range(3).withColumnRenamed("id", "src_id")
    assert joins.full_candidates(many, cat, limit=50).count() == 150
    with pytest.raises(ValueError):
        joins.full_candidates(many, cat, limit=49)


def test_brand_gate(spark, rows):
    cust = spark.createDataFrame([(1, ["ALPHA"]), (2, []), (3, ["ZZZ"]), (4, ["XALPHAX"])], "row_id long, brands array<string>")
    cat = spark.createDataFrame([(1, ["ALPHA"])], "src_id long, brands array<string>")
    ok, barred = joins.brand_gate(cust, cat)
    assert rows(ok.select("row_id")) == [(1,), (2,), (4,)] and rows(barred.select("row_id")) == [(3,)]


def test_knn_equals_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8))
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "item_id long, embedding array<double>").repartition(3)
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:20] + 0.1)], "query_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): r.item_id for r in vectors.knn(asked, items, 4).collect()}
    u = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    best = np.argsort(-(u(x[:20] + 0.1) @ u(x).T), axis=1)[:, :4]
    assert got == {(q, k + 1): int(best[q, k]) for q in range(20) for k in range(4)}


def test_votes(spark):
    n = spark.createDataFrame([(1, 0.9, "a", 1, 10), (1, 0.8, "a", 2, 11), (1, 0.3, "b", 3, 12), (2, 0.5, "c", 1, 13), (2, 0.5, "d", 2, 14)], "query_id long, similarity double, label string, rank int, item_id long")
    got = {r.query_id: r for r in vectors.accept_vote(vectors.label_votes(n)).collect()}
    assert got[1].label == "a" and got[1].accepted and got[2].label == "c" and not got[2].accepted
    assert {r.query_id: r.accepted for r in vectors.majority(n, "label", 2, 0.5).collect()} == {1: True, 2: False}
    assert {r.query_id: r.accepted for r in vectors.accept_margin(n).collect()} == {1: True, 2: False}


def test_embedding_is_cached(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "t string")
    out, cache = vectors.embed_cached(df, "t", vectors.HashedGrams(16), None)
    assert out.count() == 4 and cache.count() == 3
    again, cache2 = vectors.embed_cached(spark.createDataFrame([("b",), ("c",)], "t string"), "t", vectors.HashedGrams(16), cache)
    assert again.count() == 2 and cache2.count() == 4


def test_word_grams(spark):
    assert spark.range(1).select(tfidf.word_grams(F.lit("ab x"), 3, 4)).first()[0] == [" ab", "ab ", " ab ", " x "]


def pair(spark, **over):
    base = dict(row_id=1, src_id=1, score=80.0, c_name="WHITE EGG", s_name="WHITE EGG", c_weight=100.0, s_weight=100.0, c_kind="mass", s_kind="mass", c_pack="", s_pack="", c_brands=["A"], s_brands=["A"], c_tokens=["WHITE", "EGG"], s_hier_tokens=["EGG"])
    base |= over
    schema = "row_id long, src_id long, score double, c_name string, s_name string, c_weight double, s_weight double, c_kind string, s_kind string, c_pack string, s_pack string, c_brands array<string>, s_brands array<string>, c_tokens array<string>, s_hier_tokens array<string>"
    return spark.createDataFrame([tuple(base[c.split()[0]] for c in schema.split(", "))], schema)


@pytest.mark.parametrize(
    "over,want",
    [({}, 89.0), ({"s_weight": 50.0}, 0.0), ({"s_name": "BROWN EGG"}, 59.0), ({"c_weight": None}, 84.0), ({"s_kind": "vol"}, 69.0), ({"c_pack": "12", "s_pack": "12"}, 92.0)],
)
def test_score_rules(spark, over, want):
    assert pair(spark, **over).select(match.adjust(F.col("score"))).first()[0] == want


def test_brand_rule(spark):
    both = pair(spark, score=95.0, s_brands=["B"]).unionByName(pair(spark, src_id=2, score=80.0))
    hard, soft = match.best_with_brand(both).first(), match.best_with_brand(both, soft=True).first()
    assert (hard.src_id, hard.reason) == (2, "ok") and (soft.src_id, soft.reason) == (1, "brand_mismatch_but_matched")
    assert match.best_with_brand(pair(spark, s_brands=["B"])).first().reason == "brand_mismatch"
    assert match.best_with_brand(pair(spark, c_brands=[], s_brands=[])).first().reason == "ok_no_brand"


def test_cascade_covers_every_customer_once(spark, sf_dir):
    from shelfwise.plans.queries import QUERIES
    from shelfwise.plans.inputs import customers

    got = QUERIES["band_blocked_match"](spark, sf_dir)
    ids = [r.row_id for r in got.select("row_id").collect()]
    assert sorted(ids) == sorted(r.row_id for r in customers(spark, sf_dir).select("row_id").collect())


def test_two_stage_min_and_mean(spark, rows):
    c = spark.createDataFrame([(1, 1, 90.0), (2, 2, 90.0)], "our_id long, cust_id long, score double")
    d = spark.createDataFrame([(1, 1, 86.0), (1, 2, 99.0), (3, 3, 99.0)], "our_id long, cust_id long, score double")
    assert rows(match.two_stage(c, d, 85, 85).select("our_id", "cust_id", "score")) == [(1, 1, 86.0)]
    assert match.two_stage(c, d, 85, 85, combine="mean").first().score == 88.0


def test_grey_zone_and_veto(spark):
    df = spark.createDataFrame([(80.0, "yes", 85), (80.0, "no", 99), (80.0, None, 0), (95.0, "no", 99)], "s double, v string, c int")
    s, d = match.adjudicate(F.col("s"), F.col("v"), F.col("c"))
    assert [tuple(r) for r in df.select(s, d).collect()] == [(85.0, "confirmed"), (0.0, "rejected"), (80.0, "kept"), (95.0, "kept")]
    r = spark.range(1).select(match.veto(F.lit(3), F.lit(True), F.lit(False), F.lit(99)), match.veto(F.lit(3), F.lit(True), F.lit(True), F.lit(60))).first()
    assert tuple(r) == (False, True)


def test_learned_barcodes_reach_later_labels_only(spark):
    index = spark.createDataFrame([("9", 9)], "bc string, src_id long")
    base = pair(spark).drop("row_id", "src_id", "score")
    rows_ = spark.createDataFrame([("A", 1, "5", 50, "Fuzzy", 95), ("B", 2, "5", 77, "Fuzzy", 80), ("A", 3, "9", 1, "Fuzzy", 99), ("A", 4, "6", 60, "Fuzzy", 88)], "label string, row_id long, bc string, src_id long, method string, confidence int")
    final, done = match.learn_in_order(index, rows_.join(base), ["A", "B"], Scratch(spark, "t"))
    found = {r.row_id: (r.src_id, r.found_by) for r in done.collect()}
    assert found == {1: (50, "Fuzzy"), 2: (50, "Barcode"), 3: (9, "Barcode"), 4: (60, "Fuzzy")}
    assert {r.bc: r.src_id for r in final.collect()} == {"9": 9, "5": 50}


def test_category_rules(spark):
    df = spark.createDataFrame([("MILK CHOCO BAR", None, None), ("FRESH MILK 1L", "DAIRY", None), ("CUP CAKE", None, None), ("CAKE MIX", None, None)], "n string, c string, b string")
    assert [r[0] for r in df.select(category.keyword_category(F.col("n"), F.col("c"), F.col("b"))).collect()] == [None, "DAIRY PRODUCT", "CAKES", None]
    tea = spark.createDataFrame([("Herbal Tea Bags",), ("GREEN TEA",), ("Coffee",), ("TEA",), ("Tea bag",), (None,)], "t string")
    assert [r[0] for r in tea.select(category.tea_category(F.col("t"))).collect()] == ["SPECIALITY TEA", "GREEN TEA", None, None, "TEA BAG", None]
    form = spark.createDataFrame([("Strawberry Jams", ["fruit preserve"]), ("Strawberry jam", ["fruit"]), ("Bread", ["x"])], "n string, o array<string>")
    assert [r[0] for r in form.select(category.form_supported(category.form_word(F.col("n")), F.col("o"))).collect()] == [True, False, True]


def test_brand_clusters(spark, rows):
    names = [("GOLDEN GARDEN", "M"), ("GOLDEN GARDEN.", "X"), ("GOLDEN GARDN", "X"), ("CAPRI", "X"), ("CAPRIO", "X"), ("WALTERS", "X"), ("WALKERS", "X")]
    src = spark.createDataFrame([(i, *n) for i, n in enumerate(names)], "row_id long, brand string, source_customer string").withColumn("material_name", F.col("brand"))
    counts = brands.brand_counts(src)
    keys = counts.groupBy("key").agg(F.min("brand").alias("position"))
    barred = spark.createDataFrame([("WALTERS", "WALKERS")], "a string, b string")
    mapping = brands.standardise(counts, brands.greedy_stars(keys, brands.close_keys(keys, barred, 85.0)), "M")
    got = {r.brand: r.standardized_brand for r in mapping.collect()}
    assert got["GOLDEN GARDEN."] == got["GOLDEN GARDN"] == "GOLDEN GARDEN" and got["WALTERS"] == "WALTERS" and got["CAPRIO"] == "CAPRIO"
    forced = spark.createDataFrame([("CAPRI", "CAPRI SUN")], "brand string, standardized_brand string")
    again = {r.brand: r.match_type for r in brands.standardise(counts, brands.greedy_stars(keys, brands.close_keys(keys)), "M", forced).collect()}
    assert again["CAPRI"] == "forced"


def test_brand_resolution_cascade(spark):
    generic = ["MILK"]
    confirmed = spark.createDataFrame([(1, "AL NOOR", "barcode", "G1"), (2, "NOOR", "barcode", "G2"), (3, "ZED", "llm", "G3")], "row_id long, brand string, brand_method string, mgrp string")
    d = brands.brand_dictionary(confirmed, generic)
    asked = spark.createDataFrame([(10, "G1", "x"), (11, "PURE NOOR", "x"), (12, "-", "AL NOOR MILK"), (13, "-", "MILK OF AL NOOR"), (14, "-", "ZED"), (15, "-", None)], "row_id long, mgrp string, desc string")
    got = {r.row_id: (r.brand, r.method) for r in brands.resolve_brands(asked, d, brands.group_consensus(confirmed, "mgrp", generic, "row_id"), generic, "row_id", "mgrp", "desc").collect()}
    assert got == {10: ("AL NOOR", "group_consensus"), 11: ("NOOR", "group_text"), 12: ("AL NOOR", "text_opening"), 13: ("AL NOOR", "text_scan"), 14: ("UNKNOWN", "unresolved"), 15: ("UNKNOWN", "unresolved")}


def test_report_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None)], "label string, hit int")
    got = {r.label: (r.n, r.k, r.pct) for r in report.summary(df, "label", {"n": F.count("*"), "k": F.count("hit")}, {"pct": ("k", "n")}).collect()}
    assert got == {"a": (2, 1, 50.0), "b": (1, 0, 0.0), "TOTAL": (3, 1, 33.33)}
    bands = {r.band: r.n for r in report.score_bands(spark.createDataFrame([(85.0,), (100.0,), (12.0,)], "s double"), "s", 85).collect()}
    assert bands == {"85-89": 1, "90-94": 0, "95-99": 0, "100": 1}
