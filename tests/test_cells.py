from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.functions import scores
from shelfwise.operators import cells, joins, match
from shelfwise.plans import queries

WORDS = st.lists(st.text(alphabet="abcé ", max_size=5), max_size=4).map(" ".join)


@settings(max_examples=250, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=6), st.lists(WORDS, min_size=1, max_size=6), st.sampled_from(sorted(scores.MANY)))
def test_no_score_is_over_its_bound(a, b, scorer):
    bound = cells.upper_bounds(scorer, cells.Names(a), cells.Names(b))
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            assert scores.SCORERS[scorer](x, y) <= bound[i, j], (x, y)


def test_common_letters():
    a, b = ["aab", "", "xyz", "日本日"], ["ba", "aaa", "日日日", "zz"]
    got = cells.common_letters(cells.Names(a), cells.Names(b))
    assert got.tolist() == [[sum(min(x.count(c), y.count(c)) for c in set(x)) for y in b] for x in a]


def names(rng, n, vocabulary):
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 6))) for _ in range(n)]


@pytest.mark.parametrize(("most_left", "most_right"), [(4096, 16384), (3, 5)])
@pytest.mark.parametrize("least", [60.0, 85.0])
def test_pairs_from_loses_none(spark, least, most_left, most_right):
    rng = random.Random(5)
    a, b = (sorted(set(names(rng, 60, ["green", "grean", "tea", "teas", "black", "bag", "bags", "20", "x"]))) for _ in range(2))
    left = cells.length_keys(spark.createDataFrame([(x,) for x in a], "c_name string"), "c_name", least, True)
    right = cells.length_keys(spark.createDataFrame([(x,) for x in b], "s_name string"), "s_name", least, False)
    got = sorted(tuple(r) for r in cells.pairs_from(left, right, "token_sort", least, True, most_left, most_right).collect())
    want = sorted((x, y, scores.token_sort_ratio(x, y)) for x in a for y in b if scores.token_sort_ratio(x, y) >= least)
    assert got == want


def plain_rule(left, right):
    return lambda score, where: score if where is None else score


@pytest.mark.parametrize("sizes", [(4096, 16384), (2, 3)])
def test_best_matches_equal_all_scores(spark, monkeypatch, sizes):
    monkeypatch.setattr(cells, "BLOCK", 4)
    rng = random.Random(8)
    a, b = names(rng, 40, ["milk", "milks", "choc", "bar", "dark"]), names(rng, 40, ["milk", "chocs", "bar", "bars", "dark"])
    left = spark.createDataFrame([(i, x, str(i % 3) if i % 7 else None) for i, x in enumerate(a)], "row_id long, name string, key string")
    right = spark.createDataFrame([(i, x, str(i % 3)) for i, x in enumerate(b)], "src_id long, name string, key string")
    got = {r.row_id: (r.src_id, r.score) for r in cells.best_matches(left, right, "ensemble", plain_rule, 40.0, False, *sizes).collect()}
    want = {}
    for i, x in enumerate(a):
        scored = [(scores.ensemble(x, y), -j) for j, y in enumerate(b) if i % 7 and j % 3 == i % 3]
        if scored and max(scored)[0] >= 40:
            want[i] = (-max(scored)[1], max(scored)[0])
    assert {k: (s, pytest.approx(x)) for k, (s, x) in got.items()} == want


def test_rising_threshold_equals_all_candidates(spark, sf_dir):
    """Same rows as scoring every band candidate, with under a tenth of the scores."""
    cust, cat = queries._prepared(spark, sf_dir)
    allowed, _ = joins.brand_gate(cust, cat)
    allowed, cat = allowed.cache(), cat.cache()
    found = match.best_of_bands(allowed, cat).cache()
    pairs = joins.band_candidates(allowed, cat)
    every = match._best_of(pairs, allowed, cat, 75.0, "ensemble", False)
    key = lambda df: sorted((r.row_id, r.src_id, round(r.score, 9), r.reason) for r in df.collect())
    assert key(found) == key(every) and len(key(found)) > 100
    assert found.agg({"n_scored": "sum"}).first()[0] * 10 < pairs.count()


def test_adjusting_equals_the_column_rule(spark):
    """The rule on blocks and the rule on columns, over nulls, kinds, packs, variants and hierarchy words."""
    rng = random.Random(2)
    side = lambda n: [(rng.choice(["diet cola", "cola", "sugar free tea", "tea", ""]), rng.choice([None, 0.0, 100.0, 101.0, 500.0]), rng.choice([None, "G", "ML"]), rng.choice([None, "", "6", "12"]), rng.sample(["tea", "cola", "cold"], 2)) for _ in range(n)]
    a, b = side(12), side(12)
    rows = [(i * 100 + j, *x, *y, float(rng.randrange(0, 101))) for i, x in enumerate(a) for j, y in enumerate(b)]
    schema = ", ".join(f"{s}_{c}" for s, t in (("c", "tokens"), ("s", "hier_tokens")) for c in ("name string", "weight double", "kind string", "pack string", f"{t} array<string>"))
    df = spark.createDataFrame(rows, f"id long, {schema}, score double")
    want = {r.id: r.x for r in df.select("id", match.adjust(df.score).alias("x")).collect()}
    variants = {r.n: r.v for r in spark.createDataFrame([(x[0],) for x in a + b], "n string").select("n", match.variant_words(match.tokens(match.F.col("n"))).alias("v")).collect()}
    block = lambda s, t: {"weight": [x[1] for x in s], "kind": [x[2] for x in s], "pack": [x[3] for x in s], t: [x[4] for x in s], "variants": [variants[x[0]] for x in s]}
    grid = np.asarray([r[-1] for r in rows]).reshape(12, 12)
    got = match.adjusting(block(a, "tokens"), block(b, "hier_tokens"))(grid, None)
    assert all(got[k // 100, k % 100] == x for k, x in want.items())


def test_token_overlaps_equal_the_column_rule(spark):
    words = ["NESTLE", "NESTLES", "STLES", "NEST", "KITKAT", "MYKITKAT", "KITKA", "ABCDE", "ABCDEX", "XABCDE", "A", "B"]
    got = match.token_overlaps(words, words)
    df = spark.createDataFrame([(i, j, [a], [b]) for i, a in enumerate(words) for j, b in enumerate(words)], "i int, j int, a array<string>, b array<string>")
    assert all(bool(got[r.i, r.j]) == r.x for r in df.select("i", "j", match.brands_overlap(df.a, df.b).alias("x")).collect())


@pytest.mark.parametrize(("least", "share", "sizes"), [(1, 256, None), (1, 6, (5, 7)), (2, 3, None), (3, 10**6, (5, 7))])
def test_shared_tokens_lose_no_pair(spark, monkeypatch, least, share, sizes):
    """Whatever share of the tokens is heavy, and however rows are dealt; sums are those of the pairs."""
    monkeypatch.setattr(cells, "HEAVY_SHARE", share)
    monkeypatch.setattr(cells, "BLOCK", 8)
    if sizes:
        deal = cells.deal
        monkeypatch.setattr(cells, "deal", lambda a, b: deal(a, b, *sizes))
    rng = random.Random(4)
    bag = ["HOT"] * 6 + ["WARM"] * 3 + [f"T{i}" for i in range(25)]
    a, b = ([(i, [rng.choice(bag) for _ in range(rng.randrange(0, 6))]) for i in range(40)] for _ in range(2))
    left, right = spark.createDataFrame(a, "row_id long, tokens array<string>"), spark.createDataFrame(b, "src_id long, tokens array<string>")
    want = sorted((i, j, len(set(x) & set(y))) for i, x in a for j, y in b if len(set(x) & set(y)) >= least)
    assert sorted(tuple(r) for r in joins.token_candidates(left, right, least).select("row_id", "src_id", "n_shared").collect()) == want
    sums = {r.row_id: (r.n_candidates, r.id_sum, r.n_shared) for r in joins.token_candidate_sums(left, right, least).collect()}
    assert sums == {i: tuple(sum(x) for x in zip(*[(1, j, n) for k, j, n in want if k == i])) for i, _, _ in want}
