from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.functions import scores

words = st.text(alphabet="abc ", max_size=14)


def plain_lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@given(words, words)
def test_lcs_equals_the_plain_recurrence(a, b):
    assert scores.lcs_length(a, b) == plain_lcs(a, b)


@given(words, words)
def test_scores_are_bounded_and_symmetric(a, b):
    for name, one in scores.SCORERS.items():
        assert 0 <= one(a, b) <= 100.0000001, name
        assert one(a, b) == pytest.approx(one(b, a)), name


@given(words)
def test_equal_texts_score_full(a):
    assert scores.ratio(a, a) == 100
    assert scores.token_sort_ratio(a, a) == 100
    if a.split():
        assert scores.token_set_ratio(a, a) == 100
        assert scores.weighted_ratio(a, a) == 100


@given(words, words)
def test_partial_ratio_equals_all_windows(a, b):
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if short:
        m = len(short)
        best = lambda x, y: max(scores.ratio(x, w) for w in (y[max(0, e - m) : e] for e in range(1, len(y) + m)) if w)
        want = max(best(short, long), best(long, short)) if len(short) == len(long) else best(short, long)  # of one length: either may be the shorter
        assert scores.partial_ratio(a, b) == pytest.approx(want)


def test_known_values():
    assert scores.ratio("this is a test", "this is a test!") == pytest.approx(96.5517, abs=1e-3)
    assert scores.token_sort_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 100
    assert scores.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert scores.partial_ratio("this is a test", "this is a test!") == 100


def test_columns(spark):
    df = spark.createDataFrame([("red apple 5", "apple green", [3.0, 4.0], [4.0, 3.0]), (None, "x", [0.0, 0.0], [1.0, 0.0])], "a string, b string, u array<double>, v array<double>")
    a, b = F.col("a"), F.col("b")
    out = df.select(scores.word_overlap(a, b), scores.length_ratio(a, b), scores.cosine(F.col("u"), F.col("v")), scores.score("ratio", a, b)).collect()
    assert out[0][0] == pytest.approx(1 / 3) and out[0][1] == pytest.approx(2 / 3) and out[0][2] == pytest.approx(0.96)
    assert out[1][0] == 0 and out[1][1] == 0 and out[1][2] is None and out[1][3] == 0


def test_blends(spark):
    df = spark.range(1).select(
        scores.gated_blend(F.lit(0.2), F.lit(1.0), F.lit(1.0), F.lit(1.0)).alias("closed"),
        scores.gated_blend(F.lit(0.5), F.lit(0.4), F.lit(1.0), F.lit(1.0)).alias("short"),
        scores.fuse(F.lit(0.5), F.lit(0.9), F.lit(False)).alias("other"),
        scores.fuse(F.lit(0.5), F.lit(0.9), F.lit(True)).alias("same"),
        scores.brand_strict(F.lit(1.0), F.lit("A"), F.lit("B"), F.lit(False), F.lit(True), F.lit(1.0))["score"].alias("clash"),
        scores.brand_strict(F.lit(1.0), F.lit("A"), F.lit("A"), F.lit(True), F.lit(True), F.lit(0.4))["score"].alias("mid"),
        scores.cosine_percent(F.lit(0.0)).alias("pct"),
    )
    r = df.first()
    assert (r.closed, r.other, r.clash, r.mid, r.pct) == (0.0, 0.9, 0.0, 0.88, 50.0)
    assert r.short == pytest.approx(0.82) and r.same == pytest.approx(0.64)


TEXT = st.text(alphabet="ab c12é", max_size=14) | st.text(alphabet="abc d", min_size=55, max_size=75) | st.sampled_from(["", " ", "a\0b", "x" * 70])


@settings(max_examples=120, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=30))
def test_many_pairs_at_once_score_as_one_by_one(pairs):
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    for name, one in scores.SCORERS.items():
        assert scores.MANY[name](a, b).tolist() == pytest.approx([one(x, y) for x, y in pairs], abs=1e-9), name
