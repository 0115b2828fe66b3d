from __future__ import annotations

import random
from collections import defaultdict

import pytest

from shelfwise.operators import tfidf


def texts(rng, n):
    return [(i, " ".join(rng.choice(["common"] * 5 + ["rarely", "tea", "teapot", "green", f"u{i % 9}"]) for _ in range(rng.randrange(0, 6)))) for i in range(n)]


@pytest.mark.parametrize(("k", "probe", "least"), [(1, 8, 0.0), (3, 1, 0.0), (3, 8, 0.4), (200, 8, 0.0)])
def test_top_matches_equal_all_pairs(spark, monkeypatch, k, probe, least):
    """However little the first look meets, and ties at the k-th place."""
    monkeypatch.setattr(tfidf, "PROBE", probe)
    rng = random.Random(k)
    asked, items = texts(rng, 30), texts(rng, 60)
    a, b = spark.createDataFrame(asked, "q long, t string"), spark.createDataFrame(items, "i long, t string")
    got = sorted((r.query_id, r["rank"], r.item_id, r.similarity) for r in tfidf.top_matches(a, b, "q", "i", "t", "t", k, least).collect())
    tf = tfidf.counts(b, "i", "t")
    idf = tfidf.inverse_frequency(tf, tfidf.F.lit(len(items)))
    vectors = [defaultdict(dict), defaultdict(dict)]
    for side, of in zip(vectors, (tfidf.counts(a, "q", "t"), tf)):
        for r in tfidf.weights(of, idf).collect():
            side[r.id][r.gram] = r.w
    want = []
    for q, x in vectors[0].items():
        found = [(round(sum(w * y[g] for g, w in x.items() if g in y), 6), i) for i, y in vectors[1].items() if x.keys() & y.keys()]
        found = sorted(((s, i) for s, i in found if s >= least), key=lambda p: (-p[0], p[1]))[:k]
        want += [(q, n + 1, i, s) for n, (s, i) in enumerate(found)]
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)] and [g[3] for g in got] == pytest.approx([w[3] for w in sorted(want)], abs=2e-6)


def test_common_grams_are_left_out(spark):
    """A gram that every item has is joined by no query that has k matches by rarer ones."""
    items = [(i, f"common thing{i % 50} number{i % 50}") for i in range(400)]
    df = spark.createDataFrame(items, "i long, t string")
    tf = tfidf.counts(df, "i", "t")
    w = tfidf.weights(tf, tfidf.inverse_frequency(tf, tfidf.F.lit(400)))
    a, b = w.selectExpr("id AS query_id", "gram", "w AS qw"), w.selectExpr("id AS item_id", "gram", "w AS iw")
    a = tfidf.with_lists(a, b).cache()
    joined = tfidf.essential(a, tfidf.first_scores(a, b, 3))
    assert joined.select("query_id").distinct().count() == 400
    assert joined.where("gram IN ('com', 'omm', 'mmo', 'comm', 'ommon', ' com', ' co', 'mon')").isEmpty()
