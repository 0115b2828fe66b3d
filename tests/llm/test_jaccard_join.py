from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.llm import jaccard_join
from shelfwise.llm.jaccard_join import Lists, class_bounds, class_counts, least_overlap

SCHEMA = "doc_id long, text string, key long, comp long, tile string"


def shingles(text, size=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def plain(rows, percent=90, size=3):
    """(doc_id, n_shingles, component_id) by comparing all with all."""
    sets = [shingles(t, size) for _, t in rows]
    live = [i for i, (d, _) in enumerate(rows) if d is not None and sets[i]]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in live:
        for j in live:
            if i < j and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i in live:
        least[top(i)] = min(least.get(top(i), rows[i][0]), rows[i][0])
    return sorted(((d, len(sets[i]), least[top(i)] if i in set(live) else d) for i, (d, _) in enumerate(rows)), key=repr)


def joined(spark, rows, parts=3, **given):
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(parts)
    out = jaccard_join.jaccard_components(docs, **given).select("doc_id", "n_shingles", "component_id")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def edited(words, rng, n):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


SETS = st.lists(st.sets(st.integers(0, 40), max_size=30), max_size=12)


@settings(max_examples=300, deadline=None)
@given(SETS, st.sets(st.integers(0, 40), min_size=1, max_size=30), st.integers(1, 100), st.sampled_from([0.0001, 0.01, 1.0]))
def test_search_equals_all_comparisons(sets, query, percent, mu):
    """Whatever share of the lists counts as long."""
    arrays = [np.asarray(sorted(s), np.uint64) for s in sets]
    before, jaccard_join.MU = jaccard_join.MU, mu
    try:
        got = Lists(arrays).search(np.asarray(sorted(query), np.uint64), percent, lambda _: True)
    finally:
        jaccard_join.MU = before
    assert sorted(got) == [i for i, s in enumerate(sets) if s and 100 * len(s & query) >= percent * len(s | query)]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=200), st.sets(st.integers(0, 2**64 - 1), max_size=200), st.sets(st.integers(0, 2**64 - 1), max_size=50))
def test_classes_bound_the_overlap(a, b, both):
    x, y = (np.asarray(sorted(s | both), np.uint64) for s in (a, b))
    if len(x) and len(y):
        assert int(np.minimum(*class_bounds([class_counts(x), class_counts(y)])).sum()) >= len((a | both) & (b | both))
    many = np.arange(100_000, dtype=np.uint64) << np.uint64(40)
    assert int(class_bounds([class_counts(many)]).sum()) >= 100_000


@pytest.mark.parametrize("size", [1, 2, 9, 10, 11, 19, 20, 21, 1000])
def test_least_overlap(size):
    t = least_overlap(size, 90)
    assert t == min(o for o in range(1, size + 1) for n in range(o, 2 * size + 2) if 100 * o >= 90 * (size + n - o))


def family(seed):
    """Copies, chains of edits around the threshold, a shared passage, templates, and odd texts."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([12, 60, 150]))] for _ in range(6)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(55))
    texts = [None, "", " \n", "a", "A", "a b", "a b c", "a  B\tc", "same " * 5_000, "same " * 4_999, "é ü ß"]
    for words in base:
        texts += [" ".join(words)] * 2 + [edited(words, rng, n) for n in (1, 1, 1, 2, 2, 3) for _ in range(2)]
    texts += [f"{passage} " + " ".join(rng.choice(vocabulary) for _ in range(n)) for n in (3, 6, 10, 60, 60, 60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return [*rows, (None, " ".join(base[0])), (3, " ".join(base[1])), (3, " ".join(base[1])), (5, edited(base[2], rng, 1))]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_comparisons(spark, seed):
    rows = family(seed)
    assert joined(spark, rows) == plain(rows)


def test_other_thresholds_and_a_coarse_order(spark):
    """The order of the lists never changes a result."""
    rows = family(3)
    assert joined(spark, rows, percent=60, size=2, slots=4) == plain(rows, 60, 2)


def test_large_groups(spark, monkeypatch):
    """A group of near copies beside one whose members are all just too far from each other, over many tiles, salts and parts."""
    monkeypatch.setattr(jaccard_join, "FAN", 8)
    monkeypatch.setattr(jaccard_join.near_dups, "TILE", 8)
    monkeypatch.setattr(jaccard_join.near_dups, "PART_ROWS", 8)
    rng = random.Random(7)
    near, far = ([f"{k}{i}" for i in range(200)] for k in "nf")
    rows = [(i, edited(near, rng, 1)) for i in range(60)] + [(100 + i, edited(far, rng, 6)) for i in range(60)] + [(300, " ".join(far)), (301, " ".join(near))]
    assert joined(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert joined(spark, []) == [] and joined(spark, [(1, None), (2, "a b")]) == [(1, 0, 1), (2, 1, 2)]


def test_kept_names_the_component(spark):
    out = jaccard_join.jaccard_components(spark.createDataFrame([(2, "a b c d"), (1, "a b c d"), (None, "x")], "doc_id long, text string"))
    assert {(r.doc_id, r.component_id, r.kept) for r in out.collect()} == {(1, 1, True), (2, 1, False), (None, None, True)} and out.where(F.col("n_shingles") < 1).isEmpty()
