from __future__ import annotations

import random

import pytest

from shelfwise.functions.scores import ratio
from shelfwise.operators import brands


def in_turn(keys, close, most=8):
    """The sequential rule: a free key leads itself and those of its closest keys that are free."""
    near, used, out = {}, set(), {}
    for a, b, s in close:
        near.setdefault(a, []).append((-s, b))
    for _, k in sorted((p, k) for k, p in keys):
        if k in used:
            continue
        used.add(k)
        out[k] = k
        for _, b in sorted(near.get(k, []))[: most - 1]:
            if b not in used:
                used.add(b)
                out[b] = k
    return out


def stars(spark, keys, close, rows):
    df = brands.greedy_stars(spark.createDataFrame(keys, "key string, position string"), spark.createDataFrame(close, "a string, b string, score double"), rows=rows)
    return {r.key: r.leader for r in df.collect()}


@pytest.mark.parametrize(("seed", "rows"), [(1, 50_000), (2, 40)])
def test_stars_equal_the_sequential_rule(spark, seed, rows):
    """Dense parts, chains, hubs and ties of place, whether one task or many settle them."""
    rng = random.Random(seed)
    keys = [(f"k{i:04d}", f"p{rng.randrange(400):04d}") for i in range(500)]
    pairs = {tuple(rng.sample(range(300), 2)) for _ in range(500)} | {(i, i + 1) for i in range(300, 450)} | {(499, i) for i in range(480, 499)}
    close = [(keys[a][0], keys[b][0], float(rng.randrange(88, 100))) for x, y in pairs for a, b in ((x, y), (y, x))]
    close = list({(a, b): (a, b, s) for a, b, s in close}.values())
    assert stars(spark, keys, close, rows) == in_turn(keys, close)


def test_a_long_chain_is_settled_by_many_tasks(spark):
    keys = [(f"k{i:06d}", f"{i:06d}") for i in range(20_000)]
    close = [(keys[a][0], keys[b][0], 95.0) for i in range(19_999) for a, b in ((i, i + 1), (i + 1, i))]
    assert stars(spark, keys, close, 5_000) == in_turn(keys, close)


def test_close_keys_lose_no_pair(spark):
    rng = random.Random(3)
    base = ["GOLDENROD", "GOLDENR", "CHOCOLATEBARS", "KELLOGGSCORN", "TENLETTERS"]
    keys = set(base) | {"GO", "GOLD", ""}
    for _ in range(400):
        word = list(rng.choice(base))
        for _ in range(rng.randrange(1, 4)):
            at = rng.randrange(len(word))
            rng.choice([lambda: word.pop(at), lambda: word.insert(at, rng.choice("ABX")), lambda: word.__setitem__(at, rng.choice("ABX"))])()
        keys.add("".join(word))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    keys = sorted(keys)
    fit = lambda a, b: min(len(a), len(b)) >= 7 and a[:2] == b[:2] and distance(a, b) <= (1 if max(len(a), len(b)) <= 10 else 2) and ratio(a, b) >= 88
    got = sorted((r.a, r.b) for r in brands.close_keys(spark.createDataFrame([(k,) for k in keys], "key string")).collect())
    assert got == [(a, b) for a in keys for b in keys if a != b and fit(a, b)] and len(got) > 100
