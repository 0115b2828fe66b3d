from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import merkle, queries
from shelfwise.session import Scratch

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, root string, at int, _tree int"
H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


def tree_of(digests, arity=2):
    """Levels of a tree, and the siblings of every leaf."""
    levels, ways = [digests], [[] for _ in digests]
    while len(levels[-1]) > 1:
        low, step = levels[-1], arity ** (len(levels) - 1)
        for i, way in enumerate(ways):
            at = i // step
            run = range(at // arity * arity, min(len(low), at // arity * arity + arity))
            way.append([low[k] if k != at else None for k in run])
        levels.append([H(*low[k : k + arity]) for k in range(0, len(low), arity)])
    return levels[-1][0], ways


def plain(rows, arity=2):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) by the contract."""
    one = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d, s, la, n, t: H(*map(one, (d, s, la, n, t)))
    trees = {}
    for d, s, la, n, t in rows:
        hit = d is not None and n is not None and zlib.crc32(str(d).encode()) % 7 == 0
        trees.setdefault(la, []).append((d, leaf(d, s, la, n, t), leaf(d, s, la, n + 1, t) if hit else leaf(d, s, la, n, t)))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for la in order:
        trees[la].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    under = {la: tree_of([x[1] for x in trees[la]], arity) for la in order}
    if not order:
        return []
    root, over = tree_of([under[la][0] for la in order], arity)
    out = []
    for k, la in enumerate(order):
        for (d, now, start), way in zip(trees[la], under[la][1]):
            runs, x = [*way, *over[k]], start
            for run in runs:
                x = H(*[x if y is None else y for y in run])
            out.append((d, now, under[la][0], root, H(*[y for run in runs for y in run if y is not None]), x, x == root))
    return sorted(out, key=repr)


ROWS = [
    *[(i, f"s{i % 3}", ["en", "de", None, "", "é"][min(4, i * i % 11)], i * 3, f"text {i}\n") for i in range(300)],
    (None, None, None, None, None), (None, "s", "en", 5, ""), (7, "s1", "en", 21, "again"), (7, "s1", "en", 21, "again"), (1000, None, "only", None, None), (2**62, "s", "zz", 2**63 - 1, "x" * 100_000),
]


def proved(spark, rows, parts=5):
    docs = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA).repartition(parts)
    out = merkle.documents_manifest(docs)
    return sorted((tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256), "folded_root", "verified").collect()), key=repr)


def test_manifest_equals_the_plain_tree(spark):
    got = proved(spark, ROWS)
    assert got == plain(ROWS) and any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_small_tables(spark):
    assert proved(spark, []) == [] and proved(spark, ROWS[:1]) == plain(ROWS[:1]) and proved(spark, ROWS[:2]) == plain(ROWS[:2])


@pytest.mark.parametrize(("arity", "span"), [(2, 3), (5, 1)])
def test_many_rounds_and_arities(spark, arity, span):
    """Small blocks make many rounds, each of which leaves a frontier to the next."""
    rows = spark.createDataFrame([(f"t{i % 3}" if i % 50 else None, i, H(str(i)), i % 4) for i in range(400)], "lang string, k long, leaf string, extra int").repartition(7)
    out = merkle.verify(merkle.manifest(rows, "lang", "k", "leaf", arity, span), "leaf", arity).collect()
    trees = {}
    for r in sorted(out, key=lambda r: r.k):
        trees.setdefault(r.lang, []).append(r)
    order = sorted(trees, key=lambda t: (t is not None, t or ""))
    root, over = tree_of([tree_of([r.leaf for r in trees[t]], arity)[0] for t in order], arity)
    assert len(out) == 400 and all(r.verified and r.root == root and r.extra == r.k % 4 for r in out)
    for k, t in enumerate(order):
        sub, ways = tree_of([r.leaf for r in trees[t]], arity)
        for r, way in zip(trees[t], ways):
            assert r.subroot == sub and r.proof == "".join(x for run in [*way, *over[k]] for x in run if x)


def test_events_in_any_order_complete_the_same_parents():
    digests = [H(str(i)) for i in range(11)]
    for step in (1, 3, 7):
        block = merkle.Block(11, 10, 2)
        for i in range(11):
            block.arrive(0, i * step % 11, digests[i * step % 11])
        assert block.nodes[4, 0] == tree_of(digests)[0] and block.way_up(0, 10)[:2] == (4, 0)


def test_broken_proofs_are_told(spark, sf_dir):
    out = queries.op13_merkle(spark, sf_dir)
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("doc_id").isNotNull()
    docs = queries.read(spark, sf_dir, "documents")
    assert out.count() == docs.count() and out.where(F.col("verified") == hit).isEmpty()


def test_forest_lets_a_task_hold_anything(spark):
    """Leaves of one tree dealt at random over tasks: nothing is complete in the first round, the root is the same."""
    digests = [H(str(i)) for i in range(200)]
    leaves = spark.createDataFrame([(None, i, 200, d) for i, d in enumerate(digests)], "tree string, at long, size long, digest string").repartition(9)
    forest = merkle.Forest(leaves, 200, Scratch(spark, "forest"), "any", 2, 4)
    assert [tuple(r) for r in forest.roots.collect()] == [(None, 200, tree_of(digests)[0])]
