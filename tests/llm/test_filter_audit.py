from __future__ import annotations

import itertools
import re
from collections import Counter

from pyspark.sql import functions as F

from shelfwise.llm import filter_audit

DOCS = "doc_id long, text string, source string, flags int"
LABELS = "doc_id long, quality int, toxic int"
LONG = " ".join(f"w{i}" for i in range(70))
ROWS = [
    (1, LONG, "a"), (2, LONG, "a"), (3, LONG, "b"), (3, LONG, "b"), (None, LONG, "a"), (4, None, None), (5, "", ""), (6, "few words", "a"),
    (7, "same " * 20_000, "b"), (8, LONG.upper(), "b"), (9, f"{LONG} #", "a"), (10, "\n\t ", "c"), (11, "É" * 30 + "A", "c"), (12, LONG + " x\x1fy", "c"),
]
MARKS = [(1, 1, 0), (2, 1, 1), (2, None, 0), (3, 0, 1), (6, 1, None), (99, 1, 1), (None, 1, 1), (8, None, None)]


def plain(rows, marks):
    """The contract, document by document and order by order."""
    good, toxic = {d for d, q, _ in marks if q == 1 and d is not None}, {d for d, _, x in marks if x == 1 and d is not None}
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    fails = []
    for d, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and first[t] < d}
        fails.append((d, s or "", {k for k, v in f.items() if v}))
    out, shapley = [], Counter()
    for part in {s for _, s, _ in fails}:
        mine = [(d, f) for d, s, f in fails if s == part]
        for order in itertools.permutations("ABCDE"):
            left = list(mine)
            for step, letter in enumerate(order, 1):
                gone = [d for d, f in left if letter in f]
                left = [(d, f) for d, f in left if letter not in f]
                shapley[part, letter] += len(gone)
                total = sum(letter in f for _, f in mine)
                out.append([part, "".join(order), step, len(left), len(gone), total - len(gone), sum(f == {letter} for _, f in mine), sum(d in good for d in gone), sum(d in toxic for d in gone), letter])
    return sorted((*r[:-1], shapley[r[0], r[-1]]) for r in out)


def audited(spark, rows, marks):
    docs = spark.createDataFrame([(*r, 7) for r in rows], DOCS).withColumns({"part": F.lit(1), "first": F.lit(2)}).repartition(3)
    out = filter_audit.audit(docs, spark.createDataFrame(marks, LABELS))
    return sorted(tuple(r) for r in out.select("part", "filter_order", "step", *filter_audit.COUNTS[1:], "shapley").collect())


def test_audit_equals_the_plain_rule(spark):
    assert audited(spark, ROWS, MARKS) == plain(ROWS, MARKS)


def test_empty_tables(spark):
    assert audited(spark, [], MARKS) == [] and audited(spark, ROWS[:1], []) == plain(ROWS[:1], [])


def test_index_can_be_packed_in_parts(spark, monkeypatch):
    """Bitsets of several packings sum to the same counts, with a part over many words."""
    rows = [(i, f"{'x ' * (i % 90)}{i % 7}", f"s{i % 2}") for i in range(700)]
    whole = audited(spark, rows, [])
    flags = filter_audit.with_copies(filter_audit.flag_texts(spark.createDataFrame([(*r, 0) for r in rows], DOCS), "source"), 4)
    index = filter_audit.build_index(flags.repartition(5), 7)
    assert index.agg(F.sum("n")).first()[0] == 700 and index.where("length(bits) <> 7 * 8 * ceil(n / 64)").isEmpty()
    got = filter_audit.orders(filter_audit.prefix_counts(index))
    assert sorted(tuple(r) for r in got.select("part", "filter_order", "step", *filter_audit.COUNTS[1:], "shapley").collect()) == whole == plain(rows, [])
