from __future__ import annotations

import math
import re
import string
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import nearest, quality_model, queries


def brute_nearest(rows, k=10):
    good = [(i, np.asarray(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.asarray(v, float)).all() and any(v)]
    out = []
    for q, x in good:
        if q % 100:
            continue
        near = sorted((nearest.exact(x[None], y[None])[0], i) for i, y in good if i != q and len(y) == len(x))[:k]
        out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return sorted(out)


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=12).astype(np.float32).tolist()) for i in range(700)]
    rows[3] = (3, rows[0][1])  # ties
    rows[4] = (4, rows[0][1])
    rows += [(900, None), (None, [1.0] * 12), (1000, [0.0] * 12), (1001, [1.0, None] * 6), (1002, [float("nan")] * 12), (1100, [1.0, 2.0]), (1101, [1.0, 3.0]), (1200, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x")).repartition(4)
    got = sorted(tuple(r) for r in nearest.nearest(df, F.col("vec_id") % 100 == 0).collect())
    assert got == brute_nearest([(i, np.asarray(v, np.float32).astype(float).tolist() if v and None not in v else v) for i, v in rows])
    assert nearest.nearest(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("size", [1e-3, 1.0, 1e6, 1e200])
def test_quantisation_bounds_hold(size):
    rng = np.random.default_rng(2)
    a = (rng.normal(size=(40, 16)) + 5) * size
    b = np.concatenate([rng.normal(size=(20, 16)) * 3 * size, a[:20] + rng.normal(size=(20, 16)) * size * 1e-9])
    low, high = nearest.bounds(nearest.quantise(a), nearest.quantise(b))
    with np.errstate(over="ignore"):
        true = np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1))
    assert (low <= true).all() and (true <= high).all()


def test_repeated_query_ids_are_queries_of_their_own(spark):
    rng = np.random.default_rng(8)
    rows = [(i % 40 * 100 if i < 80 else i, rng.normal(size=4).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in nearest.nearest(df, F.col("vec_id") % 100 == 0).collect())
    assert got == brute_nearest(rows)


def test_many_blocks_take_rounds(spark, monkeypatch):
    """Over twenty blocks, more than a round holds: each task sends at most k rows a query and round."""
    monkeypatch.setattr(nearest, "ROUND_BYTES", 8 * 8 * 20 * 5)
    rng = np.random.default_rng(9)
    rows = [(i if i % 2 else i * 50, rng.normal(size=8).tolist()) for i in range(1000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    blocks = nearest.write_blocks(df.where("vec_id % 100 = 0"), f"{spark.conf.get('spark.checkpoint.dir')}/blocks-test", 20)
    rounds = nearest.rounds_of(blocks, nearest.ROUND_BYTES)
    assert len(blocks) > 20 and len(rounds) > 4 and sorted(f for r in rounds for f in r) == [f for f, _ in blocks]
    for files in rounds:
        sent = nearest.compare(df, files, 10).groupBy("asked").count().agg(F.max("count")).first()[0]
        assert sent <= 4 * 10
    monkeypatch.setattr(nearest, "BLOCK", 20)
    want = brute_nearest(rows)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in nearest.nearest(df, F.col("vec_id") % 100 == 0).collect())
    assert got == want


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    out = queries.op4_quality_model(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    right = out.select(F.avg((F.col("predicted") == F.col("quality")).cast("double")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.97 and 0 <= right[1] and right[2] <= 1


def test_rules_compile_to_the_same_scores(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([None, "", "a b c", "X!! " * 50, "word " * 80, "good words of many kinds here\n" * 3])], "doc_id long, text string").withColumn("upper", F.lit("clash"))
    rng = np.random.default_rng(0)
    x = rng.random((400, len(quality_model.STATS)))
    y = ((x[:, 2] > 0.5) & (x[:, 4] < 0.7)).astype(float)
    model = quality_model.RuleEnsemble.fit(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95 and len(model.rules) < 100
    table = quality_model.score(docs, model).orderBy("doc_id").toPandas()
    assert table["score"].to_numpy() == pytest.approx(model.score(table[list(quality_model.STATS)].to_numpy()))
    assert quality_model.score(docs.limit(0), model).count() == 0


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    assert {r.score for r in quality_model.score(docs, quality_model.fit(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert {round(r.score, 3) for r in quality_model.score(docs, quality_model.fit(docs, one)).collect()} == {0.833}


def plain_statistics(text):
    """STATS of one text in plain Python."""
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return [0.0] * len(quality_model.STATS)
    n, letters = len(w), max(1, len(re.sub(r"[\x20\x09-\x0D]", "", t)))
    count = lambda chars: sum(c in chars for c in t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = list(zip(w, w[1:], w[2:]))
    odd = sum(c < "\x80" and not c.isalnum() and c not in " .,\n\t" for c in t)
    return [
        math.log1p(n), letters / n, count("#*$%&|<>") / n, count("!") / n, count(string.ascii_uppercase) / letters, count(string.digits) / letters,
        len(set(w)) / n, max(Counter(w).values()) / n, 1 - len(set(lines)) / max(1, len(lines)), sum(a == b for a, b in zip(w, w[1:])) / n,
        1 - len(set(windows)) / max(1, len(windows)), count(".") / n, count(",") / n, n / max(1, len(lines)), odd / letters,
    ]


def test_statistics_equal_plain_python():
    documents = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist()
    texts = [*documents, None, "", " \n ", "same", "same", "a\x0bb\x1cc É ünï ★!", "word " * 200_000]
    found = quality_model.statistics(pa.array(texts))
    assert np.allclose(found, [plain_statistics(t) for t in texts], atol=2e-9)


def test_repeated_labelled_documents_are_learned_once(spark):
    docs = spark.createDataFrame([(1, "b b"), (1, "a"), (1, "a")] * 50 + [(2, "c c c c"), (3, None)], "doc_id long, text string").withColumn("log_words", F.lit("clash"))
    labels = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (3, 1), (None, 1)], "doc_id long, quality int")
    scores = quality_model.score(docs, quality_model.fit(docs, labels))
    assert scores.count() == 152 and scores.where("score is null or score < 0 or score > 1").count() == 0
