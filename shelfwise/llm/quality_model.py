"""Quality classifier as a sparse rule ensemble.

Statistics of each text feed small trees grown on bootstrap samples; every path from a
root to a node is a conjunctive rule; lasso logistic regression keeps and weighs a few;
the weighted rules are compiled into one Spark column expression.

Fitting uses at most ``SAMPLE_ROWS`` labelled rows, those with the smallest hash of the
doc_id, and each tree at most ``TREE_ROWS`` of them, drawn with replacement; statistics and
scores cover every document and the whole text.

Cases: of several texts with one doc_id the smallest is learned from; null and empty texts
have statistics of zero and a score like any other; labels that are null are not learned
from; without both labels, or where no rule parts the rows, the score is the share of
label 1 (0.5 without labels); repeated rows are scored each; an empty table gives an
empty result; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import hash_words, mix64, slices, words_of
from shelfwise.session import ship

SAMPLE_ROWS, TREE_ROWS = 20_000, 4_000
TREES, DEPTH, MIN_LEAF = 30, 3, 20
LASSO = 0.002
ROUNDS = 400
SEED = 11
STATS = (
    "log_words", "mean_length", "symbols", "bangs", "upper", "digits", "distinct", "top_share",
    "dup_lines", "same_as_last", "repeated_windows", "stops", "commas", "line_words", "odd",
)

_kind = np.zeros((256, 6), bool)
for _j, _chars in enumerate((b"#*$%&|<>", b"!", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",")):
    _kind[list(_chars), _j] = True
_odd = np.ones(256, bool)
_odd[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789 .,\n\t")] = False
_odd[128:] = False


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATS per text."""
    words, starts = words_of(texts)
    hashed = hash_words(words)
    out = np.zeros((len(texts), len(STATS)))
    for d, text in enumerate(texts.cast(pa.binary()).to_pylist()):
        if not text:
            continue
        a, b = int(starts[d]), int(starts[d + 1])
        n = b - a
        if not n:
            continue
        h = hashed[a:b]
        counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        symbols, bangs, upper, digits, stops, commas = (counts @ _kind).tolist()
        space = int(counts[9:14].sum() + counts[32])
        chars = len(text) - int(counts[128:192].sum())
        met = np.unique(h, return_counts=True)[1]
        lines = [x for x in text.split(b"\n") if x.strip()]
        windows = mix64(h[:-2] * np.uint64(3) + h[1:-1] * np.uint64(5) + h[2:] * np.uint64(7)) if n >= 3 else h[:0]
        letters = max(1, chars - space)
        out[d] = (
            np.log1p(n), letters / n, symbols / n, bangs / n, upper / letters, digits / letters, len(met) / n, met.max() / n,
            1 - len(set(lines)) / max(1, len(lines)), float((h[1:] == h[:-1]).sum()) / n,
            1 - len(np.unique(windows)) / max(1, len(windows)), stops / n, commas / n, n / max(1, len(lines)), int(counts[_odd].sum()) / letters,
        )
    return np.round(out, 9)


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and STATS."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            table = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(table[:, j]) for j in range(len(STATS))]], ["doc_id", *STATS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{s} double" for s in STATS))


#: A rule: ((statistic, over, threshold), ...); ``over`` true means value > threshold.
Rule = tuple[tuple[int, bool, float], ...]


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, path: Rule = ()) -> list[Rule]:
    """Rules of one tree's nodes, splits by variance reduction over a random half of the statistics."""
    rules = [path] if path else []
    if depth == 0 or len(y) < 2 * MIN_LEAF or y.min() == y.max():
        return rules
    best = (1e-6, None, None)
    for j in rng.permutation(x.shape[1])[: max(1, x.shape[1] // 2)]:
        order = np.argsort(x[:, j], kind="stable")
        v, t = x[order, j], np.cumsum(y[order])
        n = np.arange(1, len(v) + 1)
        ok = np.flatnonzero((v[:-1] < v[1:]) & (n[:-1] >= MIN_LEAF) & (len(v) - n[:-1] >= MIN_LEAF))
        if not len(ok):
            continue
        left, right = t[ok] / n[ok], (t[-1] - t[ok]) / (len(v) - n[ok])
        gain = n[ok] * (len(v) - n[ok]) / len(v) ** 2 * (left - right) ** 2
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (gain[k], int(j), float((v[ok[k]] + v[ok[k] + 1]) / 2))
    _, j, threshold = best
    if j is None:
        return rules
    over = x[:, j] > threshold
    for side, at in ((False, ~over), (True, over)):
        rules += grow(x[at], y[at], rng, depth - 1, (*path, (j, side, threshold)))
    return rules


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    ok = np.ones(len(x), bool)
    for j, over, threshold in rule:
        ok &= (x[:, j] > threshold) == over
    return ok


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int) -> tuple[float, np.ndarray]:
    """Intercept and weights of L1-penalised logistic regression, by accelerated proximal steps."""
    n, m = z.shape
    step = 4.0 / (np.linalg.norm(z, 2) ** 2 / n + 1)
    w = np.zeros(m + 1)
    w[0] = np.log(y.mean() / (1 - y.mean()))
    v, t = w.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(v[0] + z @ v[1:], -30, 30)))
        g = np.concatenate(([(p - y).mean()], z.T @ (p - y) / n))
        new = v - step * g
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / s * (new - w), new, s
    return float(w[0]), w[1:]


class RuleEnsemble:
    def __init__(self, intercept: float, rules: list[Rule], weights: np.ndarray):
        self.intercept, self.rules, self.weights = intercept, rules, weights

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, seed: int = SEED, tree_rows: int = TREE_ROWS) -> "RuleEnsemble":
        share = (y.sum() + 0.5) / (len(y) + 1)
        constant = RuleEnsemble(float(np.log(share / (1 - share))), [], np.zeros(0))
        if not len(y) or y.min() == y.max():
            return constant
        rng = np.random.default_rng(seed)
        rules: dict[Rule, None] = {}
        for _ in range(TREES):
            pick = rng.integers(0, len(y), min(len(y), tree_rows))
            rules.update(dict.fromkeys(grow(x[pick], y[pick], rng, DEPTH)))
        kept, seen = [], set()
        for r in rules:
            ok = holds(r, x)
            if 0 < ok.sum() < len(ok) and (mark := ok.tobytes()) not in seen:
                seen.add(mark)
                kept.append((r, ok))
        if not kept:
            return constant
        z = np.stack([ok for _, ok in kept], axis=1).astype(np.float64)
        intercept, weights = lasso(z, y, LASSO, ROUNDS)
        some = np.flatnonzero(np.abs(weights) > 1e-4)
        return RuleEnsemble(intercept, [kept[i][0] for i in some], weights[some])

    def column(self) -> Column:
        """The score as an expression over STATS."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights.tolist()):
            met = F.lit(True)
            for j, over, threshold in rule:
                met = met & ((F.col(STATS[j]) > threshold) if over else (F.col(STATS[j]) <= threshold))
            total = total + F.when(met, F.lit(weight)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            total += weight * holds(rule, x)
        return 1 / (1 + np.exp(-total))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, tree_rows: int = TREE_ROWS) -> RuleEnsemble:
    """Learn from ``labels`` (doc_id, quality) and the texts of ``docs``."""
    known = labels.where("quality is not null and doc_id is not null").select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y"))
    picked = known.orderBy(F.xxhash64("_id"), "_id", "_y").limit(sample_rows).collect()
    if not picked:
        return RuleEnsemble.fit(np.zeros((0, len(STATS))), np.zeros(0))
    chosen = docs.sparkSession.createDataFrame([(r._id, r._y) for r in picked], "_id long, _y int")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen.select("_id").distinct()), F.col("doc_id") == F.col("_id"), "left_semi")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"))
    found = with_statistics(rows).toPandas().sort_values(["doc_id", *STATS])
    y = found.merge(chosen.toPandas(), left_on="doc_id", right_on="_id")
    return RuleEnsemble.fit(y[list(STATS)].to_numpy(float), y["_y"].to_numpy(float), tree_rows=tree_rows)


def score(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """doc_id, STATS and score."""
    return with_statistics(docs).withColumn("score", model.column())
