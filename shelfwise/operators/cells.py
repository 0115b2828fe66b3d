"""Joins by name within blocks: the best match of every row, or all pairs from a score on.

Rows of both sides meet where they share a key (columns ``key``).  A key's rows are dealt into
cells of bounded size, at most ``LEFT`` rows against ``RIGHT``, so no key makes a large task,
and only rows cross the network, never pairs.  Inside a cell no pair is scored before a bound
says that it may matter:

* lengths and common letters bound every edit-based ratio (a longest common subsequence is no
  longer than what the letters have in common); all pairs of two blocks are bounded by one
  product of matrices, a column for the first, second, ... occurrence of a letter;
* shared words bound the ratio of word sets;
* what comes after the score (bonus, penalties, caps) never falls when the score rises, so the
  same rules carry a bound of the score to a bound of the result.

``best_matches`` takes the candidates of each row by falling bound, a few at first and then
twice as many, until no bound reaches the best result so far.  It gives what scoring all pairs
gives, ties included.  ``pairs_from`` scores what may reach a fixed least score.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import scores
from shelfwise.session import ship, spread

#: Rows of a cell of either side, and of the blocks that are bounded at once.
LEFT, RIGHT, BLOCK = 4_096, 16_384, 512
#: Rounding of a bound against a score worked out in another order.
SLACK = 1e-6
#: Places that shared words are hashed to; words that share a place only raise a bound.
WORD_PLACES = 256


def deal(left: DataFrame, right: DataFrame, most_left: int = LEFT, most_right: int = RIGHT) -> tuple[DataFrame, DataFrame]:
    """Both sides (with ``key``) with a column ``cell``; rows that share a key share exactly one cell.  Null keys go."""
    count = lambda df, name: df.where("key is not null").groupBy("key").agg(F.count("*").alias(name))
    sizes = count(left, "n_left").join(count(right, "n_right"), "key")
    parts = sizes.select("key", F.ceil(F.col("n_left") / most_left).alias("rows"), F.ceil(F.col("n_right") / most_right).alias("columns"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    place = lambda df, n: F.pmod(F.xxhash64(*[c for c in df.columns if c in ("row_id", "src_id", "c_name", "s_name")]), F.col(n))
    a = left.join(parts, "key").withColumn("_r", place(left, "rows")).withColumn("_c", every("columns"))
    b = right.join(parts, "key").withColumn("_c", place(right, "columns")).withColumn("_r", every("rows"))
    return tuple(df.withColumn("cell", F.xxhash64("key", "_r", "_c")).drop("rows", "columns", "_r", "_c") for df in (a, b))


class Names:
    """What bounds the scores of some names: letters by occurrence, lengths, words."""

    def __init__(self, names: list[str]):
        self.names, n = names, len(names)
        self.sizes = np.fromiter(map(len, names), np.int64, n)
        letters = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        owner = np.repeat(np.arange(n), self.sizes)
        order = np.lexsort((letters, owner))
        owner, letters = owner[order], letters[order]
        first = np.ones(len(letters), bool)
        first[1:] = (owner[1:] != owner[:-1]) | (letters[1:] != letters[:-1])
        start = np.maximum.accumulate(np.where(first, np.arange(len(letters)), 0)) if len(letters) else np.empty(0, np.int64)
        #: letter and how many of it came before, as one number, and whose it is.
        self.marks, self.owner = (letters << 20) + (np.arange(len(letters)) - start), owner
        words = [x.split() for x in names]
        self.words = np.zeros((n, WORD_PLACES), np.float32)
        for i, own in enumerate(words):
            for w in set(own):
                self.words[i, hash(w) % WORD_PLACES] += len(w) + 1
        #: Names with doubled words or blanks, whose sorted and distinct words are other strings: they are not bounded.
        self.plain = np.fromiter((len(set(own)) == len(own) and " ".join(own) == x for own, x in zip(words, names)), bool, n)

    def block(self, at: int, size: int) -> "Names":
        part = object.__new__(Names)
        part.names, part.sizes, part.words, part.plain = self.names[at : at + size], self.sizes[at : at + size], self.words[at : at + size], self.plain[at : at + size]
        a, b = np.searchsorted(self.owner, [at, at + len(part.names)])
        part.marks, part.owner = self.marks[a:b], self.owner[a:b] - at
        return part


def common_letters(a: Names, b: Names) -> np.ndarray:
    """How many letters each name of ``a`` has in common with each of ``b``."""
    marks = np.intersect1d(a.marks, b.marks)

    def grid(x: Names) -> np.ndarray:
        out = np.zeros((len(x.names), len(marks)), np.float32)
        place = np.searchsorted(marks, x.marks)
        here = place < len(marks)
        here[here] = marks[place[here]] == x.marks[here]
        out[x.owner[here], place[here]] = 1
        return out

    return (grid(a) @ grid(b).T).astype(np.float64)


def upper_bounds(scorer: str, a: Names, b: Names) -> np.ndarray:
    """At least the score of each name of ``a`` with each of ``b``."""
    common, sizes = common_letters(a, b), np.add.outer(a.sizes, b.sizes)
    short = np.minimum.outer(a.sizes, b.sizes)
    ratio = np.where(sizes > 0, 200.0 * common / np.maximum(sizes, 1), 100.0)
    part = np.where(short > 0, 200.0 * common / np.maximum(short + common, 1), np.where(sizes > 0, 0.0, 100.0))
    if scorer == "ratio":
        return ratio + SLACK
    if scorer == "partial":
        return part + SLACK
    free = ~np.logical_and.outer(a.plain, b.plain)
    if scorer == "token_sort":
        return np.where(free, 100.0, ratio) + SLACK
    shared = np.zeros_like(common)
    used = np.flatnonzero(a.words.any(axis=0) & b.words.any(axis=0))
    for k in used:  # words of one place count as far as both have them
        rows, columns = np.flatnonzero(a.words[:, k]), np.flatnonzero(b.words[:, k])
        shared[np.ix_(rows, columns)] += np.minimum.outer(a.words[rows, k], b.words[columns, k])
    joined = np.maximum(shared - 1, 0)  # the shared words with a blank between
    words = np.maximum(ratio, np.where(shared > 0, 200.0 * joined / np.maximum(joined + short, 1), 0.0))
    words = np.minimum(words, 100.0)
    if scorer == "token_set":
        return np.where(free, 100.0, words) + SLACK
    apart = np.maximum.outer(a.sizes, b.sizes) / np.maximum(short, 1)
    near = np.maximum(ratio, 0.95 * words)
    far = np.where(apart <= 8, 0.9, 0.6) * np.maximum(part, 0.95 * np.where(shared > 0, 100.0, part))
    weighted = np.where(apart < 1.5, near, np.maximum(ratio, far))
    made = weighted if scorer == "weighted" else (weighted + words + part) / 3.0
    return np.where(free, 100.0, made) + SLACK


def _frame(columns: dict[str, np.ndarray | list], schema: str) -> pa.Table:
    types = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.table({name: pa.array(columns[name], types[kind]) for name, kind in fields})


def pairs_from(left: DataFrame, right: DataFrame, scorer: str, least: float, exact: bool = True, most_left: int = LEFT, most_right: int = RIGHT) -> DataFrame:
    """(c_name, s_name, score): the pairs of names (c_name, key; s_name, key) that share a key and score ``least`` or more.

    Without ``exact`` all pairs whose bound reaches ``least``, and the bound as score.
    """
    ship(left.sparkSession)
    a, b = deal(left.select("key", "c_name"), right.select("key", "s_name"), most_left, most_right)

    def meet(x: pa.Table, y: pa.Table) -> pa.Table:
        mine, theirs = Names(x.column("c_name").to_pylist()), Names(y.column("s_name").to_pylist())
        found: list[list] = [[], [], []]
        for i in range(0, len(mine.names), BLOCK):
            some = mine.block(i, BLOCK)
            for j in range(0, len(theirs.names), BLOCK):
                others = theirs.block(j, BLOCK)
                bound = upper_bounds(scorer, some, others)
                p, q = np.nonzero(bound >= least)
                c, s = [some.names[k] for k in p.tolist()], [others.names[k] for k in q.tolist()]
                score = scores.MANY[scorer](c, s) if exact and c else bound[p, q]
                keep = np.flatnonzero(score >= least).tolist()
                for out, values in zip(found, (c, s, score)):
                    out += [values[k] for k in keep]
        return _frame(dict(zip(("c_name", "s_name", "score"), found)), "c_name string, s_name string, score double")

    return spread(a, "cell").groupBy("cell").cogroup(spread(b, "cell").groupBy("cell")).applyInArrow(meet, "c_name string, s_name string, score double")


#: Given the rows of two blocks (columns as lists), a function that turns scores into results: of all pairs (``...``), or of
#: those at two arrays of places.  No result may fall when its score rises.
Where = tuple[np.ndarray, np.ndarray]
Rule = Callable[[dict[str, list], dict[str, list]], Callable[[np.ndarray, "Where | None"], np.ndarray]]


def best_matches(left: DataFrame, right: DataFrame, scorer: str, rule: Rule, floor: float = 0.0, above: bool = False, most_left: int = LEFT, most_right: int = RIGHT) -> DataFrame:
    """(row_id, src_id, score, n_scored): of each left row the right row with the largest result from ``floor`` on (over it if ``above``).

    ``left``: row_id, name, key and what ``rule`` looks at; ``right`` likewise, with src_id.
    Results tie to the smaller src_id; ``n_scored`` counts the pairs that were scored for the row.
    """
    ship(left.sparkSession)
    a, b = deal(left, right, most_left, most_right)
    schema = "row_id long, src_id long, score double, n_scored long"
    names_of = lambda table: [x or "" for x in table.column("name").to_pylist()]
    reach = np.nextafter(floor, np.inf) if above else floor

    def meet(x: pa.Table, y: pa.Table) -> pa.Table:
        y = y.sort_by("src_id")
        mine, theirs = Names(names_of(x)), Names(names_of(y))
        kept = lambda t: {c: t.column(c).to_pylist() for c in t.column_names if c not in ("cell", "key", "name")}
        ours, others = kept(x), kept(y)
        n, ids = len(mine.names), np.asarray(others["src_id"], np.int64)
        best, chosen, scored = np.full(n, reach), np.full(n, -1), np.zeros(n, np.int64)
        for i in range(0, n, BLOCK):
            here = slice(i, i + BLOCK)
            some, left_rows = mine.block(i, BLOCK), {c: v[here] for c, v in ours.items()}
            for j in range(0, len(ids), BLOCK):
                part, right_rows = theirs.block(j, BLOCK), {c: v[j : j + BLOCK] for c, v in others.items()}
                result = rule(left_rows, right_rows)
                bound = result(upper_bounds(scorer, some, part), None)
                _rise(bound, best[here], chosen[here], scored[here], j, lambda p, q: result(score_pairs(scorer, some, part, p, q), (p, q)))  # noqa: B023
        good = np.flatnonzero(chosen >= 0)
        rows = np.asarray(ours["row_id"], np.int64)
        return _frame({"row_id": rows[good], "src_id": ids[chosen[good]], "score": best[good], "n_scored": scored[good]}, schema)

    met = spread(a, "cell").groupBy("cell").cogroup(spread(b, "cell").groupBy("cell")).applyInArrow(meet, schema)
    top = met.groupBy("row_id").agg(F.max(F.struct("score", (-F.col("src_id")).alias("src"))).alias("top"), F.sum("n_scored").alias("n_scored"))
    return top.select("row_id", (-F.col("top.src")).alias("src_id"), "top.score", "n_scored")


def score_pairs(scorer: str, a: Names, b: Names, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Scores of the pairs at (p, q); equal pairs of names are scored once."""
    pairs = [(a.names[i], b.names[j]) for i, j in zip(p.tolist(), q.tolist())]
    distinct = list(dict.fromkeys(pairs))
    made = dict(zip(distinct, scores.MANY[scorer]([x for x, _ in distinct], [y for _, y in distinct]).tolist()))
    return np.asarray([made[x] for x in pairs])


def _rise(bound: np.ndarray, best: np.ndarray, chosen: np.ndarray, scored: np.ndarray, offset: int, result: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> None:
    """Raise ``best`` of each row (a row of ``bound``), by results of candidates that are asked for in order of falling bound."""
    order = np.argsort(-bound, axis=1, kind="stable")
    falling = np.take_along_axis(bound, order, axis=1)
    at, step = 0, 2
    while at < bound.shape[1]:
        p, k = np.nonzero(falling[:, at : at + step] >= best[:, None])
        if not len(p):
            return
        q = order[p, at + k]
        got = result(p, q)
        np.add.at(scored, p, 1)
        # Of equal results the smaller src_id, which is the smaller place, and what an earlier block found stays.
        for i, j, x in zip(p.tolist(), q.tolist(), got.tolist()):
            if x > best[i] or (x == best[i] and (chosen[i] < 0 or offset + j < chosen[i])):
                best[i], chosen[i] = x, offset + j
        at, step = at + step, step * 2


def length_keys(names: DataFrame, name: str, least: float, asks: bool) -> DataFrame:
    """``names`` with ``key``, a step of the length such that names of ``least`` ratio or more are at most one step apart.

    One side has the key of its step, the other (``asks``) those of the steps beside it too.  Empty names are a step of their own.
    """
    if not 0 < least < 100:
        raise ValueError("the least ratio must lie between 0 and 100")
    step = F.log(F.char_length(name)) / (float(np.log((200.0 - least) / least)) * (1 + 1e-9))
    own: Column = F.when(F.char_length(name) > 0, F.floor(step)).otherwise(F.lit(-9)).cast("long")
    near = F.array_distinct(F.when(own >= 0, F.array(own - 1, own, own + 1)).otherwise(F.array(own)))
    return names.withColumn("key", F.explode(near) if asks else own)


# ---- shared tokens --------------------------------------------------------------------

#: A token in more than one of HEAVY_SHARE right rows is heavy.
HEAVY_SHARE = 256


def _token_sides(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides (row_id or src_id, tokens) with their heavy and light tokens; tokens that no right row has go."""
    seen = right.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    seen = seen.select("token", (F.col("df") * HEAVY_SHARE > right.count()).alias("is_heavy"))

    def apart(df: DataFrame, key: str) -> DataFrame:
        each = df.select(key, F.explode("tokens").alias("token")).join(seen, "token")
        some = lambda kind: F.collect_list(F.when(kind, F.col("token")))
        return each.groupBy(key).agg(some(F.col("is_heavy")).alias("heavy"), some(~F.col("is_heavy")).alias("light"))

    return apart(left, "row_id"), apart(right, "src_id")


def _products(x: pa.Table, y: pa.Table):
    """Of every two blocks: where they begin, tokens in common, and whether a heavy one is among them."""

    def grid(rows: list[list[str]], place: dict[str, int]) -> np.ndarray:
        out = np.zeros((len(rows), max(1, len(place))), np.float32)
        for i, row in enumerate(rows):
            out[i, [place[t] for t in row if t in place]] = 1
        return out

    sides = [[t.column(c).to_pylist() for c in ("heavy", "light")] for t in (x, y)]
    for i in range(0, x.num_rows, BLOCK):
        mine = [rows[i : i + BLOCK] for rows in sides[0]]
        places = [{t: k for k, t in enumerate(dict.fromkeys(t for row in rows for t in row))} for rows in mine]
        left = [grid(rows, place) for rows, place in zip(mine, places)]
        for j in range(0, y.num_rows, BLOCK):
            heavy, light = (a @ grid(rows[j : j + BLOCK], place).T for a, rows, place in zip(left, sides[1], places))
            yield i, j, np.where(heavy > 0, heavy + light, 0).astype(np.int64)


def _light_pairs(a: DataFrame, b: DataFrame, least: int) -> DataFrame:
    """(row_id, src_id, n_shared) of pairs that share light tokens only."""
    of = lambda df, key, name: df.select(key, F.col("heavy").alias(name), F.explode("light").alias("token"))
    met = of(a, "row_id", "_a").join(of(b, "src_id", "_b"), "token").where(~F.arrays_overlap("_a", "_b"))
    return met.groupBy("row_id", "src_id").agg(F.count("*").alias("n_shared")).where(F.col("n_shared") >= least)


def _heavy_cells(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    some = lambda df: df.where(F.size("heavy") > 0).withColumn("key", F.lit(0))
    return tuple(df.groupBy("cell") for df in deal(some(a), some(b)))


def shared_tokens(left: DataFrame, right: DataFrame, least: int = 1) -> DataFrame:
    """(row_id, src_id, n_shared): rows (row_id, tokens; src_id, tokens) with ``least`` tokens or more in common.

    Ids are texts, and tokens of a row distinct.  Light tokens meet by a join; rows with heavy ones are dealt into cells
    and their sets of tokens multiplied in blocks, so no token's pairs are made in one task.
    """
    ship(left.sparkSession)
    a, b = _token_sides(left, right)
    schema = "row_id string, src_id string, n_shared long"

    def meet(x: pa.Table, y: pa.Table) -> pa.Table:
        found: list[list] = [[], [], []]
        ids = x.column("row_id").to_numpy(zero_copy_only=False), y.column("src_id").to_numpy(zero_copy_only=False)
        for i, j, n in _products(x, y):
            p, q = np.nonzero(n >= max(1, least))
            for out, values in zip(found, (ids[0][i + p], ids[1][j + q], n[p, q])):
                out.append(values)
        whole = [np.concatenate(v) if v else [] for v in found]
        return _frame(dict(zip(("row_id", "src_id", "n_shared"), whole)), schema)

    x, y = _heavy_cells(a, b)
    return x.cogroup(y).applyInArrow(meet, schema).unionByName(_light_pairs(a, b, least))


def shared_token_sums(left: DataFrame, right: DataFrame, least: int = 1) -> DataFrame:
    """(row_id, n_candidates, id_sum, n_shared): sums over the pairs of ``shared_tokens``, which are not made for heavy tokens.

    A right row stands for ``n`` rows whose ids sum to ``ids``.
    """
    ship(left.sparkSession)
    a, b = _token_sides(left, right)
    b = b.join(right.select("src_id", "n", "ids"), "src_id")
    schema = "row_id string, n_candidates long, id_sum long, n_shared long"

    def meet(x: pa.Table, y: pa.Table) -> pa.Table:
        n, ids = (y.column(c).to_numpy() for c in ("n", "ids"))
        sums = np.zeros((3, x.num_rows), np.int64)
        for i, j, shared in _products(x, y):
            to, here = slice(i, i + len(shared)), slice(j, j + shared.shape[1])
            hit = shared >= max(1, least)
            for k, (grid, weight) in enumerate(((hit, n), (hit, ids), (shared * hit, n))):
                sums[k, to] += grid @ weight[here]
        return _frame({"row_id": x.column("row_id").to_pylist(), **dict(zip(("n_candidates", "id_sum", "n_shared"), sums))}, schema)

    x, y = _heavy_cells(a, b.select("src_id", "heavy", "light", "n", "ids"))
    light = _light_pairs(a, b, least).join(right.select("src_id", "n", "ids"), "src_id")
    light = light.select("row_id", F.col("n").alias("n_candidates"), F.col("ids").alias("id_sum"), (F.col("n") * F.col("n_shared")).alias("n_shared"))
    sums = x.cogroup(y).applyInArrow(meet, schema).unionByName(light).groupBy("row_id")
    return sums.agg(*[F.sum(c).alias(c) for c in ("n_candidates", "id_sum", "n_shared")]).where("n_candidates > 0")
