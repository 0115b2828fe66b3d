"""Similarity scores, 0 to 100, from their published definitions.

The edit-based family needs a longest common subsequence, which Spark lacks: those are
Arrow UDFs over a bit-parallel LCS.  The rest are column expressions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine-word-wide step per character of ``b`` (Hyyrö 2004)."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """200 * LCS / total length; two empty strings are equal."""
    total = len(a) + len(b)
    return 200.0 * lcs_length(a, b) / total if total else 100.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def _token_parts(a: str, b: str) -> tuple[str, str, str]:
    x, y = set(a.split()), set(b.split())
    return " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))


def token_set_ratio(a: str, b: str) -> float:
    """Best of: shared words against either side, and the two sides with the shared words in common."""
    if not a.split() or not b.split():
        return 0.0
    shared, left, right = _token_parts(a, b)
    if shared and (not left or not right):
        return 100.0
    gap = 1 if shared else 0
    n_left, n_right = len(shared) + gap + len(left), len(shared) + gap + len(right)
    apart = len(left) + len(right) - 2 * lcs_length(left, right)
    best = 100.0 - 100.0 * apart / (n_left + n_right)
    if shared:
        for n, rest in ((n_left, left), (n_right, right)):
            best = max(best, 100.0 - 100.0 * (gap + len(rest)) / (len(shared) + n))
    return best


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string against every window of its length, windows cut off at the ends included.

    Of two strings of one length each is taken for the shorter one.
    """
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 100.0 if not long else 0.0
    if short in long:
        return 100.0
    best = _best_window(short, long)
    return max(best, _best_window(long, short)) if len(short) == len(long) else best


def _best_window(short: str, long: str) -> float:
    m, best = len(short), 0.0
    letters = set(short)
    for end in range(1, len(long) + m):
        window = long[max(0, end - m) : end]
        if not window:
            continue
        # a best window begins or ends with a letter of the shorter string
        if (window[-1] in letters or window[0] in letters) and 200.0 * min(m, len(window)) / (m + len(window)) > best:
            best = max(best, ratio(short, window))
    return best


def partial_token_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    if x & y:
        return 100.0
    return max(partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), partial_ratio(" ".join(sorted(x - y)), " ".join(sorted(y - x))))


def weighted_ratio(a: str, b: str) -> float:
    """Plain, token and partial variants, weighted by how far the lengths differ."""
    if not a or not b:
        return 0.0
    apart = max(len(a), len(b)) / min(len(a), len(b))
    plain = ratio(a, b)
    if apart < 1.5:
        return max(plain, 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    scale = 0.9 if apart <= 8 else 0.6
    return max(plain, scale * partial_ratio(a, b), 0.95 * scale * partial_token_ratio(a, b))


def ensemble(a: str, b: str) -> float:
    """Mean of the weighted, token-set and partial ratios."""
    return (weighted_ratio(a, b) + token_set_ratio(a, b) + partial_ratio(a, b)) / 3.0


SCORERS = {
    "ratio": ratio,
    "token_sort": token_sort_ratio,
    "token_set": token_set_ratio,
    "partial": partial_ratio,
    "weighted": weighted_ratio,
    "ensemble": ensemble,
}


# ---- many pairs at once ---------------------------------------------------------------

#: Letters of the shorter text of a pair that fit a machine word, with room for a carry.
WORD = 62


def _letters(texts: list[str]) -> np.ndarray:
    """Code points of texts, a column each, filled up with zeros."""
    width = max(1, max(map(len, texts), default=1))
    return np.ascontiguousarray(np.asarray(texts, f"<U{width}").view(np.uint32).reshape(len(texts), width).T)


def _matches(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each letter of the long texts, the places of it in the short ones as bits."""
    out = np.zeros(long.shape, np.uint64)
    for i in range(len(short)):
        out |= ((long == short[i]) & (short[i] != 0)).astype(np.uint64) << np.uint64(i)
    return out


def _lcs_of(places: np.ndarray, full: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Lengths of longest common subsequences from the matches of each letter, all pairs a step at a time."""
    row = full.copy()
    for m in places:
        hit = row & m
        row = (row + hit) | (row - hit)
    return sizes - np.bitwise_count(row & full)


def _full(sizes: np.ndarray) -> np.ndarray:
    return (np.uint64(1) << sizes.astype(np.uint64)) - np.uint64(1)


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """``lcs_length`` of many pairs."""
    out = np.zeros(len(a), np.int64)
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b)]
    fit = [i for i, (x, y) in enumerate(pairs) if x and len(x) <= WORD and "\0" not in x and "\0" not in y]
    for i in set(range(len(a))) - set(fit):
        out[i] = lcs_length(*pairs[i])
    for at in range(0, len(fit), 4096):
        some = fit[at : at + 4096]
        short, long = [pairs[i][0] for i in some], [pairs[i][1] for i in some]
        sizes = np.fromiter(map(len, short), np.int64, len(short))
        out[some] = _lcs_of(_matches(_letters(short), _letters(long)), _full(sizes), sizes)
    return out


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    total = np.fromiter((len(x) + len(y) for x, y in zip(a, b)), np.int64, len(a))
    return np.where(total > 0, 200.0 * lcs_lengths(a, b) / np.maximum(total, 1), 100.0)


def _best_windows(short: list[str], long: list[str]) -> np.ndarray:
    """``_best_window`` of many pairs whose short texts have one length."""
    m, size = len(short[0]), np.fromiter(map(len, long), np.int64, len(long))
    places, full = _matches(_letters(short), _letters(long)), _full(np.full(len(short), m))
    best, most = np.zeros(len(short)), len(places)
    for end in sorted(range(1, most + m), key=lambda e: abs(2 * e - most - m)):  # whole windows first, then those cut off
        begin = max(0, end - m)
        width = np.minimum(end, size) - begin
        limit = np.where(width > 0, 200.0 * np.minimum(m, width) / np.maximum(m + width, 1), 0.0)
        if (limit > best).any():
            common = _lcs_of(places[begin:end], full, np.int64(m))
            best = np.maximum(best, np.where(width > 0, 200.0 * common / np.maximum(m + width, 1), 0.0))
    return best


def partial_ratios(a: list[str], b: list[str]) -> np.ndarray:
    out, groups = np.zeros(len(a)), {}
    for i, (x, y) in enumerate(zip(a, b)):
        short, long = (x, y) if len(x) <= len(y) else (y, x)
        if not short:
            out[i] = 0.0 if long else 100.0
        elif short in long:
            out[i] = 100.0
        elif len(short) > WORD or "\0" in short or "\0" in long:
            out[i] = partial_ratio(x, y)
        else:
            groups.setdefault(len(short), []).append((i, short, long))
            if len(short) == len(long):
                groups[len(short)].append((i, long, short))
    for rows in groups.values():
        rows.sort(key=lambda r: len(r[2]))
        for at in range(0, len(rows), 2048):
            some = rows[at : at + 2048]
            np.maximum.at(out, [r[0] for r in some], _best_windows([r[1] for r in some], [r[2] for r in some]))
    return out


def _in_order(texts: list[str]) -> list[str]:
    known = {t: " ".join(sorted(t.split())) for t in set(texts)}
    return [known[t] for t in texts]


def token_set_ratios(a: list[str], b: list[str]) -> np.ndarray:
    words = {t: frozenset(t.split()) for t in {*a, *b}}
    joined = lambda w: " ".join(sorted(w))
    out, open_, left, right, shared = np.zeros(len(a)), [], [], [], []
    for i, (x, y) in enumerate(zip(a, b)):
        u, v = words[x], words[y]
        both = u & v
        if u and v:
            if both and (len(both) == len(u) or len(both) == len(v)):
                out[i] = 100.0
            else:
                open_.append(i)
                left.append(joined(u - both))
                right.append(joined(v - both))
                shared.append(sum(map(len, both)) + max(0, len(both) - 1))
    if open_:
        n, n_l, n_r = (np.asarray(x, np.int64) for x in (shared, list(map(len, left)), list(map(len, right))))
        gap = (n > 0).astype(np.int64)
        one, two = n + gap + n_l, n + gap + n_r
        best = 100.0 - 100.0 * (n_l + n_r - 2 * lcs_lengths(left, right)) / (one + two)
        for whole, rest in ((one, n_l), (two, n_r)):
            best = np.where(n > 0, np.maximum(best, 100.0 - 100.0 * (gap + rest) / (n + whole)), best)
        out[open_] = best
    return out


def weighted_ratios(a: list[str], b: list[str], token_set: np.ndarray | None = None) -> np.ndarray:
    size = lambda t: np.fromiter(map(len, t), np.float64, len(t))
    small, large = np.minimum(size(a), size(b)), np.maximum(size(a), size(b))
    out = np.maximum(ratios(a, b), 0.95 * np.maximum(ratios(_in_order(a), _in_order(b)), token_set_ratios(a, b) if token_set is None else token_set))
    for i in np.flatnonzero((small == 0) | (large >= 1.5 * np.maximum(small, 1))).tolist():
        out[i] = weighted_ratio(a[i], b[i])
    return out


def ensembles(a: list[str], b: list[str]) -> np.ndarray:
    token_set = token_set_ratios(a, b)
    return (weighted_ratios(a, b, token_set) + token_set + partial_ratios(a, b)) / 3.0


MANY = {
    "ratio": ratios,
    "token_sort": lambda a, b: ratios(_in_order(a), _in_order(b)),
    "token_set": token_set_ratios,
    "partial": partial_ratios,
    "weighted": weighted_ratios,
    "ensemble": ensembles,
}


def score(name: str, a: Column, b: Column) -> Column:
    """An edit-based score of two string columns; null counts as ''.  Equal pairs of a batch are worked out once, all at a time."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        pairs = list(zip(x.fillna(""), y.fillna("")))
        distinct = list(dict.fromkeys(pairs))
        made = dict(zip(distinct, MANY[name]([p[0] for p in distinct], [p[1] for p in distinct]).tolist()))
        return pd.Series([made[p] for p in pairs], dtype="float64")

    return run(a, b)


def text_words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda w: w != ""))


def word_overlap(a: Column, b: Column) -> Column:
    """Jaccard index of the words that are no numbers; 0 if either side has none."""
    keep = lambda c: F.filter(text_words(c), lambda w: ~w.rlike(r"^[0-9]+$"))
    x, y = keep(a), keep(b)
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))).otherwise(0.0)


def length_ratio(a: Column, b: Column) -> Column:
    """Fewer words over more words; 0 if either side has none."""
    n = lambda c: F.size(F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda w: w != ""))
    return F.when((n(a) > 0) & (n(b) > 0), F.least(n(a), n(b)) / F.greatest(n(a), n(b))).otherwise(0.0)


def gated_blend(overlap: Column, lengths: Column, sort: Column, partial: Column) -> Column:
    """0.7 sort + 0.3 partial (cut by the length ratio below one half); 0 under 0.30 overlap."""
    cut = F.when(lengths < 0.5, partial * lengths).otherwise(partial)
    return F.when(overlap < 0.30, 0.0).otherwise(0.7 * sort + 0.3 * cut)


def even_blend(sort: Column, token_set: Column) -> Column:
    return 0.5 * sort + 0.5 * token_set


def brand_strict(raw: Column, brand_a: Column, brand_b: Column, same: Column, first_words_alike: Column, overlap: Column) -> Column:
    """struct(score, status): ``raw`` times what brands and shared words allow.

    ``brand_a``, ``brand_b``: the brands found, null if none; ``same``: whether they agree;
    ``first_words_alike``: whether the first words do, for pairs without a brand;
    ``overlap``: Jaccard index of the product words.
    """
    both, none = brand_a.isNotNull() & brand_b.isNotNull(), brand_a.isNull() & brand_b.isNull()
    level = F.when(overlap < 0.30, "low").when(overlap < 0.55, "mid").otherwise("full")
    cuts = lambda low: F.when(level == "low", low).when(level == "mid", 0.88).otherwise(1.0)
    factor = F.when(both & same, cuts(0.72)).when(none & first_words_alike, cuts(0.70)).otherwise(0.0)
    status = (
        F.when(both & same, F.concat(F.lit("brand_match_"), level))
        .when(both, F.lit("brand_mismatch"))
        .when(~none, F.lit("brand_one_sided"))
        .when(first_words_alike, F.concat(F.lit("no_brand_"), level))
        .otherwise(F.lit("no_brand_other_first_word"))
    )
    return F.struct((raw * factor).alias("score"), status.alias("status"))


def fuse(ai: Column, fuzzy: Column, same_item: Column) -> Column:
    """Score of a vector and a fuzzy candidate: blended if they agree, else the fuzzy one if clearly better, else the vector one."""
    return F.when(same_item, 0.65 * ai + 0.35 * fuzzy).when((fuzzy > ai + 0.05) & (fuzzy >= 0.82), fuzzy).otherwise(ai)


def name_or_category_blend(ai: Column, name: Column, category: Column) -> Column:
    return 0.65 * ai + 0.35 * F.greatest(name, category)


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays, in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def cosine_percent(similarity: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), (similarity + 1) / 2 * 100))
