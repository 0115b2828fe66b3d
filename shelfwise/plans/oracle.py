"""DuckDB SQL texts that several oracles share: edit scores by bit-parallel subsequences, brand tokens, word lists."""

from __future__ import annotations

from shelfwise.functions import fixed


def listed(values: list[str]) -> str:
    """A SQL list of texts."""
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def mapped(table: dict[str, str], key: str) -> str:
    """The value of a key in a table of texts, or the key itself."""
    return f"coalesce(map({listed(list(table))}, {listed(list(table.values()))})[{key}], {key})"


def words(c: str) -> str:
    """Words between white space, in order."""
    return f"list_filter(string_split_regex({c}, '\\s+'), lambda x: x <> '')"


def common(a: str, b: str) -> str:
    """Length of the longest common subsequence of two texts of at most 120 characters: one big integer per letter of ``b``."""
    full = f"((1::HUGEINT << length({a})) - 1)"
    bit = f"CASE WHEN substr({a}, CAST(i AS INTEGER), 1) = ch THEN 1::HUGEINT << CAST(i - 1 AS INTEGER) ELSE 0::HUGEINT END"
    places = f"list_reduce(list_prepend(0::HUGEINT, list_transform(range(1, length({a}) + 1), lambda i: {bit})), lambda p, q: p + q)"
    steps = f"list_prepend({full}, list_transform(string_split({b}, ''), lambda ch: {places}))"
    return f"(length({a}) - bit_count(list_reduce({steps}, lambda row, m: ((row + (row & m)) | (row - (row & m))) & {full})))"


def ratio(a: str, b: str) -> str:
    return f"(CASE WHEN length({a}) + length({b}) = 0 THEN 100.0 WHEN length({a}) = 0 OR length({b}) = 0 THEN 0.0 ELSE 200.0 * {common(a, b)} / (length({a}) + length({b})) END)"


def partial(a: str, b: str) -> str:
    """Best ratio of the shorter text against all windows of its length of the longer one, cut-off ones included; of two of one length, both ways."""
    s, t = f"(CASE WHEN length({a}) <= length({b}) THEN {a} ELSE {b} END)", f"(CASE WHEN length({a}) <= length({b}) THEN {b} ELSE {a} END)"

    def best(short: str, long: str) -> str:
        window = f"substr({long}, CAST(greatest(0, e - length({short})) + 1 AS INTEGER), CAST(least(e, length({long})) - greatest(0, e - length({short})) AS INTEGER))"
        return f"list_max(list_transform(range(1, length({long}) + length({short})), lambda e: {ratio(short, window)}))"

    either = f"CASE WHEN length(z.s) = length(z.t) THEN greatest({best('z.s', 'z.t')}, {best('z.t', 'z.s')}) ELSE {best('z.s', 'z.t')} END"
    return f"(SELECT CASE WHEN z.s = '' THEN CASE WHEN z.t = '' THEN 100.0 ELSE 0.0 END WHEN contains(z.t, z.s) THEN 100.0 ELSE {either} END FROM (SELECT {s} AS s, {t} AS t) z)"


def scored(source: str) -> str:
    """Common table expressions that end in ``scored``: ``source`` (id, a, b) with ratio, token_sort, token_set, partial, weighted, ensemble."""
    gap = "(CASE WHEN shared <> '' THEN 1 ELSE 0 END)"
    n_left, n_right = f"(length(shared) + {gap} + length(lft))", f"(length(shared) + {gap} + length(rgt))"
    apart = f"(length(lft) + length(rgt) - 2 * {common('lft', 'rgt')})"
    side = lambda n, rest: f"100.0 - 100.0 * ({gap} + length({rest})) / (length(shared) + {n})"
    token_set = (
        f"CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 WHEN shared <> '' AND (lft = '' OR rgt = '') THEN 100.0 ELSE greatest(100.0 - 100.0 * {apart} / ({n_left} + {n_right}), "
        f"CASE WHEN shared <> '' THEN greatest({side(n_left, 'lft')}, {side(n_right, 'rgt')}) ELSE 0.0 END) END"
    )
    partial_token = f"CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 WHEN shared <> '' THEN 100.0 ELSE greatest({partial('sa', 'sb')}, {partial('lft', 'rgt')}) END"
    longer = "(greatest(length(a), length(b)) / least(length(a), length(b)))"
    return f"""_w AS (SELECT *, {words('a')} AS x, {words('b')} AS y FROM {source}),
_p AS (SELECT *, array_to_string(list_sort(x), ' ') AS sa, array_to_string(list_sort(y), ' ') AS sb, array_to_string(list_sort(list_intersect(list_distinct(x), list_distinct(y))), ' ') AS shared,
  array_to_string(list_sort(list_filter(list_distinct(x), lambda v: NOT list_contains(y, v))), ' ') AS lft, array_to_string(list_sort(list_filter(list_distinct(y), lambda v: NOT list_contains(x, v))), ' ') AS rgt FROM _w),
_s AS (SELECT *, {ratio('a', 'b')} AS ratio, {ratio('sa', 'sb')} AS token_sort, {token_set} AS token_set, {partial('a', 'b')} AS partial FROM _p),
_t AS (SELECT *, CASE WHEN a <> '' AND b <> '' AND {longer} >= 1.5 THEN {partial_token} END AS partial_token FROM _s),
_v AS (SELECT *, CASE WHEN a = '' OR b = '' THEN 0.0 WHEN {longer} < 1.5 THEN greatest(ratio, 0.95 * greatest(token_sort, token_set))
  ELSE greatest(ratio, (CASE WHEN {longer} <= 8 THEN 0.9 ELSE 0.6 END) * partial, 0.95 * (CASE WHEN {longer} <= 8 THEN 0.9 ELSE 0.6 END) * partial_token) END AS weighted FROM _t),
scored AS (SELECT *, (weighted + token_set + partial) / 3.0 AS ensemble FROM _v)"""


def brand_tokens(raw: str) -> str:
    """Sorted distinct tokens of a brand text."""
    found = f"regexp_extract_all(regexp_replace(replace(upper(coalesce({raw}, '')), '''', ''), '[-./:]', ' ', 'g'), '[A-Z0-9&]+')"
    joined = f"array_to_string({found}[1:3], '')"
    whole = f"CASE WHEN len({found}) >= 2 AND NOT list_contains({listed(fixed.NOT_BRANDS)}, {joined}) AND length({joined}) >= 4 THEN [{mapped(fixed.BRAND_ALIASES, joined)}] ELSE [] END"
    single = f"list_filter({found}, lambda w: NOT list_contains({listed(fixed.NOT_BRANDS)}, w) AND NOT regexp_full_match(w, '[0-9]+') AND length(w) >= 2)"
    return f"list_sort(list_distinct(list_concat({whole}, list_transform({single}, lambda w: {mapped(fixed.BRAND_ALIASES, 'w')}))))"


def overlap(a: str, b: str) -> str:
    """Whether a token of one list equals one of the other or, both being long enough, holds it or opens like it."""
    close = "length(p) >= 5 AND length(q) >= 5 AND (contains(p, q) OR contains(q, p) OR left(p, 5) = left(q, 5))"
    return f"(len(list_filter({a}, lambda p: len(list_filter({b}, lambda q: p = q OR ({close}))) > 0)) > 0)"


def variant_conflict(a: str, b: str) -> str:
    """Whether two lists of tokens hold different words of one variant group."""
    one = lambda g: f"(SELECT len(u) > 0 AND len(v) > 0 AND u <> v FROM (SELECT list_sort(list_intersect({a}, {listed(g)})) AS u, list_sort(list_intersect({b}, {listed(g)})) AS v))"
    return "(" + " OR ".join(one(g) for g in fixed.VARIANT_GROUPS) + ")"


def tokens(c: str, pattern: str = "[A-Z0-9&]+") -> str:
    return f"list_distinct(regexp_extract_all(upper(coalesce({c}, '')), '{pattern}'))"


def brand_key(raw: str) -> str:
    """Child part after the last ' - ', upper case, an import suffix dropped, letters and digits only."""
    child = f"trim(string_split(upper(coalesce({raw}, '')), ' - ')[-1])"
    return f"regexp_replace(regexp_replace({child}, '\\s*\\(?\\b(IMP|IMPORT)\\b\\)?\\s*$', ''), '[^A-Z0-9]', '', 'g')"


def passes(text: str, patterns: list[tuple[str, str]]) -> str:
    """A text after replacements, in order; ``$1`` in a replacement names a group."""
    for pattern, by in patterns:
        text = f"regexp_replace({text}, '{pattern.replace(chr(39), chr(39) * 2)}', '{by.replace('$', chr(92))}', 'g')"
    return text
