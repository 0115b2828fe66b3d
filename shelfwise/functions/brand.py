"""Brand tokens, overlap, labels and keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions import fixed
from shelfwise.functions.parse import let


def _alias(token: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in fixed.BRAND_ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, token), token)


def brand_tokens(raw: Column) -> Column:
    """Sorted distinct tokens of a brand text: its words and its first three words joined, aliases resolved, generic words left out."""
    t = F.regexp_replace(F.regexp_replace(F.upper(F.coalesce(raw.cast("string"), F.lit(""))), "'", ""), "[-./:]", " ")
    found = F.regexp_extract_all(t, F.lit("([A-Z0-9&]+)"), 1)

    def pick(tokens: Column) -> Column:
        joined = F.array_join(F.slice(tokens, 1, 3), "")
        whole = F.when((F.size(tokens) >= 2) & ~joined.isin(fixed.NOT_BRANDS) & (F.char_length(joined) >= 4), F.array(_alias(joined)))
        single = F.filter(tokens, lambda w: ~w.isin(fixed.NOT_BRANDS) & ~w.rlike("^[0-9]+$") & (F.char_length(w) >= 2))
        return F.array_sort(F.array_distinct(F.concat(F.coalesce(whole, F.array().cast("array<string>")), F.transform(single, _alias))))

    return let(found, pick)


def brand_from_name(name: Column, look_at: int = 2) -> Column:
    """The first of the leading words that can be a brand, as an array of one; empty if there is none."""
    leading = F.slice(F.split(F.coalesce(name, F.lit("")), r"\s+"), 1, look_at)
    fit = F.filter(leading, lambda w: ~w.isin(fixed.NOT_BRANDS) & ~w.rlike("^[0-9]+$") & (F.char_length(w) >= 3))
    return F.transform(F.slice(fit, 1, 1), _alias)


def source_brand(group: Column, name: Column) -> Column:
    """struct(tokens, label): brand tokens of the group text and its text; where it has none, the brand that opens the name."""
    hint, opening = brand_tokens(group), brand_from_name(name)
    none = F.struct(F.array().cast("array<string>").alias("tokens"), F.lit("").alias("label"))
    of_group = F.struct(hint.alias("tokens"), F.trim(group.cast("string")).alias("label"))
    of_name = F.struct(opening.alias("tokens"), F.array_join(opening, ", ").alias("label"))
    return F.when(F.size(hint) > 0, of_group).when(F.size(opening) > 0, of_name).otherwise(none)


def brands_overlap(a: Column, b: Column, min_length: int = 5) -> Column:
    """Whether a token of ``a`` equals one of ``b``, or, both being long enough, contains it or shares its first ``min_length`` characters."""
    long = lambda x, y: (F.char_length(x) >= min_length) & (F.char_length(y) >= min_length)
    close = lambda x, y: long(x, y) & (x.contains(y) | y.contains(x) | (F.substring(x, 1, min_length) == F.substring(y, 1, min_length)))
    return F.exists(a, lambda x: F.exists(b, lambda y: (x == y) | close(x, y)))


def brand_label(source: Column, customer: Column, score: Column, threshold: float = 75) -> Column:
    """N/A, Exact, Fuzzy or Mismatch; ``score`` is the token-sort ratio of the two."""
    clean = lambda c: F.lower(F.trim(F.coalesce(c.cast("string"), F.lit(""))))
    s, c = clean(source), clean(customer)
    return (
        F.when(s.isin("", "nan", "none") | c.isin("", "nan", "none"), "N/A")
        .when(s == c, "Exact")
        .when(score >= threshold, "Fuzzy")
        .otherwise("Mismatch")
    )


def brand_key(raw: Column) -> Column:
    """Child part after the last ' - ', upper case, an IMP or IMPORT suffix dropped, letters and digits only."""
    child = F.element_at(F.split(F.upper(F.coalesce(raw, F.lit(""))), " - "), -1)
    return F.regexp_replace(F.regexp_replace(F.trim(child), r"\s*\(?\b(IMP|IMPORT)\b\)?\s*$", ""), "[^A-Z0-9]", "")


def variant_words(a: Column) -> Column:
    """For each variant group, its words in a token array, sorted and joined; an empty text if there are none."""
    return F.array(*[F.array_join(F.array_sort(F.array_intersect(a, F.array(*[F.lit(w) for w in group]))), " ") for group in fixed.VARIANT_GROUPS])


def variant_conflict(a: Column, b: Column) -> Column:
    """Whether two token arrays hold different words of one variant group."""
    clash = F.lit(False)
    for group in fixed.VARIANT_GROUPS:
        members = F.array(*[F.lit(w) for w in group])
        x, y = F.array_sort(F.array_intersect(a, members)), F.array_sort(F.array_intersect(b, members))
        clash = clash | ((F.size(x) > 0) & (F.size(y) > 0) & (x != y))
    return clash
