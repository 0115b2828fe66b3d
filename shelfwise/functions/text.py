"""Text normalisation as column expressions; a null gives what each docstring says, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions import fixed

#: A word's edge by ASCII letters, digits and _ alone; Java's own edge counts letters of all scripts.
ASCII_EDGE = r"(?:(?<![0-9A-Za-z_])(?=[0-9A-Za-z_])|(?<=[0-9A-Za-z_])(?![0-9A-Za-z_]))"


def normalize(c: Column) -> Column:
    """Lower case, punctuation to spaces, spaces squeezed; null gives ''."""
    plain = F.regexp_replace(F.lower(F.coalesce(c.cast("string"), F.lit(""))), r"(?U)[^\w\s]", " ")
    return F.trim(F.regexp_replace(plain, r"(?U)\s+", " "))


def combined(*columns: Column) -> Column:
    """Non-empty normalised columns, joined by a space."""
    return F.concat_ws(" ", *[F.nullif(normalize(c), F.lit("")) for c in columns])


def name_key(c: Column) -> Column:
    """Upper case, spaces squeezed; empty gives null."""
    return F.nullif(F.upper(F.regexp_replace(F.trim(c.cast("string")), r"\s+", " ")), F.lit(""))


def blank_to_null(c: Column) -> Column:
    """Null for '', 'nan', 'none' and 'null' in any case."""
    t = F.trim(c.cast("string"))
    return F.when(~F.lower(t).isin("", "nan", "none", "null"), t)


def clean_header(name: str) -> str:
    """A header as a column name: trimmed, lower case, spaces to underscores."""
    return "_".join(name.strip().lower().split())


def stringify(c: Column) -> Column:
    """Cast to string; nulls stay null."""
    return c.cast("string")


def lower_trim(c: Column) -> Column:
    return F.lower(F.trim(c.cast("string")))


def tokens(c: Column, pattern: str = "[A-Z0-9&]+") -> Column:
    """Distinct tokens of the upper-cased text."""
    return F.array_distinct(F.regexp_extract_all(F.upper(F.coalesce(c, F.lit(""))), F.lit(f"({pattern})"), 1))


def name_tokens(c: Column, stop_words: list[str], min_length: int = 3) -> Column:
    """Distinct tokens of at least ``min_length`` characters that are no stop words."""
    return F.filter(tokens(c), lambda t: (F.char_length(t) >= min_length) & ~t.isin(stop_words))


def label_text(c: Column) -> Column:
    """Category labels: the prefixes F6_ and IH dropped, brackets, slashes and underscores to spaces, '&' to 'and', spaces squeezed."""
    t = F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"(?i)^(F6_|IH\s+)", "")
    t = F.regexp_replace(F.regexp_replace(t, "[()/_]", " "), "&", " and ")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def singular(word: Column) -> Column:
    """A plain English singular: ies to y, es after s, x, z and h, else a final s but not ss."""
    n = F.char_length(word)
    return (
        F.when((n > 4) & word.endswith("ies"), F.concat(F.substring(word, 1, n - 3), F.lit("y")))
        .when((n > 4) & word.rlike("[sxzh]es$"), F.substring(word, 1, n - 2))
        .when((n > 3) & word.endswith("s") & ~word.endswith("ss"), F.substring(word, 1, n - 1))
        .otherwise(word)
    )


def label_tokens(c: Column) -> Column:
    """Distinct singular tokens of a label."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("([a-z]+)"), 1), singular))


def content_key(*columns: Column, length: int = 20) -> Column:
    """First characters of the SHA-256 of the columns, parted by NUL; null counts as ''."""
    return F.substring(F.sha2(F.concat_ws("\0", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]), 256), 1, length)


def ngrams(words: Column, most: int) -> Column:
    """Array of struct(start, n, gram) of all runs of 1..most words."""
    def sized(n: int) -> Column:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(i.alias("start"), F.lit(n).alias("n"), F.array_join(F.slice(words, i + 1, n), " ").alias("gram")))

    return F.concat(*[sized(n) for n in range(1, most + 1)])


def tight(c: Column) -> Column:
    """Upper-case letters and digits only."""
    return F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9]", "")


def words(c: Column) -> Column:
    """Upper-case words of letters and digits, in order."""
    return F.regexp_extract_all(F.upper(F.coalesce(c, F.lit(""))), F.lit("([A-Z0-9]+)"), 1)


def normalize_name(c: Column) -> Column:
    """Name for comparison: units in one spelling, letters and digits only, stop words and single characters dropped."""
    t = F.lower(F.coalesce(c, F.lit("")))
    for pattern, unit in (("litre|litres|liter|liters|ltr|ltrs", "l"), ("kilogram|kilograms|kilo|kilos|kg|kgs", "kg"), ("gram|grams|grm|grms|g|gr|gm|gms", "g"), ("millilitre|millilitres|milliliter|milliliters", "ml"), ("pound|pounds", "lb"), ("ounce|ounces", "oz")):
        t = F.regexp_replace(t, rf"\b({pattern})\b", unit)
    kept = F.filter(F.split(F.regexp_replace(t, r"[^a-z0-9\s]", " "), r"\s+"), lambda w: ~w.isin(fixed.NAME_STOP_WORDS) & (F.char_length(w) > 1))
    return F.array_join(kept, " ")


def retail_text(c: Column) -> Column:
    """Retail description for comparison; the passes must run in this order.

    Units in one spelling, packs of packs to their size, sizes glued, counts, pack words,
    giveaways and percentages dropped, digits parted from letters, words in one spelling,
    stop words dropped.
    """
    t = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    size = r"\d+\.?\d*(?:ml|l|kg|g|oz|lb)?"
    passes = [
        *fixed.RETAIL_UNITS,
        (r"(\d+)(m)\b(?!l)", "$1ml"),
        (rf"\b\d+x\d+x\d+x?({size})\b", "$1"),
        (rf"\b\d+x\d+x({size})\b", "$1"),
        (r"(\d+\.?\d*)\s*(ml|l|kg|g|oz|lb)\b", "$1$2"),
        (r"\s*x\s*\d+\b(?!\s*(?:ml|l|kg|g|oz|lb))", " "),
        (r"\b(carton|ctn|case|pack|pcs?|units?|pieces?|promo|shrink|bundle|offer|sp|foc|eoe|eof|po)\b", ""),
        (r"\b(ndw|foc|alu|tb|sl|cpd|tetra|ec|qnie)\b", ""),
        (r"\(\d+\s*free\)|\b\d+\s*free\b", ""),
        (r"\d+%\s*(?:off|extra|free|discount)?\b", ""),
        (r"\b(\d+)s\b", "$1"),
        (r"(?U)[^\w\s]", " "),
        (r"([a-z])(\d)", "$1 $2"),
        (r"(\d)([a-z])", "$1 $2"),
        (r"\b(gr|gm)\b", "g"),
        *fixed.RETAIL_WORDS,
    ]
    for pattern, by in passes:
        t = F.regexp_replace(t, pattern, by)
    return F.array_join(F.filter(F.split(t, r"\s+"), lambda w: (w != "") & ~w.isin(fixed.RETAIL_STOP_WORDS)), " ")


def extract_brand(norm: Column, known: list[str], aliases: dict[str, str] | None = None) -> Column:
    """struct(brand, product): the first three, two or one words that are a known brand (or an alias of one), and the rest."""
    words_ = F.filter(F.split(F.coalesce(norm, F.lit("")), " "), lambda w: w != "")
    table = F.create_map(*[F.lit(x) for pair in (aliases or {"": ""}).items() for x in pair])

    def attempt(n: int) -> Column:
        start = F.array_join(F.slice(words_, 1, n), " ")
        full = F.coalesce(F.try_element_at(table, start), start)
        brand = F.when(full.isin(known), full).when(start.isin(known), start)
        rest = F.array_join(F.slice(words_, n + 1, F.greatest(F.lit(0), F.size(words_) - n)), " ")
        return F.when((F.size(words_) >= n) & brand.isNotNull(), F.struct(brand.alias("brand"), rest.alias("product")))

    none = F.struct(F.lit(None).cast("string").alias("brand"), F.coalesce(norm, F.lit("")).alias("product"))
    return F.coalesce(attempt(3), attempt(2), attempt(1), none)


def brands_match(a: Column, b: Column, ratio: Column, aliases: dict[str, str] | None = None, least: float = 85.0) -> Column:
    """Whether two brands are one: equal, of one alias, or close; ``ratio`` is that of the two without spaces.  False for null."""
    table = F.create_map(*[F.lit(x) for pair in (aliases or fixed.RETAIL_BRANDS).items() for x in pair])
    full = lambda c: F.coalesce(F.try_element_at(table, c), c)
    return F.coalesce((a == b) | (full(a) == full(b)) | (ratio >= least), F.lit(False))


def hint_text(*columns: Column) -> Column:
    """Filled columns, joined by ' | '."""
    return F.concat_ws(" | ", *[blank_to_null(c) for c in columns])


def hint_map(columns: dict[str, Column]) -> Column:
    """Map of the filled columns."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), blank_to_null(c).alias("value")) for k, c in columns.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in columns])


def safe_float(c: Column, default: float = 0.0) -> Column:
    """A number text as a double; the default for null, truth values and anything else."""
    t = c.cast("string")
    return F.coalesce(F.when(~F.lower(F.trim(t)).isin("true", "false"), t.try_cast("double")), F.lit(default))


def json_answer(raw: Column, schema: str) -> Column:
    """A JSON object, also where other text stands around it; null if there is none."""
    clean = F.from_json(F.trim(raw), schema)
    inner = F.from_json(F.regexp_extract(raw, r"(?s)(\{.*\})", 1), schema)
    filled = lambda s: F.when(F.to_json(s) != "{}", s)
    return F.coalesce(filled(clean), filled(inner))
