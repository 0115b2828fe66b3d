"""Free-text product descriptions into name, weight, kind and pack, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions import fixed


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def spell_out(text: Column) -> Column:
    """Whole words replaced by their long forms."""
    swap = lambda t, table: F.array_join(F.transform(F.split(t, r"\b"), lambda w: F.coalesce(F.try_element_at(_map(table), w), w)), "")
    first = F.regexp_replace(swap(text, fixed.SPELLED_FIRST), r"\b&\b", "and")
    return swap(first, fixed.SPELLED_AFTER)


def prepare(text: Column) -> Column:
    """Upper case, '= . , ; :' to spaces, dashes and bracketed product codes dropped, words spelled out; null gives ''."""
    t = F.regexp_replace(F.upper(F.coalesce(text, F.lit(""))), r"[=\.,;:]", " ")
    return spell_out(F.regexp_replace(F.regexp_replace(t, "-", ""), fixed.PRODUCT_CODE, " "))


def _sizes(t: Column, pattern: str) -> Column:
    """Array of struct(size in base units, kind) of a pattern's matches, in order."""
    factor = _unit_map(0)
    kind = _unit_map(1)
    pairs = F.arrays_zip(
        F.regexp_extract_all(t, F.lit(pattern), 1).alias("n"),
        F.regexp_extract_all(t, F.lit(pattern), 2).alias("u"),
    )
    return F.transform(pairs, lambda p: F.struct((p["n"].cast("double") * F.try_element_at(factor, p["u"])).alias("size"), F.try_element_at(kind, p["u"]).alias("kind")))


def _unit_map(k: int) -> Column:
    return F.create_map(*[F.lit(x) for unit, v in fixed.UNITS.items() for x in (unit, v[k])])


def sizes(t: Column) -> Column:
    return F.concat(_sizes(t, fixed.SIZE), _sizes(t, fixed.GLUED))


def pack_of(t: Column) -> Column:
    """The longest pack expression without its size and outer X; else the count after a glued size; else ''."""
    found = F.regexp_extract_all(t, F.lit(fixed.PACK), 0)
    ranked = F.transform(found, lambda m, i: F.struct(F.char_length(m).alias("n"), (-i).alias("i"), m.alias("m")))
    bare = F.trim(F.regexp_replace(F.array_max(ranked)["m"], fixed.SIZE, ""))
    tidy = F.btrim(F.regexp_replace(bare, r"\s*X\s*", "X"), F.lit("X"))
    return F.when(F.size(found) > 0, tidy).otherwise(F.regexp_extract(t, fixed.GLUED, 3))


def name_of(t: Column) -> Column:
    for pattern in (fixed.GLUED, fixed.PACK, fixed.SIZE, *fixed.NAME_CUTS):
        t = F.regexp_replace(t, pattern, " ")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def parse_description(text: Column, pick: str = "smallest") -> Column:
    """struct(name, weight, kind, pack).

    ``pick`` says which of several sizes is the weight: the smallest, or the last one named.
    """

    def parts(t: Column) -> Column:
        ranked = F.transform(sizes(t), lambda s, i: F.struct(s["size"].alias("size"), i.alias("i"), s["kind"].alias("kind")))
        best = F.array_min(ranked) if pick == "smallest" else F.try_element_at(ranked, F.lit(-1))
        return F.struct(name_of(t).alias("name"), best["size"].alias("weight"), best["kind"].alias("kind"), pack_of(t).alias("pack"))

    return let(prepare(text), parts)


def size_band(weight: Column) -> Column:
    """20 * log10 of the weight, rounded half to even; null where there is no positive weight."""
    return F.when(weight > 0, F.bround(F.log10(weight) * 20).cast("int"))


def weights_match(a: Column, b: Column, tolerance: float = 0.02) -> Column:
    """True or false where both weights are positive, else null."""
    return F.when((a > 0) & (b > 0), F.least(a, b) / F.greatest(a, b) >= 1 - tolerance)


def weight_label(source: Column, customer: Column, tolerance: float = 0.02) -> Column:
    one = lambda c: F.format_string("%.1f", c)
    return (
        F.when(source.isNull() & customer.isNull(), F.lit("N/A – no weight on either side"))
        .when(customer.isNull(), F.concat(F.lit("Source only – "), one(source)))
        .when(source.isNull(), F.concat(F.lit("Customer only – "), one(customer)))
        .when(F.coalesce(weights_match(source, customer, tolerance), F.lit(False)), F.concat(F.lit("Matched – both "), one(source)))
        .otherwise(F.concat(F.lit("Mismatch – source "), one(source), F.lit(" vs customer "), one(customer)))
    )


def pack_bonus(a: Column, b: Column) -> Column:
    return F.when((a != "") & (a == b), 3.0).otherwise(0.0)


def normalize_weight(w: Column) -> Column:
    """A weight text such as '1.5kg' as a number of g or ml; ounces to two places; null without a unit."""
    t = F.lower(F.trim(w))
    found = r"^(\d+(?:\.\d+)?)\s*(grams?|grms?|gms?|gr|g|kg|ml|litre|liter|ltr|l|oz|cl)"
    n, unit = F.regexp_extract(t, found, 1).try_cast("double"), F.regexp_extract(t, found, 2)
    return (
        F.when(unit.isin("kg", "l", "ltr", "litre", "liter"), n * 1000)
        .when(unit == "cl", n * 10)
        .when(unit == "oz", F.bround(n * 28.3495, 2))
        .when(unit != "", n)
    )


def normalize_pack(p: Column) -> Column:
    """Lower case without a final x; empty gives null."""
    return F.nullif(F.rtrim(F.lower(F.trim(p)), F.lit("x")), F.lit(""))


def clean_description(text: Column) -> Column:
    """Brackets resolved (kept without the marks if they hold a size, else dropped) and a leading code without a size dropped."""
    t = F.trim(F.coalesce(text, F.lit("")))
    sized = rf"(?i)\(([^)]{{0,30}}?{fixed.SIZE.replace('(', '(?:').replace('(?:?:', '(?:')}[^)]{{0,30}}?)\)"
    t = F.regexp_replace(F.regexp_replace(t, sized, " $1 "), r"\([^)]{0,30}\)", " ")
    t = F.trim(F.regexp_replace(F.regexp_replace(t, r"[\[\]{}]", " "), r"\s+", " "))
    code = F.regexp_extract(t, r"^((?:\d[\d.\-]+[A-Z0-9\-]*|[A-Z]\d[A-Z0-9\-]*)\s+)", 1)
    rest = F.substring(t, F.char_length(code) + 1, F.char_length(t))
    return F.when((code != "") & (rest != "") & ~code.rlike(f"(?i){fixed.SIZE}"), F.trim(rest)).otherwise(t)


UNIT_WORDS = "g|gm|gms|gr|grm|grms|gram|grams|kg|ml|l|ltr|litre|liter|oz|cl"


def parse_loose(text: Column, mode: str = "last") -> Column:
    """struct(name, pack, weight) with pack and weight as texts, the whole text in lower case.

    ``last``      the last weight named, then the first pack
    ``packed``    a weight inside a pack expression (4x12x50g, 25gx16) first, else the last
    ``bounded``   the last weight that touches no other letter or digit but an x
    """
    unit = rf"(?:{UNIT_WORDS})"
    plain = rf"\d+(?:\.\d+)?\s*{unit}\b"
    bounded = rf"(?:(?<!\w)|(?<=x))\d+(?:\.\d+)?{unit}(?:(?!\w)|(?=x))"
    inside = rf"(?:\d+\s*x\s*)+(\d+(?:\.\d+)?\s*{unit})\b|(\d+(?:\.\d+)?\s*{unit})\s*x\s*\d+"
    weight_pattern = bounded if mode == "bounded" else plain

    def cut_last(t: Column) -> Column:
        found = F.try_element_at(F.regexp_extract_all(t, F.lit(f"({weight_pattern})"), 1), F.lit(-1))
        head = F.regexp_extract(t, rf"(?s)^(.*(?<![\d.]))(?:{weight_pattern})", 1)
        tail = F.substring(t, F.char_length(head) + F.char_length(found) + 1, F.char_length(t))
        return F.struct(F.when(found.isNull(), t).otherwise(F.concat(head, F.lit(" "), tail)).alias("t"), F.coalesce(found, F.lit("")).alias("w"))

    def cut_inside(t: Column) -> Column:
        w = F.concat(F.regexp_extract(t, inside, 1), F.regexp_extract(t, inside, 2))
        return F.when(t.rlike(inside), F.struct(F.regexp_replace(t, f"^((?s).*?)(?:{inside})", "$1 ").alias("t"), w.alias("w"))).otherwise(cut_last(t))

    def finish(s: Column) -> Column:
        pack = F.regexp_extract(s["t"], r"(\d+\s*x\s*(?:\d+\s*x\s*)*)", 1)
        rest = F.when(pack != "", F.concat(F.substring(s["t"], F.lit(1), F.call_function("locate", pack, s["t"]) - 1), F.lit(" "), F.substring(s["t"], F.call_function("locate", pack, s["t"]) + F.char_length(pack), F.char_length(s["t"])))).otherwise(s["t"])
        return F.struct(
            F.trim(F.regexp_replace(rest, r"\s+", " ")).alias("name"),
            F.rtrim(F.regexp_replace(pack, r"\s+", ""), F.lit("x")).alias("pack"),
            F.regexp_replace(s["w"], r"\s+", "").alias("weight"),
        )

    t = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    return let(let(t, cut_inside if mode == "packed" else cut_last), finish)
