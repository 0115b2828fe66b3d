"""Category rules, word profiles, audits and status columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.text import label_text, label_tokens, words
from shelfwise.operators.rows import runner_up_margin

# ---- Fixed values: results depend on exactly these, so they are stated as they are. ----

#: Words that name a product's form, and what a neighbour must hold to support it.
FORM_WORDS = {
    "jam": ["jam", "preserve", "marmalade"],
    "masala": ["masala", "spice mix", "seasoning", "chillies", "spices"],
    "sauce": ["sauce"],
    "ketchup": ["ketchup"],
    "syrup": ["syrup"],
    "paste": ["paste"],
    "powder": ["powder"],
    "seasoning": ["seasoning", "masala"],
    "marinade": ["marinade", "masala"],
    "pickle": ["pickle", "pickled"],
    "mix": ["mix"],
    "olives": ["olv", "olives"],
}
#: Trigger in the name, what must not occur in name, category or brand, and the category; the first that fits counts.
KEYWORD_RULES = [
    (r"\bCUP\s?CAKE(S)?\b|\bCAKE(S)?\b", r"\bMIX(ES)?\b|\bDECORAT|\bGATEAU|\bPIE(S)?\b", "CAKES"),
    (
        r"\bMILK\b|\bYOGH?URT\b|\bYOGH?OURT\b",
        r"CHOCOLAT|\bCHOCO\b|CADBURY|POWDER|COCONUT|\bWAFER|\bBISCUIT|\bTABLET|\bCANDY|\bCANDIES|\bFILLED\b|"
        r"\bFILLING\b|\bGATEAU|\bFUDGE|\bTOFFEE|\bPRALINE|\bCRUNCH|\bCARAMEL",
        "DAIRY PRODUCT",
    ),
]
TEA_RULES = [
    (r"\bGREEN\b", "GREEN TEA"),
    (r"\bBLACK\b", "BLACK TEA BAG"),
    (r"HERBAL|INFUSION|CHAMOMILE|CAMOMILE|MINT|ROOIBOS|LEMON|GINGER|SLIM|DIGEST|IMMUNE|HIBISCUS|SAGE", "SPECIALITY TEA"),
]
NON_FOOD_SIGNALS = [
    "CLEANING", "DETERGENT", "DISPOSABLE", "MCHN", "MACHINE", "BARISTA", "ACCESSORIES", "ACCS", "TOOLS", "PACKING",
    "ALUMINIUM", "FOIL", "HYGIENE", "INSECTICIDE", "SOAP", "DIAPER", "BODY CARE", "BABY CARE", "RECHARGE", "SELPAK",
    "CHARCOAL", "NON FOOD", "NON-FOOD", "NONFOOD", "PACKAGING", "EQUIPMENT", "GLOVES", "TISSUE", "WIPES", "NAPKIN",
    "LIGHTER", "MATCHES", "BATTERIES", "STATIONERY", "ELECTRONIC", "COFFEE MCHN",
]

# ---- End of fixed values. ----


def _any(text: Column, parts: list[str]) -> Column:
    return F.exists(F.array(*[F.lit(p) for p in parts]), lambda p: text.contains(p))


def keyword_category(name: Column, category: Column, brand: Column, rules: list[tuple[str, str, str]] | None = None) -> Column:
    """Category of the first rule whose trigger is in the name and whose exclusion is nowhere in name, category and brand."""
    context = F.concat_ws(" ", name, category, brand)
    out = None
    for trigger, exclude, target in rules or KEYWORD_RULES:
        fits = name.rlike(f"(?iu){trigger}") & ~context.rlike(f"(?iu){exclude}")
        out = F.when(fits, target) if out is None else out.when(fits, target)
    return out


def tea_category(label: Column) -> Column:
    """Tea category of a label that names tea; null if it does not or does not say which."""
    t = F.upper(label_text(label))
    out = F.when(~t.contains("TEA"), F.lit(None).cast("string"))
    for pattern, target in TEA_RULES:
        out = out.when(t.rlike(pattern), target)
    return out.when(t.contains("TEA BAG"), "TEA BAG")


def form_word(name: Column) -> Column:
    """First form word (in the order of the list) among the singular tokens of a name."""
    tokens = label_tokens(name)
    return F.coalesce(*[F.when(F.array_contains(tokens, w.rstrip("s") if w.endswith("s") else w), w) for w in FORM_WORDS])


def form_supported(form: Column, neighbours: Column) -> Column:
    """Whether some neighbour name (lower-case array) holds a word that supports the form; true where there is no form."""
    table = F.create_map(*[x for k, v in FORM_WORDS.items() for x in (F.lit(k), F.array(*[F.lit(s) for s in v]))])
    needed = F.try_element_at(table, form)
    return form.isNull() | F.exists(neighbours, lambda n: F.exists(needed, lambda s: n.contains(s)))


def is_non_food(group: Column) -> Column:
    return F.coalesce(_any(F.upper(group), NON_FOOD_SIGNALS), F.lit(False))


def profile_words(text: Column, stop_words: list[str]) -> Column:
    """Distinct words that are neither stop words nor numbers with a unit."""
    return F.filter(F.array_distinct(words(text)), lambda w: ~w.isin(stop_words) & ~w.rlike("^[0-9]+[A-Z]{0,4}$"))


def category_profiles(trusted: DataFrame, text: str, category: str, stop_words: list[str]) -> DataFrame:
    """(word, category, n, weight): rows with the word per category; weight is one over the word's number of categories."""
    seen = trusted.where(F.col(category).isNotNull() & (F.col(category) != "UNKNOWN")).select(F.explode(profile_words(F.col(text), stop_words)).alias("word"), F.col(category).alias("category"))
    counted = seen.groupBy("word", "category").agg(F.count("*").alias("n"))
    spread = counted.groupBy("word").agg((F.lit(1.0) / F.count("*")).alias("weight"))
    return counted.join(spread, "word")


def suggest_categories(rows: DataFrame, profiles: DataFrame, row_id: str, text: Column, stop_words: list[str], least: float = 2.0, ratio: float = 1.8) -> DataFrame:
    """(row_id, category, score, margin, clear): best category by the summed weights of shared words.

    ``clear``: the score is large enough and beats the next by the factor.
    """
    asked = rows.select(F.col(row_id).alias("row_id"), F.explode(profile_words(text, stop_words)).alias("word"))
    sums = asked.join(profiles, "word").groupBy("row_id", "category").agg(F.round(F.sum("weight"), 6).alias("score"))
    best = runner_up_margin(sums, ["row_id"], "score", "category")
    second = F.col("score") - F.col("margin")
    return best.withColumn("clear", (F.col("score") >= least) & ((second == 0) | (F.col("score") / second >= ratio)))


def audit(rows: DataFrame, suggestions: DataFrame, high: float = 0.80, medium: float = 0.65) -> DataFrame:
    """Adds final_category and flag to rows (row_id, category, category_method, confidence, group)."""
    s = suggestions.select("row_id", F.col("category").alias("_best"), F.col("clear").alias("_clear"), F.col("score").alias("_score"))
    j = rows.join(s, "row_id", "left")
    confidence, known = F.coalesce("confidence", F.lit(0.0)), F.upper(F.coalesce("category", F.lit("UNKNOWN"))) != "UNKNOWN"
    weak = F.coalesce(F.col("_score") < 2.0, F.lit(True))
    flag = (
        F.when(F.col("category_method") == "barcode", "TRUSTED_BARCODE")
        .when((confidence >= high) & known, "OK_HIGH_CONFIDENCE")
        .when((confidence >= medium) & known, "OK_MEDIUM_CONFIDENCE")
        .when(is_non_food(F.col("group")), "NOT_FOOD_NO_CATEGORY_APPLICABLE")
        .when(weak, "NEEDS_MANUAL_REVIEW_NO_MATCH")
        .when(~F.col("_clear"), "NEEDS_MANUAL_REVIEW_AMBIGUOUS")
        .when(F.col("_best") == F.col("category"), "OK_LOW_CONFIDENCE_CONFIRMED")
        .otherwise("REASSIGNED_NEAREST_MATCH")
    )
    out = j.withColumn("flag", flag)
    final = F.when(F.col("flag") == "REASSIGNED_NEAREST_MATCH", F.col("_best")).otherwise(F.col("category"))
    return out.withColumn("final_category", final).drop("_best", "_clear", "_score")


def assign_status(score: Column, match: float = 0.55, review: float = 0.40) -> Column:
    return F.when(score >= match, "MATCHED").when(score >= review, "REVIEW").otherwise("UNMATCHED")


def flagged_for_review(df: DataFrame, status: str = "status") -> DataFrame:
    """Rows whose status text speaks of REVIEW."""
    return df.where(F.coalesce(F.col(status).contains("REVIEW"), F.lit(False)))


def needs_review(category: Column, brand: Column, verified: Column, ambiguous: Column) -> Column:
    """UNKNOWN category, no brand, not verified or ambiguous; null counts as the worse value."""
    return F.coalesce(category == "UNKNOWN", F.lit(True)) | brand.isNull() | ~F.coalesce(verified, F.lit(False)) | F.coalesce(ambiguous, F.lit(False))


def coalesce_passes(base: DataFrame, passes: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """Category and match_source of the first pass (name, (key, category)) that has one."""
    out, values, sources = base, [], []
    for i, (name, found) in enumerate(passes):
        out = out.join(found.select(key, F.col("category").alias(f"_c{i}")), key, "left")
        values.append(F.col(f"_c{i}"))
        sources.append(F.when(F.col(f"_c{i}").isNotNull(), F.lit(name)))
    cols = {"new_category": F.coalesce(*values), "match_source": F.coalesce(*sources, F.lit("unresolved"))}
    return out.withColumns(cols).drop(*[f"_c{i}" for i in range(len(passes))])
