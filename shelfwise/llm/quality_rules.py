"""Quality rules as a bitmask ledger, in DataFrame functions only.

``ledger`` evaluates every rule once per document and stores the measurements and one
bit per failed rule.  ``apply_policy`` keeps documents whose failures miss a policy's
mask; ``ablation`` counts, per rule, the documents that it fails and those that it alone
fails, from the distinct bit patterns.  ``write_ledger`` stores the ledger in the shared
folder, so that policies and ablations read it and never the texts.

Repeated words: 3-word windows are compared by the 64-bit hash of their words' hashes.
Only texts in which a window repeats take the sorting path, which is n log n.

Cases: null and empty texts have no words and fail the length rule; repeated rows are
judged each on their own; very long texts are taken whole; an empty table gives an empty
result; further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.session import Scratch

MIN_WORDS = 50
#: Name of each rule, in the order of the bits.
RULES = ("short", "repeats", "symbols", "dup_lines", "word_length", "shouting")
#: Policies by version: the rules that decide.
POLICIES = {
    "base": ("short", "repeats"),
    "v1": RULES,
    "lenient": ("short", "repeats", "symbols"),
}
SYMBOLS = "#*$%&|<>"
OTHER_SPACE = "\t\n\x0b\x0c\r"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _covered(grams: Column) -> Column:
    """Number of words in windows whose hash occurs twice or more."""
    placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        same = F.transform(
            s,
            lambda x, j: F.when((F.get(s, j - 1)["g"] == x["g"]) | (F.get(s, j + 1)["g"] == x["g"]), x["i"]),
        )
        return F.sort_array(F.filter(same, lambda i: i.isNotNull()))

    def total(p: Column) -> Column:
        steps = F.transform(p, lambda i, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - i, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    return _let(_let(placed, repeated), total)


def _replace(text: Column, chars: str, by: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements."""
    text = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    spaced = text.select("doc_id", "t", _replace(F.col("t"), OTHER_SPACE, " ").alias("s"))
    split = spaced.select(
        "doc_id",
        "t",
        F.filter(F.split("s", " "), lambda w: w != "").alias("w"),
        F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(" " + OTHER_SPACE)) != "").alias("lines"),
        F.char_length(F.replace("s", F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
    )
    hashed = split.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        "word_chars",
        (F.char_length("t") - F.char_length(_replace(F.col("t"), SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.char_length("t") - F.char_length(F.replace("t", F.lit("!"), F.lit("")))).cast("long").alias("n_bangs"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    grams = F.when(
        F.size("h") >= 3,
        F.transform(F.sequence(F.lit(0), F.size("h") - 3), lambda i: F.xxhash64(F.get("h", i), F.get("h", i + 1), F.get("h", i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    windows = hashed.select("*", grams.alias("g")).drop("h")
    repeats = F.when(F.size(F.array_distinct("g")) < F.size("g"), _covered(F.col("g"))).otherwise(0)
    return windows.select("*", repeats.cast("long").alias("n_repeat_words")).drop("g")


def failures() -> dict[str, Column]:
    """The condition of failing each rule, over the measurements."""
    n = F.col("n_words")
    return {
        "short": n < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "dup_lines": (F.col("n_lines") >= 4) & (2 * F.col("n_dup_lines") > F.col("n_lines")),
        "word_length": (n > 0) & ((F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)),
        "shouting": 5 * F.col("n_bangs") > n,
    }


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and ``fail_bits``: bit i is set where RULES[i] fails."""
    conditions = failures()
    bits = F.lit(0).cast("long")
    for i, name in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(conditions[name], F.lit(1 << i)).otherwise(0).cast("long"))
    return measure(docs).withColumn("fail_bits", bits)


def write_ledger(docs: DataFrame) -> DataFrame:
    """The ledger, written once; everything that follows reads the table."""
    return Scratch(docs.sparkSession, "ledger").table(ledger(docs), "ledger")


def mask_of(policy: str) -> int:
    return sum(1 << RULES.index(name) for name in POLICIES[policy])


def apply_policy(book: DataFrame, policy: str = "v1") -> DataFrame:
    """``book`` with ``policy``, its version, and ``kept``."""
    return book.withColumns({"policy": F.lit(policy), "kept": F.col("fail_bits").bitwiseAND(F.lit(mask_of(policy))) == 0})


def ablation(book: DataFrame, policy: str = "v1") -> DataFrame:
    """rule, n_failed, n_only: documents that fail the rule, and that fail no other of the policy."""
    mask = mask_of(policy)
    patterns = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).count()
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << RULES.index(name)).cast("long").alias("bit")) for name in POLICIES[policy]])
    rows = patterns.select("bits", "count", F.explode(rules).alias("r")).where(F.col("bits").bitwiseAND(F.col("r.bit")) != 0)
    return rows.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum("count").alias("n_failed"), F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("count")).otherwise(0)).alias("n_only")
    )
