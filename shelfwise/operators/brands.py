"""Brand clustering, consensus and the resolution cascade."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.functions import fixed
from shelfwise.functions.brand import brand_key
from shelfwise.functions.scores import score
from shelfwise.functions.text import ngrams, tight, words
from shelfwise.operators.report import first_distinct
from shelfwise.session import Scratch, ship

METHOD_WEIGHTS = {"barcode": 4, "rule_exact": 3, "rule_fuzzy": 2, "llm": 1}


def brand_counts(df: DataFrame, brand: str = "brand", customer: str = "source_customer") -> DataFrame:
    """(brand, key, n, customers) of the distinct brands."""
    rows = df.where(F.col(brand).isNotNull()).groupBy(F.col(brand).alias("brand"))
    return rows.agg(F.count("*").alias("n"), F.array_sort(F.collect_set(customer)).alias("customers")).withColumn("key", brand_key(F.col("brand")))


def _shortened(text: Column, most: Column) -> Column:
    """A text with up to two of its characters behind the second left out (one where ``most`` is 1), itself included."""
    less = lambda t: F.transform(F.sequence(F.lit(3), F.greatest(F.lit(3), F.char_length(t))), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.char_length(t))))
    once = less(text)
    return F.array_distinct(F.concat(F.array(text), once, F.when(most > 1, F.flatten(F.transform(once, less))).otherwise(F.array().cast("array<string>"))))


def close_keys(keys: DataFrame, exclude: DataFrame | None = None, cutoff: float = 88.0, least: int = 7) -> DataFrame:
    """(a, b): ordered pairs of keys that may be one brand.

    Same first two characters, both long enough, edit distance at most 1 (2 if one is longer
    than ten) and a ratio of at least ``cutoff``; pairs of ``exclude`` never.  Texts of distance
    d become equal when d characters or fewer are left out of each, and what opens both
    alike can stay: keys meet by such shortened forms, so only close ones meet.
    """
    long = keys.select("key").distinct().where(F.char_length("key") >= least)
    # A key of eight characters or fewer meets none that is longer than ten.
    forms = long.select("key", F.explode(_shortened(F.col("key"), F.when(F.char_length("key") >= 9, 2).otherwise(1))).alias("form"))
    pairs = forms.select(F.col("key").alias("a"), "form").join(forms.select(F.col("key").alias("b"), "form"), "form").where("a <> b").select("a", "b").distinct()
    allowed = F.when(F.greatest(F.char_length("a"), F.char_length("b")) <= 10, 1).otherwise(2)
    pairs = pairs.where((F.substring("a", 1, 2) == F.substring("b", 1, 2)) & F.levenshtein("a", "b", 2).between(0, allowed))
    if exclude is not None:
        both = exclude.select("a", "b").union(exclude.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pairs = pairs.join(both, ["a", "b"], "left_anti")
    return pairs.withColumn("score", score("ratio", F.col("a"), F.col("b"))).where(F.col("score") >= cutoff)


def settle_in_order(claims: DataFrame, scratch: Scratch, rows: int = 50_000) -> DataFrame:
    """(key, leads) of every key that an earlier one may claim: it leads if none of these does.

    ``claims``: key, at (its place), by, by_at: ``by`` comes earlier and takes ``key`` if it leads.
    Each round deals the claims on open keys out by the order of the keys; a task goes through
    its keys in order and settles each whose claimants are settled, before or by itself, or
    of whom one leads.  The first open key always settles, and a chain of any length
    needs no more rounds than there are tasks.
    """

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        key, led, open_ = None, False, False
        done: list[tuple[str, bool]] = []
        for batch in batches:
            for v, u, leads in zip(*(batch.column(c).to_pylist() for c in ("key", "by", "leads"))):
                if v != key:
                    if key is not None and (led or not open_):
                        known[key] = not led
                        done.append((key, not led))
                    key, led, open_ = v, False, False
                leads = known.get(u) if leads is None else leads
                led, open_ = led or bool(leads), open_ or leads is None
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done])], ["key", "leads"])
                done = []
        if key is not None and (led or not open_):
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([not led])], ["key", "leads"])

    # Who is claimed by nobody leads.
    free = claims.select(F.col("by").alias("key")).distinct().join(claims.select("key").distinct(), "key", "left_anti")
    pending = scratch.table(claims.join(free.select(F.col("key").alias("by"), F.lit(True).alias("leads")), "by", "left"), "claims-0")
    step, parts = 0, []
    while n := pending.count():
        step += 1
        tasks = -(-n // rows)
        found = pending.repartitionByRange(tasks, "at", "key").sortWithinPartitions("at", "key", "by_at", "by").select("key", "by", "leads").mapInArrow(settle, "key string, leads boolean")
        found = scratch.table(found, f"settled-{step}")
        parts.append(found)
        left = pending.join(found.select("key"), "key", "left_anti")
        left = left.join(found.select(F.col("key").alias("by"), F.col("leads").alias("now")), "by", "left").withColumn("leads", F.coalesce("leads", "now")).drop("now")
        pending = scratch.table(left, f"claims-{step}")
        scratch.drop(f"claims-{step - 1}")
    return functools.reduce(DataFrame.union, parts) if parts else pending.select("key", "leads")


def greedy_stars(keys: DataFrame, close: DataFrame, most: int = 8, rows: int = 50_000) -> DataFrame:
    """(key, leader): keys are taken in order (``position``, then key); a free key leads itself and those of its ``most`` - 1 closest keys that are free.

    A key is claimed by the first leader before it that has it among its closest, so only
    claims by earlier keys count (``settle_in_order``); keys without a claim lead themselves.
    """
    ship(keys.sparkSession)
    scratch = Scratch(keys.sparkSession, "stars")
    nearest = Window.partitionBy("a").orderBy(F.col("score").desc(), "b")
    top = close.withColumn("_n", F.row_number().over(nearest)).where(F.col("_n") < most).select("a", "b")
    of = lambda name, at: keys.select(F.col("key").alias(name), F.col("position").alias(at))
    claims = top.select(F.col("a").alias("by"), F.col("b").alias("key")).join(of("key", "at"), "key").join(of("by", "by_at"), "by")
    claims = scratch.table(claims.where(F.struct("by_at", "by") < F.struct(F.col("at").alias("by_at"), F.col("key").alias("by"))), "claims")
    settled = settle_in_order(claims, scratch, rows)
    followers = settled.where("not leads").select("key")
    first = claims.join(followers, "key").join(followers.withColumnRenamed("key", "by"), "by", "left_anti").groupBy("key").agg(F.min_by("by", F.struct("by_at", "by")).alias("leader"))
    return keys.select("key").join(first, "key", "left").select("key", F.coalesce("leader", "key").alias("leader"))


def _preference(master: str) -> list[Column]:
    """Order of the names of a group: of the master customer first, then without punctuation, shorter, first in order."""
    return [(~F.array_contains("customers", master)).cast("int"), F.col("brand").rlike("['.-]").cast("int"), F.char_length("brand"), F.col("brand")]


def curated(counts: DataFrame, groups: list[list[str]], master: str, names: list[str] | None = None) -> DataFrame:
    """(brand, standardized_brand, n_keys) of groups made by hand of which two members or more occur; a later group wins.

    ``names`` holds each group's name; without it the name is picked as ``standardise`` does.
    """
    listed = counts.sparkSession.createDataFrame([(i, b, names[i] if names else None) for i, g in enumerate(groups) for b in g], "i int, brand string, forced string")
    met = listed.join(counts.select("brand", "key", "customers"), "brand")
    best = met.groupBy("i").agg(F.count("*").alias("n"), F.countDistinct("key").alias("n_keys"), F.coalesce(F.first("forced"), F.min_by("brand", F.struct(*_preference(master)))).alias("std"))
    last = met.join(best.where("n > 1"), "i").groupBy("brand").agg(F.max_by(F.struct("std", "n_keys"), "i").alias("x"))
    return last.select("brand", F.col("x.std").alias("standardized_brand"), "x.n_keys")


def by_hand(counts: DataFrame, master: str) -> DataFrame:
    """(brand, standardized_brand, match_type) of the curated groups and, over them, of the forced names."""
    groups = curated(counts, fixed.CURATED_BRANDS, master).withColumn("match_type", F.when(F.col("n_keys") == 1, "exact_normalized").otherwise("fuzzy_curated"))
    forced = curated(counts, list(fixed.FORCED_BRANDS.values()), master, list(fixed.FORCED_BRANDS)).withColumn("match_type", F.lit("curated_forced_canonical"))
    return forced.unionByName(groups.join(forced.select("brand"), "brand", "left_anti")).select("brand", "standardized_brand", "match_type")


def not_one(spark: SparkSession) -> DataFrame:
    """(a, b): keys that ``close_keys`` must not pair."""
    return spark.createDataFrame(fixed.NOT_ONE_BRAND, "a string, b string")


def standardise(counts: DataFrame, stars: DataFrame, master: str, forced: DataFrame | None = None) -> DataFrame:
    """(brand, standardized_brand, match_type): one name per group.

    The name is a member that the master customer uses, else any; of these the one without
    punctuation, then the shortest, then the first in order.  ``forced`` (brand,
    standardized_brand, and match_type if it differs from "forced") wins over the groups.
    """
    grouped = counts.join(stars, "key")
    order = Window.partitionBy("leader").orderBy(*_preference(master))
    whole = Window.partitionBy("leader")
    named = grouped.withColumns(
        {
            "standardized_brand": F.first("brand").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
            "members": F.count("*").over(whole),
            "keys": F.size(F.collect_set("key").over(whole)),
        }
    )
    kind = F.when(F.col("members") == 1, "single").when(F.col("keys") == 1, "exact_normalized").otherwise("fuzzy")
    out = named.select("brand", "standardized_brand", kind.alias("match_type"))
    if forced is None:
        return out
    f = forced.select("brand", F.col("standardized_brand").alias("_forced"), (F.col("match_type") if "match_type" in forced.columns else F.lit("forced")).alias("_type"))
    both = out.join(f, "brand", "left")
    return both.select(
        "brand", F.coalesce("_forced", "standardized_brand").alias("standardized_brand"), F.coalesce("_type", "match_type").alias("match_type")
    )


def crosswalk(rows: DataFrame, mapping: DataFrame, counts: DataFrame, name: str, row_id: str) -> DataFrame:
    """(raw_brand, standardized_brand, match_type, row_count, customers, examples)."""
    examples = first_distinct(rows, "brand", name, row_id)
    joined = mapping.join(counts.select("brand", F.col("n").alias("row_count"), "customers"), "brand").join(examples, "brand", "left")
    return joined.select(F.col("brand").alias("raw_brand"), "standardized_brand", "match_type", "row_count", F.array_join("customers", "|").alias("customers"), "examples")


def resolve_truncated(rows: DataFrame, mapping: DataFrame, name: str, generic: list[str]) -> DataFrame:
    """Rows whose raw brand is a bare generic token take the standard brand that opens their name (two words, else one)."""
    known = mapping.select(brand_key(F.col("brand")).alias("k"), "standardized_brand").groupBy("k").agg(F.max("standardized_brand").alias("std"))
    w = F.split(F.trim(F.col(name)), r"\s+")
    opened = rows.withColumns({"_two": F.when(F.size(w) >= 2, brand_key(F.array_join(F.slice(w, 1, 2), " "))), "_one": brand_key(F.get(w, F.lit(0))), "_own": brand_key(F.col("brand"))})
    two, one = known.select(F.col("k").alias("_two"), F.col("std").alias("_s2")), known.select(F.col("k").alias("_one"), F.col("std").alias("_s1"))
    both = opened.join(two, "_two", "left").join(one, "_one", "left").join(mapping.select("brand", "standardized_brand"), "brand", "left")
    found = F.coalesce(F.when(F.col("_two") != F.col("_own"), F.col("_s2")), F.when(F.col("_one") != F.col("_own"), F.col("_s1")))
    bare = F.upper(F.trim(F.col("brand"))).isin(generic)
    return both.withColumn("standardized_brand", F.when(bare, F.coalesce(found, "standardized_brand")).otherwise(F.col("standardized_brand"))).drop("_two", "_one", "_own", "_s1", "_s2")


def all_generic(tokens: Column, generic: list[str]) -> Column:
    return (F.size(tokens) > 0) & F.forall(tokens, lambda w: w.isin(generic))


def brand_dictionary(confirmed: DataFrame, generic: list[str], crosswalk_: DataFrame | None = None, least: int = 3) -> DataFrame:
    """(key, brand, n_words): confirmed brands (brand, brand_method) that are not generic and have support, and crosswalk spellings."""
    counted = confirmed.where(F.upper("brand") != "UNKNOWN").groupBy("brand").agg(F.count("*").alias("n"), F.bool_or(F.col("brand_method") == "barcode").alias("sure"))
    fit = counted.where(~all_generic(words(F.col("brand")), generic) & ((F.col("n") >= least) | F.col("sure")))
    rows = fit.select(tight(F.col("brand")).alias("key"), "brand", F.size(words(F.col("brand"))).alias("n_words"), F.lit(1).alias("prio"))
    if crosswalk_ is not None:
        rows = rows.unionByName(crosswalk_.select(tight(F.col("raw_brand")).alias("key"), F.col("standardized_brand").alias("brand"), F.size(words(F.col("raw_brand"))).alias("n_words"), F.lit(0).alias("prio")))
    one = rows.where(F.char_length("key") >= 2).groupBy("key").agg(F.min(F.struct("prio", "brand", "n_words")).alias("x"))
    return one.select("key", "x.brand", "x.n_words")


def group_consensus(confirmed: DataFrame, group: str, generic: list[str], row_id: str, share: float = 0.6) -> DataFrame:
    from shelfwise.operators.report import weighted_consensus

    rows = confirmed.where((F.upper("brand") != "UNKNOWN") & (F.col(group) != "") & ~all_generic(words(F.col("brand")), generic))
    table = F.create_map(*[F.lit(x) for pair in METHOD_WEIGHTS.items() for x in pair])
    return weighted_consensus(rows, group, "brand", F.coalesce(F.try_element_at(table, F.col("brand_method")), F.lit(1)), row_id, share)


def _grams(rows: DataFrame, row_id: str, tokens: Column, most: int, generic: list[str]) -> DataFrame:
    """(row_id, start, n, gram, key) of the runs of words that are not all generic."""
    found = rows.select(F.col(row_id).alias("row_id"), F.explode(ngrams(tokens, most)).alias("g")).select("row_id", "g.*")
    return found.where(~all_generic(F.split("gram", " "), generic)).withColumn("key", tight(F.col("gram")))


def skipped_words(tokens: Column, most: int = 3) -> Column:
    """How many of the first ``most`` words are such as stand before a brand, up to the first that is none."""
    count = F.lit(0)
    for i in reversed(range(most)):
        count = F.when(F.coalesce(F.get(tokens, F.lit(i)).isin(fixed.LEADING_SKIP_TOKENS), F.lit(False)), count + 1).otherwise(0)
    return count


def claimed(spans: Column) -> Column:
    """Those of the spans (less, start, brand, gram, n) in order that share no word with one taken before."""
    none = F.struct(F.array().cast("array<int>").alias("words"), F.array().cast("array<struct<brand:string,gram:string>>").alias("found"))

    def take(acc: Column, x: Column) -> Column:
        own = F.sequence(x["start"], x["start"] + x["n"] - 1)
        more = F.struct(F.concat(acc["words"], own).alias("words"), F.concat(acc["found"], F.array(F.struct(x["brand"].alias("brand"), x["gram"].alias("gram")))).alias("found"))
        return F.when(F.arrays_overlap(acc["words"], own), acc).otherwise(more)

    return F.aggregate(spans, none, take)["found"]


def resolve_brands(rows: DataFrame, dictionary: DataFrame, consensus: DataFrame, generic: list[str], row_id: str, group: str, text: str, most: int = 4) -> DataFrame:
    """(row_id, brand, method, evidence) by a cascade.

    Group consensus; the whole group text as a known brand, else the longest one in it; the
    longest known brand that opens the text, then that opens it behind up to three skipped
    words; known brands anywhere in the text, the longer first, each where no word is taken
    by one before it: one brand counts, several are ambiguous and UNKNOWN.
    """
    known = dictionary.select("key", "brand")
    base = rows.select(F.col(row_id).alias("row_id"), F.col(group).alias("_group"), words(F.col(group)).alias("_gw"), words(F.col(text)).alias("_tw"))
    longest = lambda order: F.min_by(F.struct("brand", "gram"), F.struct(*order))
    a1 = base.join(consensus.select(F.col(group).alias("_group"), "brand"), "_group").select("row_id", F.struct("brand", F.col("_group").alias("evidence")).alias("x"))
    whole = base.where(~all_generic(F.col("_gw"), generic)).select("row_id", "_group", tight(F.col("_group")).alias("key")).join(known, "key")
    whole = whole.select("row_id", F.struct("brand", F.trim("_group").alias("evidence")).alias("x"))
    inside = _grams(base, "row_id", F.col("_gw"), most, generic).join(known, "key")
    inside = inside.groupBy("row_id").agg(longest([-F.char_length("gram"), -F.col("n"), "start"]).alias("y")).join(base.select("row_id", "_group"), "row_id")
    inside = inside.select("row_id", F.struct("y.brand", F.trim("_group").alias("evidence")).alias("x"))
    hits = _grams(base, "row_id", F.col("_tw"), most, generic).join(known, "key")
    skipped = base.select("row_id", skipped_words(F.col("_tw")).alias("skip"))
    opening = hits.join(skipped, "row_id").where((F.col("start") == 0) | (F.col("start") == F.col("skip")))
    opening = opening.groupBy("row_id").agg(longest(["start", -F.col("n")]).alias("y")).select("row_id", F.struct("y.brand", F.col("y.gram").alias("evidence")).alias("x"))
    clean = hits.where(~F.exists(F.split("gram", " "), lambda w: w.rlike("^[0-9]+[A-Z]{0,4}$")) & (F.char_length("key") >= 3))
    first = clean.groupBy("row_id", "gram", "brand", "n").agg(F.min("start").alias("start"))
    taken = first.groupBy("row_id").agg(claimed(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "start", "brand", "gram", "n")))).alias("found"))
    names = F.array_distinct(F.transform("found", lambda x: x["brand"]))
    best = lambda b: F.array_min(F.transform(F.filter("found", lambda x: x["brand"] == b), lambda x, i: F.struct((-F.char_length(x["gram"])).alias("less"), i.alias("i"), x["gram"].alias("gram"))))["gram"]
    one = F.struct(F.get(names, F.lit(0)).alias("brand"), F.lit("text_scan").alias("method"), best(F.get(names, F.lit(0))).alias("evidence"))
    several = F.array_join(F.transform(names, lambda b: F.concat(b, F.lit("~"), best(b))), "; ")
    many = F.struct(F.lit("UNKNOWN").alias("brand"), F.lit("ambiguous").alias("method"), several.alias("evidence"))
    out, picked = base.select("row_id"), []
    for i, (name, found) in enumerate((("group_consensus", a1), ("group_text", whole), ("group_text", inside), ("text_opening", opening))):
        named = F.struct(F.col("x.brand").alias("brand"), F.lit(name).alias("method"), F.col("x.evidence").alias("evidence"))
        out = out.join(found.select("row_id", named.alias(f"_x{i}")), "row_id", "left")
        picked.append(F.col(f"_x{i}"))
    out = out.join(taken.select("row_id", F.when(F.size(names) == 1, one).otherwise(many).alias("_scan")), "row_id", "left")
    none = F.struct(F.lit("UNKNOWN").alias("brand"), F.lit("unresolved").alias("method"), F.lit("").alias("evidence"))
    return out.select("row_id", F.coalesce(*picked, F.col("_scan"), none).alias("x")).select("row_id", "x.*")


def close_texts(asked: DataFrame, known: DataFrame, least: float) -> DataFrame:
    """(asked, known): every pair of texts (columns of these names) whose ratio can reach ``least``, by an equi-join.

    A ratio of at least ``least`` allows d = (1 - least / 100) * (sum of lengths) letters put
    in or left out.  If a known text is cut into d + 1 parts, one of them stands unchanged in
    the other text, moved by d places at most.  So no pair is lost.
    """
    slack = 1 - least / 100
    most = lambda n: F.floor(n * (2 * slack / (1 - slack)) + 1e-9).cast("int")  # noqa: E731  for the longest partner of a text of n letters
    n, i = F.char_length("known"), F.col("i")
    parts = known.select("known", n.alias("size"), F.explode(F.sequence(F.lit(0), most(n))).alias("i"))
    edge = lambda k: F.floor(k * F.col("size") / (most(F.col("size")) + 1)).cast("int")
    parts = parts.select("known", "size", "i", F.substring(F.col("known"), edge(i) + 1, edge(i + 1) - edge(i)).alias("part"))
    m = F.char_length("asked")
    low, high = F.ceil(m * (1 - slack) / (1 + slack) - 1e-9).cast("int"), F.floor(m * (1 + slack) / (1 - slack) + 1e-9).cast("int")
    probes = asked.select("asked", F.explode(F.sequence(F.greatest(low, F.lit(1)), high)).alias("size"))
    probes = probes.select("asked", "size", F.explode(F.sequence(F.lit(0), most(F.col("size")))).alias("i"))
    probes = probes.select("asked", "size", "i", F.explode(F.sequence(-most(F.col("size")), most(F.col("size")))).alias("move"))
    at, long = edge(i) + F.col("move"), edge(i + 1) - edge(i)
    probes = probes.where((at >= 0) & (at + long <= m)).select("asked", "size", "i", F.substring(F.col("asked"), at + 1, long).alias("part")).distinct()
    return probes.join(parts, ["size", "i", "part"]).select("asked", "known").distinct()


def guess_by_rule(rows: DataFrame, brands: DataFrame, row_id: str, name: str, least: float = 90.0, min_length: int = 5) -> DataFrame:
    """(row_id, brand, how, score): the known brand that the first three, two or one words of the name are; else the closest
    by token-sort ratio to its first two words (or the only one), from ``least`` on, ties to the first in order."""
    known = brands.select(F.upper(F.trim("brand")).alias("brand")).where("brand <> ''").distinct()
    w = F.regexp_extract_all(F.upper(F.coalesce(F.col(name), F.lit(""))), F.lit("([A-Z0-9']+)"), 1)
    start = lambda k: F.array_join(F.slice(w, 1, k), " ")
    opened = rows.select(F.col(row_id).alias("row_id"), F.explode(F.array(*[F.struct(F.lit(k).alias("n"), F.when(F.size(w) >= k, start(k)).alias("brand")) for k in (3, 2, 1)])).alias("x"))
    exact = opened.select("row_id", "x.*").join(known, "brand")
    exact = exact.groupBy("row_id").agg(F.max_by("brand", "n").alias("brand")).withColumns({"how": F.lit("exact"), "score": F.lit(100.0)})
    rest = rows.select(F.col(row_id).alias("row_id"), start(2).alias("cand")).join(exact, "row_id", "left_anti").where(F.char_length("cand") >= min_length)
    in_order = lambda c: F.array_join(F.array_sort(F.filter(F.split(c, r"\s+"), lambda x: x != "")), " ")
    asked = rest.select("cand", in_order("cand").alias("asked")).distinct()
    pool = known.where(F.char_length("brand") >= min_length).select("brand", in_order("brand").alias("known"))
    pairs = close_texts(asked.select("asked").distinct(), pool.select("known").distinct(), least)
    scored = pairs.withColumn("score", score("ratio", F.col("asked"), F.col("known"))).where(F.col("score") >= least)
    best = scored.join(pool, "known").groupBy("asked").agg(F.min_by(F.struct("brand", "score"), F.struct(-F.col("score"), "brand")).alias("x"))
    fuzzy = rest.join(asked, "cand").join(best, "asked").select("row_id", "x.brand", F.lit("fuzzy").alias("how"), "x.score")
    return exact.select("row_id", "brand", "how", "score").unionByName(fuzzy)
