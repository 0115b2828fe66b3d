"""TF-IDF over character n-grams, as joins and sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import Scratch


def word_grams(text: Column, low: int = 3, high: int = 5) -> Column:
    """Character n-grams inside words padded by a space on both sides; a padded word shorter than n counts once, whole."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def cut(w: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.char_length(w) - n + 1))
        return F.transform(starts, lambda i: F.substring(w, i, F.lit(n)))

    def every(w: Column) -> Column:
        sized = [F.when((F.char_length(w) >= n) | F.lit(n == low), cut(w, n)).otherwise(F.array().cast("array<string>")) for n in range(low, high + 1)]
        return F.concat(*sized)

    return F.flatten(F.transform(padded, every))


def counts(df: DataFrame, id_col: str, text: str, low: int = 3, high: int = 5) -> DataFrame:
    """(id, gram, tf) with sublinear tf = 1 + ln(count)."""
    grams = df.select(F.col(id_col).alias("id"), F.explode(word_grams(F.col(text), low, high)).alias("gram"))
    return grams.groupBy("id", "gram").agg((1 + F.log(F.count("*"))).alias("tf"))


def weights(tf: DataFrame, idf: DataFrame) -> DataFrame:
    """(id, gram, w, idf): tf * idf with unit length per id; grams without an idf are dropped."""
    raw = tf.join(idf, "gram").withColumn("x", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("id")))
    return raw.select("id", "gram", (F.col("x") / norm).alias("w"), "idf")


def inverse_frequency(tf: DataFrame, n: Column) -> DataFrame:
    """(gram, idf) with smooth idf = ln((1 + n) / (1 + df)) + 1."""
    return tf.groupBy("gram").agg(F.count("*").alias("df")).select("gram", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf"))


#: Items that the first look at a query's rarest grams may meet, for each of the k that are asked for; beyond LARGE_K there is no first look.
PROBE, LARGE_K = 8, 100
#: Rounding of similarities to six places.
SLACK = 1e-6


def dots(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """(query_id, item_id, similarity) of pairs, over all their grams."""
    met = pairs.join(a.select("query_id", "gram", "qw"), "query_id").join(b, ["item_id", "gram"])
    return met.groupBy("query_id", "item_id").agg(F.round(F.sum(F.col("qw") * F.col("iw")), 6).alias("similarity"))


def with_lists(a: DataFrame, b: DataFrame) -> DataFrame:
    """``a`` (query_id, gram, qw) with ``met``, the items on a gram's list and on all shorter ones of the query, and ``rest``.

    ``rest`` is the most that this gram and the query's longer lists can add to a similarity: no more than the length of that
    part of the query, and no more than its weights times the largest item weights of the lists.
    """
    lists = b.groupBy("gram").agg(F.count("*").alias("df"), F.max("iw").alias("most"))
    order = Window.partitionBy("query_id").orderBy("df", "gram")
    before, after = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    length, sums = F.sqrt(F.sum(F.col("qw") * F.col("qw")).over(after)), F.sum(F.col("qw") * F.col("most")).over(after)
    return a.join(lists, "gram").select("query_id", "gram", "qw", F.sum("df").over(before).alias("met"), F.least(length, sums).alias("rest"), F.row_number().over(order).alias("place"))


def essential(a: DataFrame, least: DataFrame | float) -> DataFrame:
    """(query_id, gram): the lists of ``with_lists`` that an item must be on to reach ``least`` (a number, or query_id and least)."""
    if isinstance(least, float):
        return a.where(F.col("rest") >= least - SLACK).select("query_id", "gram")
    return a.join(least, "query_id", "left").where(F.col("rest") >= F.coalesce("least", F.lit(0.0)) - SLACK).select("query_id", "gram")


def first_scores(a: DataFrame, b: DataFrame, k: int) -> DataFrame:
    """(query_id, least): the k-th largest similarity among the items on a query's shortest lists, where k or more are on them."""
    short = a.where((F.col("met") <= PROBE * k) | (F.col("place") == 1)).select("query_id", "gram")
    found = dots(short.join(b.select("item_id", "gram"), "gram").select("query_id", "item_id").distinct(), a, b)
    order = Window.partitionBy("query_id").orderBy(F.col("similarity").desc())
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") == k).select("query_id", F.col("similarity").alias("least"))


def top_matches(queries: DataFrame, items: DataFrame, query_id: str, item_id: str, query_text: str, item_text: str, k: int = 10, least: float = 0.0, low: int = 3, high: int = 5) -> DataFrame:
    """(query_id, item_id, similarity, rank): the k items with the largest TF-IDF cosine; idf comes from the items.

    Max-score: the items on a query's shortest lists give a k-th score that the result cannot be under; with it, or with
    ``least`` if that is larger, lists whose rest cannot reach it are left out, so common grams make no pairs.  What is on
    an essential list is then added up over all its grams.
    """
    scratch = Scratch(queries.sparkSession, "tfidf")
    item_tf = counts(items, item_id, item_text, low, high)
    n = F.lit(items.select(item_id).distinct().count())
    idf = inverse_frequency(item_tf, n)
    b = scratch.table(weights(item_tf, idf).select(F.col("id").alias("item_id"), "gram", F.col("w").alias("iw")), "items")
    a = weights(counts(queries, query_id, query_text, low, high), idf).select(F.col("id").alias("query_id"), "gram", F.col("w").alias("qw"))
    a = scratch.table(with_lists(a, b), "queries")
    bound: DataFrame | float = float(least)
    if k <= LARGE_K:
        bound = scratch.table(first_scores(a, b, k).withColumn("least", F.greatest("least", F.lit(float(least)))), "first")
        if least > 0:
            bound = a.select("query_id").distinct().join(bound, "query_id", "left").select("query_id", F.coalesce("least", F.lit(float(least))).alias("least"))
    found = dots(essential(a, bound).join(b.select("item_id", "gram"), "gram").select("query_id", "item_id").distinct(), a, b)
    order = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), "item_id")
    return found.where(F.col("similarity") >= least).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
