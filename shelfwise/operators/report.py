"""Counts, shares, histograms, coverage and totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def value_shares(df: DataFrame, key: str) -> DataFrame:
    """(key, n, pct): counts with the percentage of all rows; null is a value."""
    counted = count_by(df, key)
    total = counted.agg(F.sum("n").alias("total"))
    return counted.join(F.broadcast(total)).select(key, "n", F.bround(100.0 * F.col("n") / F.col("total"), 2).alias("pct"))


def sets_by(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("values"))


def any_by(df: DataFrame, key: str, condition: Column, name: str = "any") -> DataFrame:
    return df.groupBy(key).agg(F.bool_or(condition).alias(name))


def first_distinct(df: DataFrame, key: str, value: str, row_id: str, n: int = 3, sep: str = " | ") -> DataFrame:
    """(key, examples): the first n distinct values in row order, joined.  Values are reduced before they are gathered."""
    firsts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.min(row_id).alias("at"))
    order = Window.partitionBy(key).orderBy("at")
    some = firsts.withColumn("r", F.row_number().over(order)).where(F.col("r") <= n)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", value))), lambda s: s[value]), sep)
    return some.groupBy(key).agg(joined.alias("examples"))


def weighted_consensus(df: DataFrame, group: str, value: str, weight: Column, row_id: str, share: float = 0.6) -> DataFrame:
    """(group, value, n, share): the value with the largest weighted vote, first seen on ties, where its share is large enough."""
    votes = df.groupBy(group, value).agg(F.sum(weight).alias("vote"), F.count("*").alias("n"), F.min(row_id).alias("first"))
    total = F.sum("vote").over(Window.partitionBy(group))
    order = Window.partitionBy(group).orderBy(F.col("vote").desc(), "first")
    best = votes.withColumns({"share": F.col("vote") / total, "_r": F.row_number().over(order)}).where("_r = 1")
    return best.where(F.col("share") >= share).select(group, value, "n", "share")


def mode_and_mean(df: DataFrame, group: str, value: str, number: str, row_id: str) -> DataFrame:
    """(group, value, n, mean): the most frequent value (first seen on ties) and the mean of its numbers."""
    per = df.groupBy(group, value).agg(F.count("*").alias("n"), F.avg(number).alias("mean"), F.min(row_id).alias("first"))
    order = Window.partitionBy(group).orderBy(F.col("n").desc(), "first")
    return per.withColumn("_r", F.row_number().over(order)).where("_r = 1").select(group, value, "n", "mean")


def summary(df: DataFrame, label: str, measures: dict[str, Column], ratios: dict[str, tuple[str, str]] | None = None, total: str = "TOTAL") -> DataFrame:
    """One row per label and a grand total; ratios (percent) are worked out from the sums of their row."""
    rolled = df.rollup(label).agg(F.grouping(label).alias("_all"), *[m.alias(n) for n, m in measures.items()])
    named = rolled.withColumn(label, F.when(F.col("_all") == 1, F.lit(total)).otherwise(F.col(label)))
    for name, (a, b) in (ratios or {}).items():
        named = named.withColumn(name, F.when(F.col(b) != 0, F.bround(100.0 * F.col(a) / F.col(b), 2)))
    return named.drop("_all")


def score_bands(df: DataFrame, score: str, threshold: int) -> DataFrame:
    """(band, n): five bands from the threshold to 100; empty bands are shown."""
    lo = threshold
    bands = [(f"{lo}-{lo + 4}", lo, lo + 5), (f"{lo + 5}-{lo + 9}", lo + 5, lo + 10)]
    bands += [(f"{a}-{a + 4}", a, a + 5) for a in range(lo + 10, 100, 5)] + [("100", 100, 101)]
    name = reduce(lambda c, b: c.when((F.col(score) >= b[1]) & (F.col(score) < b[2]), b[0]), bands[1:], F.when((F.col(score) >= bands[0][1]) & (F.col(score) < bands[0][2]), bands[0][0]))
    counted = df.select(name.alias("band")).where("band is not null").groupBy("band").agg(F.count("*").alias("n"))
    listed = df.sparkSession.createDataFrame([(b[0],) for b in bands], "band string")
    return listed.join(counted, "band", "left").select("band", F.coalesce("n", F.lit(0)).alias("n"))


def coverage(matches: DataFrame, catalogue: DataFrame, label: str, item: str = "src_id") -> DataFrame:
    """(label, covered, pct): distinct catalogue rows matched per label and over all."""
    n = catalogue.select(F.countDistinct(item).alias("n_items"))
    covered = matches.rollup(label).agg(F.grouping(label).alias("_all"), F.countDistinct(item).alias("covered"))
    named = covered.withColumn(label, F.when(F.col("_all") == 1, F.lit("TOTAL")).otherwise(F.col(label)))
    return named.join(F.broadcast(n)).select(label, "covered", F.bround(100.0 * F.col("covered") / F.col("n_items"), 2).alias("pct"))


def upper_median(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, median): element n // 2 (from 0) of the sorted values, an actual value and not a mean of two."""
    spec = Window.partitionBy(key)
    ranked = df.withColumns({"_r": F.row_number().over(spec.orderBy(value)), "_n": F.count("*").over(spec)})
    return ranked.where(F.expr("_r = _n div 2 + 1")).select(key, F.col(value).alias("median"))


def distinct_customers(df: DataFrame, name: str, customer: str, barcode: str, row_id: str) -> DataFrame:
    """(name_key, customers, n_customers, barcode): distinct customers per lower-cased name and its first barcode."""
    keyed = df.withColumn("name_key", F.lower(F.trim(F.col(name)))).where("name_key <> ''")
    first = F.min_by(F.col(barcode), F.when(F.col(barcode).isNotNull(), F.col(row_id)))
    return keyed.groupBy("name_key").agg(F.array_sort(F.collect_set(customer)).alias("customers"), F.countDistinct(customer).alias("n_customers"), first.alias("barcode"))


def mover_class(n_customers: Column, matched: Column) -> Column:
    """Fast, moderate or slow mover by the number of customers; lost opportunity where nothing matched."""
    return (
        F.when(~matched, "LOST OPPORTUNITY").when(n_customers >= 3, "FAST MOVER").when(n_customers == 2, "MODERATE MOVER").otherwise("SLOW MOVER")
    )


def frequent_openings(df: DataFrame, text: str, known: DataFrame, skip: list[str], least: int = 5) -> DataFrame:
    """(brand, n): first words and first two words that open at least ``least`` texts, are not generic and not known (column ``brand``)."""
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != "")
    opened = df.select(words.alias("w")).where(F.size("w") > 0)
    one = F.when(~F.get("w", F.lit(0)).isin(skip) & (F.char_length(F.get("w", F.lit(0))) >= 2), F.get("w", F.lit(0)))
    two = F.when((F.size("w") >= 2) & ~F.get("w", F.lit(0)).isin(skip) & ~F.get("w", F.lit(1)).isin(skip), F.concat_ws(" ", F.get("w", F.lit(0)), F.get("w", F.lit(1))))
    counted = opened.select(F.explode(F.array_compact(F.array(one, two))).alias("brand")).groupBy("brand").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least).join(known.select("brand"), "brand", "left_anti")


def cost_totals(calls: DataFrame, embed_price: float, in_price: float, out_price: float, budget: float) -> DataFrame:
    """Token and cost totals of logged calls (embed_tokens, in_tokens, out_tokens), and whether they are over budget."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("embed_tokens", "in_tokens", "out_tokens")]
    cost = (F.col("embed_tokens") * embed_price + F.col("in_tokens") * in_price + F.col("out_tokens") * out_price) / 1000
    return calls.agg(*sums).withColumn("cost", F.round(cost, 6)).withColumn("over_budget", F.col("cost") > budget)
