"""Row identity, deduplication, ordered limits and set operations."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.text import normalize


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Consecutive ids in the order of one read.

    Ids follow from the sizes of the partitions before; only those counts reach the driver.
    """
    marked = df.withColumns({"_p": F.spark_partition_id(), "_m": F.monotonically_increasing_id()})
    starts, total = {}, 0
    for p, n in sorted((r._p, r.n) for r in marked.groupBy("_p").agg(F.count("*").alias("n")).collect()):
        starts[p], total = total, total + n
    if not starts:
        return df.withColumn(name, F.lit(0).cast("long"))
    table = F.create_map(*[F.lit(x).cast("long") for pair in starts.items() for x in pair])
    within = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    return marked.withColumn(name, within + F.element_at(table, F.col("_p").cast("long"))).drop("_p", "_m")


def _one(df: DataFrame, keys: list[str], pick: Callable[[Column, Column], Column], order: list[Column]) -> DataFrame:
    """One whole row per key; tasks reduce their rows first, so a key that many rows share makes no large task.  Null keys are one key."""
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(*keys).agg(pick(whole, F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)])).alias("_row")).select("_row.*")


def keep_first(df: DataFrame, keys: list[str], row_id: str = "row_id") -> DataFrame:
    """One row per key, the one with the smallest row id."""
    return _one(df, keys, F.min_by, [F.col(row_id)])


def keep_last(df: DataFrame, keys: list[str], row_id: str = "row_id") -> DataFrame:
    return _one(df, keys, F.max_by, [F.col(row_id)])


def keep_by_priority(df: DataFrame, keys: list[str], priority: Column, row_id: str = "row_id") -> DataFrame:
    """One row per key, the one with the smallest priority, then row id."""
    return _one(df, keys, F.min_by, [priority, F.col(row_id)])


def fingerprint(columns: list[str]) -> Column:
    """Normalised text of all columns, as one hash."""
    return F.sha2(F.concat_ws("\x1f", *[normalize(F.col(c)) for c in columns]), 256)


def dedup_with_log(df: DataFrame, columns: list[str], row_id: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """Rows without exact duplicates and then without normalised duplicates, and the removed rows with a ``reason``."""
    exact = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]), 256)
    marked = df.withColumns({"_exact": exact, "_print": fingerprint(columns)})
    first = lambda key: F.min(row_id).over(Window.partitionBy(key))
    marked = marked.withColumns({"_e": first("_exact"), "_p": first("_print")})
    reason = F.when(F.col(row_id) != F.col("_e"), "exact duplicate").when(F.col(row_id) != F.col("_p"), "normalised duplicate")
    marked = marked.withColumn("reason", reason).drop("_exact", "_print", "_e", "_p")
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def duplicate_count(df: DataFrame, keys: list[str], name: str = "dup_count") -> DataFrame:
    return df.withColumn(name, F.count("*").over(Window.partitionBy(*keys)))


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The k first rows of each key; ties must be settled by ``order``."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def runner_up_margin(df: DataFrame, keys: list[str], score: str, tie: str) -> DataFrame:
    """Best row of each key with ``margin`` to the next best (to 0 if there is none)."""
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(tie).asc())
    ranked = df.withColumns({"_rank": F.row_number().over(order), "_next": F.lead(score).over(order)})
    best = ranked.where("_rank = 1")
    return best.withColumn("margin", F.col(score) - F.coalesce("_next", F.lit(0.0))).drop("_rank", "_next")


def first_n(df: DataFrame, n: int, row_id: str = "row_id") -> DataFrame:
    return df.orderBy(row_id).limit(n)


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A repeatable sample of n rows: those with the smallest seeded hash (MD5) of the key."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key))), key).limit(n)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union with the superset of columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def common_pairs(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.select(*keys).intersect(b.select(*keys))


def without(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.join(b.select(*keys).distinct(), keys, "left_anti")


def restore_cache(current: DataFrame, earlier: DataFrame, keys: list[str]) -> DataFrame:
    """Union of two caches; the current row wins."""
    return current.unionByName(earlier.join(current.select(*keys), keys, "left_anti"))
