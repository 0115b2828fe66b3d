"""Embedding, exact nearest neighbours by blocks, and the votes over them."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.adjudicate import with_backoff
from shelfwise.operators.rows import runner_up_margin
from shelfwise.session import Scratch, ship

BLOCK, TILE = 1024, 4096
#: Bytes of query vectors that are broadcast at once.
ROUND_BYTES = 64 << 20


class Embedder(Protocol):
    """Anything that turns texts into vectors; it is built anew on each worker from its own state."""

    name: str

    def embed(self, texts: list[str]) -> np.ndarray: ...


class HashedGrams:
    """Deterministic stand-in for a model: hashed character trigrams, unit length."""

    def __init__(self, dims: int = 256):
        self.dims, self.name = dims, f"hashed-grams-{dims}"

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dims))
        for row, text in zip(out, texts):
            padded = f"  {text.lower()}  "
            for i in range(len(padded) - 2):
                h = zlib.crc32(padded[i : i + 3].encode())
                row[h % self.dims] += 1.0 if h >> 31 else -1.0
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(norm == 0, 1, norm)).astype(np.float32)


class RetryingEmbedder:
    """A remote embedder behind retries, in batches; ``call`` takes a list of texts and gives as many lists of numbers.

    Vectors are brought to unit length.  ``call`` is any function that can be sent to the workers, such as an HTTP request.
    """

    def __init__(self, name: str, call: Callable[[list[str]], list[list[float]]], batch: int = 64, attempts: int = 5, base: float = 1.0):
        self.name, self.call, self.batch, self.attempts, self.base = name, call, batch, attempts, base

    def embed(self, texts: list[str]) -> np.ndarray:
        made: list[list[float]] = []
        for at in range(0, len(texts), self.batch):
            part = texts[at : at + self.batch]

            def once(part: list[str] = part) -> list[list[float]]:
                got = self.call(part)
                if len(got) != len(part):
                    raise ValueError(f"{len(got)} vectors for {len(part)} texts")
                return got

            made += with_backoff(once, self.attempts, self.base)
        return _unit(made).astype(np.float32) if made else np.zeros((0, 0), np.float32)


def sound(cache: DataFrame, dims: int | None = None) -> DataFrame:
    """Cache rows that can be used: a key, one row each, and a vector of finite numbers (of ``dims`` components)."""
    fine = F.col("key").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = cache.where(F.coalesce(fine & (F.size("embedding") == dims if dims else F.lit(True)), F.lit(False)))
    return good.groupBy("key").agg(F.min("embedding").alias("embedding"))


def embed(df: DataFrame, text: str, embedder: Embedder, out: str = "embedding") -> DataFrame:
    """Adds unit vectors of a text column; each distinct text is embedded once."""
    ship(df.sparkSession)

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(list(embedder.embed(texts.fillna("").tolist())), index=texts.index)

    distinct = df.select(F.coalesce(F.col(text), F.lit("")).alias("_text")).distinct()
    made = distinct.withColumn(out, run("_text"))
    return df.withColumn("_text", F.coalesce(F.col(text), F.lit(""))).join(made, "_text").drop("_text")


def embed_cached(df: DataFrame, text: str, embedder: Embedder, cache: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(embedded rows, cache rows to keep): only texts that the cache lacks are embedded.  Cache: key, embedding.

    Damaged rows of the cache (``sound``) count as lacking and are made again.
    """
    cache = cache if cache is None else sound(cache)
    key = F.sha2(F.concat_ws("\0", F.lit(embedder.name), F.coalesce(F.col(text), F.lit(""))), 256)
    keyed = df.withColumn("_key", key)
    wanted = keyed.select(F.col("_key").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("_text")).distinct()
    missing = wanted if cache is None else wanted.join(cache, "key", "left_anti")
    made = embed(missing, "_text", embedder).select("key", "embedding")
    full = made if cache is None else cache.select("key", "embedding").unionByName(made)
    return keyed.join(full.withColumnRenamed("key", "_key"), "_key").drop("_key"), full


def _unit(rows: list) -> np.ndarray:
    x = np.asarray(rows, np.float64)
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm == 0, 1, norm)


def _matrices(batch: pa.RecordBatch, as_is: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors (a row each, unit length unless ``as_is``) of the rows of a batch, one dimension after another.

    Rows with a null or non-finite component are left out.
    """
    lists = batch.column("v")
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(lengths)
    odd = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    good = (lengths > 0) & (odd[ends] == odd[ends - lengths])
    ids = batch.column("id").to_numpy()
    for d in np.unique(lengths[good]).tolist():
        at = np.flatnonzero(good & (lengths == d))
        x = flat[(ends - lengths)[at][:, None] + np.arange(d)]
        yield ids[at], x if as_is else _unit(x)


class _Best:
    """The k most similar items of each query of a block."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, x, k
        self.row, self.sim, self.item = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        self.worst = np.full(len(ids), -np.inf)

    def meet(self, ids: np.ndarray, x: np.ndarray) -> None:
        s, k = np.round(self.x @ x.T, 9), self.k
        limit = self.worst if s.shape[1] < k else np.maximum(self.worst, np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k])
        rows, columns = np.nonzero(s >= limit[:, None])
        row, sim, item = np.append(self.row, rows), np.append(self.sim, s[rows, columns]), np.append(self.item, ids[columns])
        order = np.lexsort((item, -sim, row))
        row, sim, item = row[order], sim[order], item[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        kept = rank < k
        self.row, self.sim, self.item = row[kept], sim[kept], item[kept]
        full = rank == k - 1
        self.worst[row[full]] = sim[full]

    def found(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.ids[self.row]), pa.array(self.item), pa.array(self.sim)], ["query_id", "item_id", "similarity"])


def knn(queries: DataFrame, items: DataFrame, k: int, query_id: str = "query_id", item_id: str = "item_id", metric: str = "cosine") -> DataFrame:
    """(query_id, item_id, similarity, rank): the k items with the largest cosine or inner product, ties to the smaller id.

    Exact.  Items stay where they are read: each task compares its own with a round of
    queries, at most ROUND_BYTES of vectors, which are broadcast, and sends k per query.
    More queries take more rounds, each a pass over the items.
    """
    spark = queries.sparkSession
    ship(spark)
    as_is = metric == "dot"
    usable = lambda df, i: df.select(F.col(i).cast("long").alias("id"), F.col("embedding").alias("v")).where("id is not null and size(v) > 0")
    asked, offered, scratch = usable(queries, query_id), usable(items, item_id), Scratch(spark, "knn")
    size = asked.agg(F.sum(F.size("v") * 8)).first()[0] or 0
    n = max(1, -(-size // ROUND_BYTES))
    asked = asked if n == 1 else scratch.table(asked.withColumn("round", F.pmod(F.xxhash64("id"), F.lit(n))), "asked")

    def compare(r: int) -> DataFrame:
        table = (asked if n == 1 else asked.where(F.col("round") == r).select("id", "v")).toArrow()
        held = spark.sparkContext.broadcast([(ids[a : a + BLOCK], x[a : a + BLOCK]) for batch in table.combine_chunks().to_batches() for ids, x in _matrices(batch, as_is) for a in range(0, len(ids), BLOCK)])

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = [_Best(ids, x, k) for ids, x in held.value]
            for batch in batches:
                for ids, x in _matrices(batch, as_is):
                    for at in range(0, len(ids), TILE):
                        for block in blocks:
                            if block.x.shape[1] == x.shape[1]:
                                block.meet(ids[at : at + TILE], x[at : at + TILE])
            for block in blocks:
                yield block.found()

        return offered.mapInArrow(meet, "query_id long, item_id long, similarity double")

    found = compare(0)
    if n > 1:
        for r in range(n):
            compare(r).write.mode("overwrite").parquet(scratch.path(f"found/{r:06d}"))
        found = spark.read.schema(found.schema).parquet(scratch.path("found/*"))
    order = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), "item_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def label_votes(neighbours: DataFrame, label: str = "label") -> DataFrame:
    """Per query: the label with the largest sum of similarities, its share, the margin to the next (as a share), top similarity."""
    votes = neighbours.groupBy("query_id", label).agg(F.sum("similarity").alias("vote"), F.max("similarity").alias("best"))
    total = votes.withColumns({"total": F.sum("vote").over(Window.partitionBy("query_id")), "top1": F.max("best").over(Window.partitionBy("query_id"))})
    won = runner_up_margin(total, ["query_id"], "vote", label)
    share = lambda c: F.when(F.col("total") != 0, F.col(c) / F.col("total")).otherwise(0.0)
    return won.select("query_id", label, share("vote").alias("share"), share("margin").alias("margin"), "top1")


def accept_vote(votes: DataFrame, hard_min: float = 0.62, agreement: float = 0.55, margin: float = 0.15, override: float = 0.85) -> DataFrame:
    """``accepted``: the vote passes all three gates, or the best neighbour alone is close enough."""
    gates = (F.col("top1") >= hard_min) & (F.col("share") >= agreement) & (F.col("margin") >= margin)
    return votes.withColumn("accepted", gates | (F.col("top1") >= override))


def accept_margin(neighbours: DataFrame, threshold: float = 0.60, margin: float = 0.08) -> DataFrame:
    """Best neighbour per query, ``accepted`` if it is close and clearly closer than the second."""
    best = runner_up_margin(neighbours, ["query_id"], "similarity", "item_id")
    return best.withColumn("accepted", (F.col("similarity") >= threshold) & (F.col("margin") >= margin))


def majority(neighbours: DataFrame, label: str, least: int = 4, mean_min: float = 0.55, examples: int = 4) -> DataFrame:
    """Most frequent label per query (first met on ties), its count and mean similarity, ``accepted``, and up to ``examples`` candidate labels."""
    per = neighbours.groupBy("query_id", label).agg(F.count("*").alias("n"), F.avg("similarity").alias("mean_similarity"), F.min("rank").alias("first"))
    order = Window.partitionBy("query_id").orderBy(F.col("n").desc(), "first")
    labels = F.slice(F.transform(F.array_sort(F.collect_list(F.struct("first", label)).over(Window.partitionBy("query_id"))), lambda s: s[label]), 1, examples)
    best = per.withColumns({"_r": F.row_number().over(order), "candidates": labels}).where("_r = 1").drop("_r", "first")
    return best.withColumn("accepted", (F.col("n") >= least) & (F.col("mean_similarity") >= mean_min))


def borrow_labels(neighbours: DataFrame, donors: DataFrame, label: str, least: float = 0.80) -> DataFrame:
    """(query_id, label): label of the nearest donor if it is close enough.  Donors: item_id, label."""
    return neighbours.where((F.col("rank") == 1) & (F.col("similarity") >= least)).join(donors.select("item_id", label), "item_id").select("query_id", label)


def percent(similarity: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), (similarity + 1) / 2 * 100))
