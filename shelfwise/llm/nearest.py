"""Nearest neighbours by a block matrix join of int8 tiles with error bounds.

Queries are packed into blocks, files in the shared folder.  Candidates never move: each
task cuts the rows that it reads into tiles and takes the blocks of its round to them.  A
vector is stored as int8 numbers times a scale, with the Euclidean length of what that
leaves out.  For a block and a tile one integer product gives all approximate distances;
the left-out lengths bound the true distance from both sides (triangle inequality), with
room for rounding in proportion to the norms.  Candidates whose lower bound is over the
k-th smallest upper bound cannot be among the k nearest; the others are computed again on
the original vectors in double precision and kept in heaps of k per query.  A task sends
its heaps, and the heaps of all tasks are merged by heaps.  The result is exact.

A round holds ``ROUND_BYTES`` of blocks; more queries take more rounds, each a pass over
the candidates, so neither memory nor the plan grows with them.

Cases: null vectors, null ids, zero vectors and vectors with null or non-finite
components take no part; candidates of another dimension than the query's neither; rows
that share the query's id are never its neighbours; rows that share a query's id are
queries of their own, each with its ranks from 1; repeated rows otherwise count each;
ties go to the smaller id; with fewer than k candidates all are returned; empty tables
give empty results; further columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.files import mapped, save_arrays
from shelfwise.session import Scratch, ship

K = 10
BLOCK, TILE = 1024, 2048
#: Room for rounding, as a part of the norms; double precision needs far less.
ROUNDING = 1e-12
#: Bytes of query vectors that a task holds at once.
ROUND_BYTES = 64 << 20


def usable(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors (double, a row each) of the rows that take part, one dimension after another."""
    lists, ids = batch.column("embedding"), batch.column("vec_id")
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten()
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)  # null components become NaN
    ends = np.cumsum(lengths)
    sums = lambda marks: np.concatenate(([0], np.cumsum(marks)))
    odd, some = sums(~np.isfinite(flat)), sums(flat != 0)
    begins = ends - lengths
    good = np.asarray(ids.is_valid()) & (odd[ends] == odd[begins]) & (some[ends] > some[begins])
    numbers = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    for d in np.unique(lengths[good]).tolist():
        at = np.flatnonzero(good & (lengths == d))
        yield numbers[at], flat[begins[at][:, None] + np.arange(d)]


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 numbers, scale and left-out length of each row."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = 1
    q = np.rint(x / scale[:, None]).astype(np.int8)
    with np.errstate(over="ignore"):
        return q, scale, np.sqrt(((x - q * scale[:, None]) ** 2).sum(axis=1))


def bounds(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances, from two sides' quantise()."""
    (qa, sa, ea), (qb, sb, eb) = a, b
    wide = np.float32 if qa.shape[1] <= 1024 else np.float64  # products of int8 are whole in float32 up to 2^24
    fa, fb = qa.astype(wide), qb.astype(wide)
    square = lambda f, s: (f.astype(np.float64) ** 2).sum(axis=1) * s**2
    with np.errstate(over="ignore", invalid="ignore"):
        na, nb = square(fa, sa), square(fb, sb)
        both = na[:, None] + nb[None, :]
        d2 = both - 2 * (fa @ fb.T).astype(np.float64) * sa[:, None] * sb[None, :]
        slack = both * ROUNDING
        left_out = (ea + ROUNDING * np.sqrt(na))[:, None] + (eb + ROUNDING * np.sqrt(nb))[None, :]
        low = np.sqrt(np.maximum(d2 - slack, 0)) * (1 - ROUNDING) - left_out
        high = np.sqrt(np.maximum(d2 + slack, 0)) * (1 + ROUNDING) + left_out
    return np.nan_to_num(low, nan=-np.inf), np.nan_to_num(high, nan=np.inf, posinf=np.inf)


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distance row by row, summed in the order of the components."""
    total = np.zeros(len(x))
    with np.errstate(over="ignore"):
        for j in range(x.shape[1]):
            total += (x[:, j] - y[:, j]) ** 2
    return np.sqrt(total)


class Heaps:
    """The k best (distance, id) of each query of a block, in heaps whose top is the worst kept."""

    def __init__(self, asked: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.asked, self.ids, self.vectors, self.k, self.packed = asked, ids, vectors, k, quantise(vectors)
        self.best: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.worst = np.full(len(ids), np.inf)

    def meet(self, ids: np.ndarray, vectors: np.ndarray, packed: tuple) -> None:
        low, high = bounds(self.packed, packed)
        k = self.k
        own = self.ids[:, None] == ids[None, :]
        high[own] = np.inf
        limit = np.partition(high, k - 1, axis=1)[:, k - 1] if high.shape[1] >= k else np.full(len(self.ids), np.inf)
        rows, columns = np.nonzero((low <= np.minimum(limit, self.worst * (1 + ROUNDING))[:, None]) & ~own)
        distance = exact(self.vectors[rows], vectors[columns])
        for q, d, i in zip(rows.tolist(), distance.tolist(), ids[columns].tolist()):
            offer(self.best[q], d, i, k)
        for q in np.unique(rows).tolist():
            if len(self.best[q]) == k:
                self.worst[q] = -self.best[q][0][0]

    def rows(self) -> pa.RecordBatch:
        n = [len(h) for h in self.best]
        flat = [p for h in self.best for p in h]
        columns = [np.repeat(self.asked, n), np.repeat(self.ids, n), np.asarray([-p[1] for p in flat], np.int64), np.asarray([-p[0] for p in flat], np.float64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["asked", "query_id", "vec_id", "score"])


def offer(heap: list[tuple[float, int]], distance: float, i: int, k: int) -> None:
    """Keep (distance, id) if it is among the k smallest that were offered."""
    entry = (-distance, -i)
    if len(heap) < k:
        heapq.heappush(heap, entry)
    elif entry > heap[0]:
        heapq.heapreplace(heap, entry)


def write_blocks(queries: DataFrame, folder: str, size: int) -> list[tuple[str, int]]:
    """Write the queries to files of at most ``size`` vectors; (file, bytes of vectors) of each block."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, held, n = TaskContext.get().partitionId(), {}, 0

        def save(d: int, ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
            nonlocal n
            file = f"{folder}/block-{part}-{n}"
            save_arrays(file, {"asked": (part << 40) + n * size + np.arange(len(ids)), "ids": ids, "vectors": vectors.ravel()})
            n += 1
            return pa.RecordBatch.from_arrays([pa.array([file]), pa.array([vectors.nbytes], pa.int64())], ["file", "bytes"])

        for batch in batches:
            for ids, vectors in usable(batch):
                d = vectors.shape[1]
                if d in held:
                    ids, vectors = np.concatenate([held[d][0], ids]), np.concatenate([held[d][1], vectors])
                while len(ids) >= size:
                    yield save(d, ids[:size], vectors[:size])
                    ids, vectors = ids[size:], vectors[size:]
                held[d] = ids, vectors
        for d, (ids, vectors) in held.items():
            if len(ids):
                yield save(d, ids, vectors)

    parts = max(1, -(-queries.count() // (4 * size)))
    return sorted((r.file, r.bytes) for r in queries.repartition(parts).mapInArrow(pack, "file string, bytes long").collect())


def rounds_of(blocks: list[tuple[str, int]], most: int) -> list[list[str]]:
    """Files of blocks in rounds of at most ``most`` bytes (a larger block is alone)."""
    rounds: list[list[str]] = []
    size = 0
    for file, n in blocks:
        if not rounds or size + n > most:
            rounds.append([])
            size = 0
        rounds[-1].append(file)
        size += n
    return rounds


def compare(rows: DataFrame, files: list[str], k: int) -> DataFrame:
    """The heaps of every task's rows for the queries in ``files``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[Heaps] = []
        for batch in batches:
            if not blocks:
                for level in map(mapped, files):
                    blocks.append(Heaps(level["asked"], level["ids"], level["vectors"].reshape(len(level["ids"]), -1), k))
            for ids, vectors in usable(batch):
                for at in range(0, len(ids), TILE):
                    tile = ids[at : at + TILE], vectors[at : at + TILE]
                    packed = quantise(tile[1])
                    for heaps in blocks:
                        if heaps.vectors.shape[1] == tile[1].shape[1]:
                            heaps.meet(*tile, packed)
        for heaps in blocks:
            yield heaps.rows()

    return rows.mapInArrow(run, "asked long, query_id long, vec_id long, score double")


def merge(found: DataFrame, k: int) -> DataFrame:
    """Merge the tasks' heaps: a query's rows stand side by side and go through one heap of k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, query, heap = None, None, []

        def done() -> pa.RecordBatch:
            best = sorted((-d, -i) for d, i in heap)
            columns = [pa.array([query] * len(best), pa.int64()), pa.array(range(1, len(best) + 1), pa.int32()), pa.array([i for _, i in best], pa.int64()), pa.array([d for d, _ in best], pa.float64())]
            return pa.RecordBatch.from_arrays(columns, ["query_id", "rank", "vec_id", "score"])

        for batch in batches:
            for a, q, i, d in zip(*(batch.column(c).to_pylist() for c in ("asked", "query_id", "vec_id", "score"))):
                if a != asked:
                    if heap:
                        yield done()
                    asked, query, heap = a, q, []
                offer(heap, d, i, k)
        if heap:
            yield done()

    return found.repartition("asked").sortWithinPartitions("asked").mapInArrow(run, "query_id long, rank int, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance) of each query's k nearest rows."""
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark, "nearest")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"), is_query.alias("is_query"))
    rows = rows.where("vec_id is not null and embedding is not null")
    blocks = write_blocks(rows.where("is_query").select("vec_id", "embedding"), scratch.path("blocks"), BLOCK)
    rounds, rows = rounds_of(blocks, ROUND_BYTES) or [[]], rows.select("vec_id", "embedding")
    if len(rounds) == 1:
        return merge(compare(rows, rounds[0], k), k)
    for n, files in enumerate(rounds):  # one table a round, so the last plan stays small
        compare(rows, files, k).write.mode("overwrite").parquet(scratch.path(f"found/{n:06d}"))
    return merge(spark.read.schema("asked long, query_id long, vec_id long, score double").parquet(scratch.path("found/*")), k)
