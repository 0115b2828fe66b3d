"""Filter interaction audit over a packed bitmap index.

1. Every text is looked at once: one byte per document has a bit for each filter that it
   fails.  "Copy of an earlier document" (filter E) compares 128-bit digests of the texts:
   the smallest doc_id of a digest is found with map-side sums and joined back by doc_id,
   so a text that a third of all rows share makes no hot key.
2. Each task packs the bytes of its rows into NumPy bitsets: for every part (source) it
   meets, one bitset per filter and per label, each part beginning at a word of its own.
   These rows are the index (``build_index``), which is written and may be asked again.
3. For every set of filters applied before, the survivors are the AND-NOT of their bitsets
   with the part's own; ANDs with a filter or a label and a popcount give what the filter
   does after that set.  Counts of tasks are summed by (part, set, filter): 80 rows a part
   for five filters, however many documents there are.
4. The orders of filters are looked up in these counts (``orders``), and Shapley sums are
   the removals weighted by how many orders have that set before the filter.

Cases: a null text is an empty one; a null part is the empty string; a document without a
label counts as neither good nor toxic (several label rows of one doc_id count as one that
has any of their marks); rows that share a doc_id are documents of their own, and equal
texts under one doc_id are no copies of each other; a null doc_id is nobody's copy and has
no labels, though equal texts with ids do not see it either; an empty table gives no rows;
further columns are not looked at.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import slices, words_of
from shelfwise.session import Scratch, ship

FILTERS = "ABCDE"
LABELS = ("good", "toxic")
#: Rows whose flags a task holds before it packs them, and parts whose counts it holds.
PACK_ROWS, HELD_PARTS = 1 << 20, 10_000
COUNTS = ["rows", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def text_flags(texts: pa.Array) -> np.ndarray:
    """A byte per text, bit i for the i-th of the filters A to D that it fails."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    words, starts = words_of(texts)
    n_words = np.diff(starts)
    codes = words.dictionary_encode()
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), n_words)
    distinct = np.unique(owner * max(1, len(codes.dictionary)) + codes.indices.to_numpy()) // max(1, len(codes.dictionary))
    n_distinct = np.bincount(distinct, minlength=len(texts))
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    cuts = offsets.astype(np.int64) - offsets[0]

    def count(marked: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(marked, dtype=np.int64)))[cuts])

    upper = count((data >= 65) & (data <= 90))
    points = count((data & 0xC0) != 0x80)
    symbols = count(np.isin(data, np.frombuffer(b"#$%&*|", np.uint8)))
    fails = (n_words < 50, 100 * n_distinct < 65 * n_words, 100 * upper > 5 * points, symbols > 0)
    return sum(f.astype(np.uint8) << i for i, f in enumerate(fails)) if len(texts) else np.empty(0, np.uint8)


def flag_texts(docs: DataFrame, part: str) -> DataFrame:
    """(doc_id, part, flags, d1, d2): what each text fails by itself, and its digest."""
    import xxhash

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = pc.fill_null(batch.column("text"), "")
            digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(t.as_buffer()) for t in texts), np.int64).reshape(-1, 2)
            columns = [batch.column("doc_id"), batch.column("part"), pa.array(text_flags(texts).astype(np.int32)), pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "flags", "d1", "d2"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(flag, "doc_id long, part string, flags int, d1 long, d2 long")


def with_copies(flagged: DataFrame, bit: int) -> DataFrame:
    """``flagged`` with ``bit`` set in ``flags`` where a smaller doc_id has the same text."""
    first = flagged.where("doc_id is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marked = flagged.join(first, ["doc_id", "d1", "d2"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return marked.select("doc_id", "part", F.col("flags").bitwiseOR(F.when(copy, 1 << bit).otherwise(0)).alias("flags"))


def build_index(flagged: DataFrame, n_bits: int) -> DataFrame:
    """(part, n, bits): packed bitsets of the rows of ``flagged`` (part, flags), ``n_bits`` of them behind each other.

    Each bitset of a row holds n rows in whole 64-bit words.  No shuffle: a task packs its own rows.
    """

    def emit(parts: pa.Array, flags: np.ndarray) -> pa.RecordBatch:
        codes = parts.dictionary_encode()
        order = np.argsort(codes.indices.to_numpy(), kind="stable")
        sizes = np.bincount(codes.indices.to_numpy(), minlength=len(codes.dictionary))
        ends = np.cumsum(sizes)
        rows = []
        for a, b in zip((ends - sizes).tolist(), ends.tolist()):
            wide = np.zeros((n_bits, -(-(b - a) // 64) * 64), np.uint8)
            wide[:, : b - a] = flags[order[a:b]][None, :] >> np.arange(n_bits, dtype=flags.dtype)[:, None] & 1
            rows.append(np.packbits(wide, axis=1, bitorder="little").tobytes())
        return pa.RecordBatch.from_arrays([codes.dictionary.cast(pa.string()), pa.array(sizes.astype(np.int64)), pa.array(rows, pa.binary())], ["part", "n", "bits"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= PACK_ROWS:
                table = pa.Table.from_batches(held).combine_chunks()
                yield emit(table.column("part").combine_chunks(), table.column("flags").to_numpy())
                held = []
        if sum(b.num_rows for b in held):
            table = pa.Table.from_batches(held).combine_chunks()
            yield emit(table.column("part").combine_chunks(), table.column("flags").to_numpy())

    return flagged.select("part", F.col("flags").cast("int").alias("flags")).mapInArrow(pack, "part string, n long, bits binary")


def prefix_counts(index: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, before, filter, rows, kept, removed, redundant, unique_fails, good_lost, toxic_lost).

    ``before`` is the set of filters applied earlier, a bit each.  The index holds the
    filters' bitsets and then those of ``LABELS``.
    """
    n = len(filters)
    spots = [(s, f) for s in range(1 << n) for f in range(n) if not s >> f & 1]

    def counts(raw: bytes, rows: int) -> np.ndarray:
        bits = np.frombuffer(raw, np.uint64).reshape(n + len(LABELS), -1)
        fails, good, toxic = bits[:n], bits[n], bits[n + 1]
        part = np.frombuffer(np.packbits(np.arange(bits.shape[1] * 64) < rows, bitorder="little").tobytes(), np.uint64)
        alive = [part]
        for s in range(1, 1 << n):  # what survives a set: what survives it without its last filter, AND NOT that one
            last = s.bit_length() - 1
            alive.append(alive[s ^ 1 << last] & ~fails[last])
        pop = lambda x: int(np.bitwise_count(x).sum())
        every, out = (1 << n) - 1, np.empty((len(spots), len(COUNTS)), np.int64)
        only, total = [pop(alive[every ^ 1 << f] & fails[f]) for f in range(n)], [pop(fails[f]) for f in range(n)]
        for k, (s, f) in enumerate(spots):
            gone = alive[s] & fails[f]
            removed = pop(gone)
            out[k] = rows, pop(alive[s]) - removed, removed, total[f] - removed, only[f], pop(gone & good), pop(gone & toxic)
        return out

    def emit(held: dict[str, np.ndarray]) -> pa.RecordBatch:
        names, grid = list(held), np.concatenate(list(held.values()))
        where = np.asarray(spots * len(names), np.int32)
        columns = [pa.array(names, pa.string()).take(pa.array(np.repeat(np.arange(len(names)), len(spots)))), pa.array(where[:, 0].copy()), pa.array(where[:, 1].copy())]
        return pa.RecordBatch.from_arrays([*columns, *[pa.array(grid[:, k].copy()) for k in range(len(COUNTS))]], ["part", "before", "filter", *COUNTS])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for part, rows, raw in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "bits"))):
                found = counts(raw, rows)
                held[part] = held[part] + found if part in held else found
                if len(held) >= HELD_PARTS:
                    yield emit(held)
                    held = {}
        if held:
            yield emit(held)

    each = index.select("part", "n", "bits").mapInArrow(count, "part string, before int, filter int, " + ", ".join(f"{c} long" for c in COUNTS))
    return each.groupBy("part", "before", "filter").agg(*[F.sum(c).alias(c) for c in COUNTS])


def orders(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Per part, order of all filters and step: the counts of that step's filter, and its Shapley sum over all orders."""
    n = len(filters)
    table = [("".join(filters[f] for f in order), k + 1, sum(1 << f for f in order[:k]), order[k]) for order in itertools.permutations(range(n)) for k in range(n)]
    steps = counts.sparkSession.createDataFrame(table, "filter_order string, step int, before int, filter int")
    ways = F.element_at(F.array(*[F.lit(math.factorial(k) * math.factorial(n - 1 - k)) for k in range(n)]), F.bit_count("before") + 1)
    shares = counts.groupBy("part", "filter").agg(F.sum(F.col("removed") * ways).alias("shapley"))
    # n! * n rows, whatever the data
    return counts.join(shares, ["part", "filter"]).join(F.broadcast(steps), ["before", "filter"]).select("part", "filter_order", "step", *COUNTS[1:], "shapley")


def label_marks(labels: DataFrame, **marks: Column) -> DataFrame:
    """(doc_id, one 0/1 column per mark): whether any label row of the document has the mark."""
    flags = [F.max(F.when(m, 1).otherwise(0)).alias(name) for name, m in marks.items()]
    return labels.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").groupBy("doc_id").agg(*flags)


def index_documents(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The bitmap index of the five filters and two labels, as a written table."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "filter-audit")
    flagged = with_copies(scratch.table(flag_texts(docs, part), "flags"), 4)
    marks = label_marks(labels, good=F.col("quality") == 1, toxic=F.col("toxic") == 1)
    n = len(FILTERS)
    marked = flagged.join(marks, "doc_id", "left")
    bits = [F.coalesce(F.col(name), F.lit(0)) * (1 << n + i) for i, name in enumerate(LABELS)]
    out = scratch.table(build_index(marked.select("part", (F.col("flags") + bits[0] + bits[1]).alias("flags")), n + len(LABELS)), "index")
    scratch.drop("flags")
    return out


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    return orders(prefix_counts(index_documents(docs, labels, part)))
