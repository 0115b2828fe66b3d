"""Reversible line dedup: sharded cuckoo filters backed by exact reference-count tables.

``LineIndex`` holds, as tables in the shared folder,
  postings  (doc_id, h1, h2): which document holds which line key (128-bit hash), once each;
  counts    (h1, h2, n_docs, top): exact number of documents, and the largest doc_id;
  filters   (shard, slots): a cuckoo filter of the live keys of each hash range.

``insert`` asks the filters first: only keys that may be known are joined with the exact
counts, the rest are new.  ``delete`` takes a document's references back; a key whose
count falls to zero leaves its filter.  Inserting and deleting the same documents
restores counts and answers.  ``apply`` drops lines: each shard's keys that are frequent
enough to lose lines have a cuckoo filter of their own, which the shard's postings ask
before the exact table.

Keys: the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased.  Keys of at
least ``min_chars`` code points found in at least ``min_docs`` documents lose their lines
except in the largest doc_id that holds them.

Cases: null and empty texts are one empty line and stay as they are; rows that share a
doc_id count as one document; rows with a null doc_id are neither counted nor changed;
a line repeated within a document counts once and all its occurrences go or stay
together; an empty table gives an empty result; further columns pass through ``apply``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import fresh, mix64, slices
from shelfwise.session import Scratch, ship

MIN_DOCS, MIN_CHARS = 3, 20
#: Least number of shards, as a power of two, and keys per shard from which there are more.
SHARD_BITS, SHARD_KEYS = 6, 500_000
#: Postings of a shard from which there are more salts.
SALT_ROWS = 1_000_000
SLOTS = 4


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; partial-key cuckoo hashing; arrays of keys at a time."""

    def __init__(self, capacity: int = 0, slots: bytes | None = None):
        if slots is not None:
            self.table = np.frombuffer(slots, np.uint16).reshape(-1, SLOTS).copy()
        else:
            buckets = 1 << max(2, int(np.ceil(np.log2(max(1, capacity) / (SLOTS * 0.85)))))
            self.table = np.zeros((buckets, SLOTS), np.uint16)

    @property
    def slots(self) -> bytes:
        return self.table.tobytes()

    def _places(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prints = (h2.view(np.uint64) & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, (h1.view(np.uint64) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, at: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return at ^ (mix64(prints.astype(np.uint64)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        prints, at = self._places(h1, h2)
        hit = (self.table[at] == prints[:, None]).any(axis=1)
        return hit | (self.table[self._other(at, prints)] == prints[:, None]).any(axis=1)

    def insert(self, h1: np.ndarray, h2: np.ndarray, rounds: int = 500) -> bool:
        """False if the filter is too full; it must then be built anew with more room."""
        prints, at = self._places(h1, h2)
        spare = self._other(at, prints)
        roomy = (self.table[at] != 0).all(axis=1) & ~(self.table[spare] != 0).all(axis=1)
        at = np.where(roomy, spare, at)
        for turn in range(rounds):
            if not len(at):
                return True
            _, first = np.unique(at, return_index=True)
            later = np.ones(len(at), bool)
            later[first] = False
            b, p = at[first], prints[first]
            free = self.table[b] == 0
            has = free.any(axis=1)
            self.table[b[has], free[has].argmax(axis=1)] = p[has]
            b, p = b[~has], p[~has]
            victim = (b + turn) % SLOTS
            out = self.table[b, victim].copy()
            self.table[b, victim] = p
            at = np.concatenate([at[later], self._other(b, out)])
            prints = np.concatenate([prints[later], out])
        return not len(at)

    def delete(self, h1: np.ndarray, h2: np.ndarray) -> None:
        """Remove one fingerprint for each key; only keys that were inserted may be named."""
        prints, at = self._places(h1, h2)
        for p, a, b in zip(prints, at, self._other(at, prints)):
            for bucket in (a, b):
                where = np.flatnonzero(self.table[bucket] == p)
                if len(where):
                    self.table[bucket, where[0]] = 0
                    break


def build_filter(h1: np.ndarray, h2: np.ndarray) -> CuckooFilter:
    room = len(h1)
    while True:
        made = CuckooFilter(room)
        if made.insert(h1, h2):
            return made
        room = max(16, room * 2)


def line_keys(text: bytes) -> list[bytes]:
    return [line.strip() for line in text.lower().split(b"\n")]


def long_enough(key: bytes, min_chars: int) -> bool:
    n = len(key)
    return n >= min_chars and (n >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)


def postings_of(docs: DataFrame, min_chars: int) -> DataFrame:
    def hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        for batch in slices(batches, "text"):
            owner, raw = [], []
            for d, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                if text:
                    found = {digest(k) for k in line_keys(text) if long_enough(k, min_chars)}
                    owner.extend([d] * len(found))
                    raw.extend(found)
            both = np.frombuffer(b"".join(raw), np.int64).reshape(-1, 2)
            ids = batch.column("doc_id").take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["doc_id", "h1", "h2"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.where("doc_id is not null and text is not null").mapInArrow(hash_lines, "doc_id long, h1 long, h2 long")


def shard_of(bits: int) -> F.Column:
    return F.shiftrightunsigned("h1", 64 - bits).cast("int")


def filters_of(keys: DataFrame, bits: int) -> DataFrame:
    """(shard, slots): one cuckoo filter for the keys of each hash range."""

    def build(table: pa.Table) -> pa.Table:
        h1, h2 = (table.column(c).to_numpy() for c in ("h1", "h2"))
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "slots": pa.array([build_filter(h1, h2).slots], pa.binary())})

    return keys.select(shard_of(bits).alias("shard"), "h1", "h2").groupBy("shard").applyInArrow(build, "shard int, slots binary")


class LineIndex:
    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, shard_bits: int = SHARD_BITS):
        ship(spark)
        self.spark, self.min_docs, self.min_chars, self.bits = spark, min_docs, min_chars, shard_bits
        self.scratch, self.version, self.salt_rows = Scratch(spark, "lines"), 0, SALT_ROWS
        self.postings: DataFrame | None = None
        self.counts: DataFrame | None = None
        self._filters: DataFrame | None = None

    @property
    def filters(self) -> DataFrame:
        """The cuckoo filters of the live keys, built when a second batch or a deletion first needs them."""
        if self._filters is None:
            self._filters = self._store("filters", filters_of(self.counts, self.bits))
        return self._filters

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        return self.scratch.table(df, f"{name}-{self.version}")

    @staticmethod
    def _count(postings: DataFrame) -> DataFrame:
        return postings.distinct().groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("top"))

    def _maybe_known(self, keys: DataFrame) -> DataFrame:
        """``keys`` with ``known``: false if the filter of the key's shard rules it out."""
        fields = keys.schema
        names = keys.columns

        def ask(left: pa.Table, right: pa.Table) -> pa.Table:
            h1, h2 = (left.column(c).to_numpy() for c in ("h1", "h2"))
            known = CuckooFilter(slots=right.column("slots")[0].as_py()).contains(h1, h2) if right.num_rows else np.zeros(len(h1), bool)
            return left.select(names).append_column("known", pa.array(known))

        sharded = keys.withColumn("shard", shard_of(self.bits))
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", known boolean"
        return sharded.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(ask, schema)

    def insert(self, docs: DataFrame) -> "LineIndex":
        """Add documents.  Lines already held by a document of the same id are not counted again."""
        batch = postings_of(docs, self.min_chars)
        self.version += 1
        if self.postings is None:
            self.postings = self._store("postings", batch)
            self.counts = self._store("counts", self._count(self.postings))
            self.bits = max(self.bits, int(np.ceil(np.log2(max(1, self.counts.count()) / SHARD_KEYS))))
            return self
        batch = self._store("batch", batch.distinct().join(self.postings, ["doc_id", "h1", "h2"], "left_anti"))
        added = self._store("added", self._maybe_known(self._count(batch)))
        old = self.counts.select("h1", "h2", F.col("n_docs").alias("o_n"), F.col("top").alias("o_top"))
        sure = added.where("not known").select("h1", "h2", "n_docs", "top")
        asked = added.where("known").join(old, ["h1", "h2"], "left")
        asked = asked.select("h1", "h2", (F.col("n_docs") + F.coalesce("o_n", F.lit(0))).alias("n_docs"), F.greatest("top", "o_top").alias("top"), "o_n")
        kept = self.counts.join(added.where("known"), ["h1", "h2"], "left_anti")
        fresh_keys = sure.select("h1", "h2").union(asked.where("o_n is null").select("h1", "h2"))
        self._filters = self._store("filters-grown", self._grown(fresh_keys))
        self.counts = self._store("counts", kept.union(sure).union(asked.drop("o_n")))
        self.postings = self._store("postings", self.postings.union(batch))
        return self

    def _grown(self, keys: DataFrame) -> DataFrame:
        everything = self.counts.select("h1", "h2")
        bits = self.bits

        def grow(left: pa.Table, right: pa.Table) -> pa.Table:
            h1, h2, is_new = (left.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "is_new"))
            is_new = is_new.astype(bool)
            held = CuckooFilter(slots=right.column("slots")[0].as_py()) if right.num_rows else CuckooFilter(int(is_new.sum()))
            if not held.insert(h1[is_new], h2[is_new]):
                held = build_filter(h1, h2)
            shard = (left if left.num_rows else right).column("shard")[0].as_py()
            return pa.table({"shard": pa.array([shard], pa.int32()), "slots": pa.array([held.slots], pa.binary())})

        rows = everything.withColumn("is_new", F.lit(False)).union(keys.withColumn("is_new", F.lit(True)))
        rows = rows.select(shard_of(bits).alias("shard"), "h1", "h2", "is_new")
        return rows.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(grow, "shard int, slots binary")

    def delete(self, doc_ids: DataFrame) -> "LineIndex":
        """Take documents back: their references go, and keys that none holds any more leave the filters."""
        self.version += 1
        ids = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        gone = self._store("gone", self.postings.join(ids, "doc_id", "left_semi"))
        left = self._store("postings", self.postings.join(ids, "doc_id", "left_anti"))
        touched = gone.select("h1", "h2").distinct()
        again = self._count(left.join(touched, ["h1", "h2"], "left_semi"))
        dead = touched.join(again, ["h1", "h2"], "left_anti").select(shard_of(self.bits).alias("shard"), "h1", "h2")

        def shrink(left: pa.Table, right: pa.Table) -> pa.Table:
            held = CuckooFilter(slots=right.column("slots")[0].as_py())
            if left.num_rows:
                held.delete(*(left.column(c).to_numpy() for c in ("h1", "h2")))
            return pa.table({"shard": right.column("shard"), "slots": pa.array([held.slots], pa.binary())})

        grouped = dead.groupBy("shard").cogroup(self.filters.groupBy("shard"))
        self._filters = self._store("filters-shrunk", grouped.applyInArrow(shrink, "shard int, slots binary"))
        self.counts = self._store("counts", self.counts.join(touched, ["h1", "h2"], "left_anti").unionByName(again))
        self.postings = left
        return self

    def frequent(self) -> DataFrame:
        return self.counts.where(F.col("n_docs") >= self.min_docs).select("h1", "h2", "top")

    def losses(self) -> DataFrame:
        """(doc_id, drop): the keys whose lines a document loses.

        Every shard's frequent keys become a packet: a cuckoo filter and, behind it, the
        exact keys with their largest doc_id.  Postings meet their shard's packet, ask
        the filter, and only those that it lets through are looked up exactly.  A shard
        with many postings is dealt over several salts, so a hot line fills no task.
        """
        bits, most = self.bits, self.salt_rows
        frequent = self._store("frequent", self.frequent().withColumn("shard", shard_of(bits)))
        load = self.counts.groupBy(shard_of(bits).alias("shard")).agg(F.ceil(F.sum("n_docs") / most).cast("int").alias("salts"))
        load = self._store("load", load.join(frequent.select("shard").distinct(), "shard"))

        def pack(table: pa.Table) -> pa.Table:
            h1, h2, top = (table.column(c).to_numpy() for c in ("h1", "h2", "top"))
            order = np.lexsort((h2, h1))
            blobs = [build_filter(h1, h2).slots, *(x[order].tobytes() for x in (h1, h2, top))]
            return pa.table({"shard": table.column("shard").slice(0, 1), **{c: pa.array([b], pa.binary()) for c, b in zip(("slots", "k1", "k2", "tops"), blobs)}})

        packets = frequent.groupBy("shard").applyInArrow(pack, "shard int, slots binary, k1 binary, k2 binary, tops binary")
        packets = packets.join(load, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
        dealt = self.postings.withColumn("shard", shard_of(bits)).join(load, "shard").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int")).drop("salts")

        def ask(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return left.select(["doc_id", "h1", "h2"]).slice(0, 0)
            blob = lambda c: right.column(c)[0].as_buffer()
            h1, h2 = (left.column(c).to_numpy() for c in ("h1", "h2"))
            maybe = np.flatnonzero(CuckooFilter(slots=blob("slots")).contains(h1, h2))
            left, h1, h2 = left.select(["doc_id", "h1", "h2"]).take(pa.array(maybe)), h1[maybe], h2[maybe]
            k1, k2, tops = (np.frombuffer(blob(c), np.int64) for c in ("k1", "k2", "tops"))
            at, end = np.searchsorted(k1, h1), len(k1) - 1
            while len(at):  # keys that share h1 stand side by side
                here = np.minimum(at, end)
                more = (k1[here] == h1) & (k2[here] < h2) & (at < end)
                if not more.any():
                    break
                at = at + more
            at = np.minimum(at, end)
            lost = (k1[at] == h1) & (k2[at] == h2) & (tops[at] != left.column("doc_id").to_numpy())
            return left.filter(pa.array(lost))

        lost = dealt.groupBy("shard", "salt").cogroup(packets.groupBy("shard", "salt")).applyInArrow(ask, "doc_id long, h1 long, h2 long")
        return lost.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("drop"))

    def apply(self, docs: DataFrame) -> DataFrame:
        """``docs`` with the lines dropped from ``text``, and columns n_lines (before) and n_dropped."""
        key, drop = fresh(docs, "_line_owner"), fresh(docs, "_line_drop")
        n_lines, n_dropped = fresh(docs, "n_lines"), fresh(docs, "n_dropped")
        losses = self.losses().select(F.col("doc_id").alias(key), F.col("drop").alias(drop))
        joined = docs.withColumn("text", F.col("text").cast("string")).join(losses, F.col("doc_id").cast("long") == F.col(key), "left").drop(key)
        schema = docs.withColumn("text", F.col("text").cast("string")).withColumns({n_lines: F.lit(0).cast("long"), n_dropped: F.lit(0).cast("long")}).schema
        names = docs.columns
        place = [n.lower() for n in names].index("text")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import xxhash

            digest = xxhash.xxh3_128_digest
            for batch in slices(batches, names[place]):
                texts, drops = batch.column(place), batch.column(len(names))
                lines = np.asarray(pc.fill_null(pc.count_substring(texts, "\n"), 0)).astype(np.int64) + 1
                dropped = np.zeros(batch.num_rows, np.int64)
                at = np.flatnonzero(np.asarray(drops.is_valid()))
                if len(at):
                    values = texts.to_pylist()
                    for i in at.tolist():
                        raw = values[i].encode("utf-8", "surrogatepass")
                        bad = {np.asarray([k["h1"], k["h2"]], np.int64).tobytes() for k in drops[i].as_py()}
                        kept = [whole for whole, k in zip(raw.split(b"\n"), line_keys(raw)) if digest(k) not in bad]
                        dropped[i] = lines[i] - len(kept)
                        values[i] = b"\n".join(kept).decode("utf-8", "surrogatepass")
                    texts = pa.array(values, texts.type)
                columns = [texts if c == place else batch.column(c) for c in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lines), pa.array(dropped)], [*names, n_lines, n_dropped])

        return joined.mapInArrow(cut, schema)


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Index all documents, then drop their repeated lines."""
    return LineIndex(docs.sparkSession, min_docs, min_chars).insert(docs).apply(docs)
