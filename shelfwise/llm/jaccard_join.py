"""Exact Jaccard join of word n-grams by T-occurrence search over inverted lists.

A text's set are its distinct ``SHINGLE``-word shingles (64-bit hashes); sets x and y
link where 100 * |x & y| >= percent * |x | y|.  So y is on at least T = percent % of the
lists of x's shingles, and a search may leave T - 1 of them out: it merges the shortest
|x| - T + 1 lists, on one of which y must be, and asks the long ones only about what it met.

1. ``ListLengths`` counts in how many texts the shingles of each of ``SLOTS`` slots are: an
   array of fixed size, summed over tasks, that all tasks map from the shared folder.  It
   orders shingles by the length of their lists; any order gives right results.
2. Each distinct set (copies are one node, as in ``near_dups``) posts its id on its
   |x| - T + K short lists, somewhat over a tenth of its shingles for 90 %.  Linked sets have K
   of them in common, the first K shingles of their overlap in the order of lengths.  Spark
   merges the lists by shingle, cuts them by the sizes of their sets and drops sets that
   are on fewer than K lists with another one (``sized_lists``).
3. Every set is searched for from the set of smallest id ("centre") that it meets on most
   lists, and linked to it if it holds; large-star and small-star give the components.
4. A list with two components left is dealt into tiles.  Sets of different components are
   suspects if their sizes allow T and so do the numbers of their shingles per hash class
   (the sum of the smaller numbers is never under the overlap).  Suspects come
   together with their texts in parts of bounded size.
5. Within a task, both steps do a DivideSkip search on an inverted index of its texts
   (``Lists.search``): the short lists are merged through a heap that skips ahead, long
   ones are probed by binary search, and what reaches the required overlap is retained.

Nothing is lost to sampling or chance, but that shingles are 64-bit hashes.  Pairs within
a component are never listed.

Cases: null or empty texts have no shingles and stand alone; texts under three words are
one shingle; rows that share a doc_id are judged each by its own text; rows with a null
doc_id are never linked (component_id is null); an empty table gives an empty result;
further columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import near_dups
from shelfwise.llm.common import mix64, slices
from shelfwise.llm.files import mapped, save_arrays
from shelfwise.session import Scratch, ship

SHINGLE, PERCENT = 3, 90
#: Counters of list lengths, and those of a block that is summed together.
SLOTS, BLOCK = 1 << 22, 1 << 12
#: Hash classes whose numbers of shingles bound an overlap, and lists that a row carries to be compared once only.
CLASSES, LEAD = 64, 8
#: Shingles of a set for each short list, after the first, that it must share.
PER_LIST = 50
#: Sets that are searched for from one centre in one task.
FAN = 256
#: What a heap step costs against a binary search, in DivideSkip's choice of long lists.
MU = 0.01


def least_overlap(size: int, percent: int) -> int:
    """Fewest common shingles of a set of ``size`` with any set that it links to."""
    return -(-percent * size // 100)


def in_common(size: int, percent: int) -> int:
    """K: short lists that a set of ``size`` shares with a linked set of its size or more."""
    return min(max(1, least_overlap(size, percent)), 1 + size // PER_LIST)


class Lists:
    """An inverted index of a few sets: for each shingle the ascending numbers of the sets that hold it."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.n = sets, max(1, len(sets))
        flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        self.keys, codes = np.unique(flat, return_inverse=True)
        owner = np.repeat(np.arange(len(sets), dtype=np.int64), [len(s) for s in sets])
        #: code * n + set, ascending: all lists behind each other.
        self.posted = np.sort(codes.astype(np.int64) * self.n + owner)
        self.begin = np.searchsorted(self.posted, np.arange(len(self.keys) + 1, dtype=np.int64) * self.n)

    def search(self, query: np.ndarray, percent: int, wanted: Callable[[int], bool]) -> list[int]:
        """Numbers of the sets that ``query`` links to, of those that are ``wanted`` when they are met."""
        size = len(query)
        place = np.minimum(np.searchsorted(self.keys, query), max(0, len(self.keys) - 1))
        codes = place[self.keys[place] == query] if len(self.keys) else place[:0]
        need = max(1, least_overlap(size, percent))
        if len(codes) < need:
            return []
        length = self.begin[codes + 1] - self.begin[codes]
        codes = codes[np.argsort(length, kind="stable")]
        # DivideSkip: as many long lists as pay, but so few that a linked set is on a short one.
        n_long = min(need - 1, int(need / (MU * math.log2(max(2, int(length.max()))) + 1)))
        short, long = codes[: len(codes) - n_long], codes[len(codes) - n_long :]
        found = []
        for y, count in self._merge(short, need - n_long):
            other = len(self.sets[y])
            required = -(-percent * (size + other) // (100 + percent))
            if min(size, other) < required or not wanted(y):
                continue
            spots = long * self.n + y
            at = np.minimum(np.searchsorted(self.posted, spots), len(self.posted) - 1)
            if count + int((self.posted[at] == spots).sum()) >= required:
                found.append(y)
        return found

    def _merge(self, codes: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
        """(set, number of lists that hold it) for sets on ``least`` of the lists or more, by a heap that skips what cannot reach it."""
        lists = [(self.posted[self.begin[c] : self.begin[c + 1]] - c * self.n).tolist() for c in codes.tolist()]
        heap, at = [(x[0], k) for k, x in enumerate(lists)], [0] * len(lists)
        heapq.heapify(heap)
        while len(heap) >= least:
            top, met = heap[0][0], []
            while heap and heap[0][0] == top:
                met.append(heapq.heappop(heap)[1])
            if len(met) >= least:
                yield top, len(met)
                for k in met:
                    at[k] += 1
            else:  # least - 1 lists in all are set aside; whatever comes next must be on one of the others
                while heap and len(met) < least - 1:
                    met.append(heapq.heappop(heap)[1])
                if not heap:
                    return
                ahead = heap[0][0]
                for k in met:
                    at[k] = bisect_left(lists[k], ahead, at[k])
            for k in met:
                if at[k] < len(lists[k]):
                    heapq.heappush(heap, (lists[k][at[k]], k))


class ListLengths:
    """How many texts the shingles of each slot are in: a file of fixed size in the shared folder."""

    def __init__(self, texts: DataFrame, scratch: Scratch, size: int = SHINGLE, slots: int = SLOTS):
        self.uri, self.slots = scratch.path("lengths.bin"), slots
        block = min(BLOCK, slots)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(slots, np.uint32)
            for batch in slices(batches, "text"):
                sets = near_dups.shingle_sets(batch.column("text"), size)
                if sum(map(len, sets)):
                    np.add.at(total, (np.concatenate(sets) & np.uint64(slots - 1)).astype(np.int64), 1)
            grid = np.minimum(total, 65_535).astype(np.uint16).reshape(-1, block)
            used = np.flatnonzero(grid.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([grid[k].tobytes() for k in used], pa.binary())], ["block", "counts"])

        def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(block, np.int64)
            for batch in batches:
                for raw in batch.column("counts").to_pylist():
                    total += np.frombuffer(raw, np.uint16)
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.astype(np.uint32).tobytes()], pa.binary())], ["block", "counts"])

        uri = self.uri

        def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((slots // block, block), np.uint32)
            for batch in batches:
                for k, raw in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                    total[k] = np.frombuffer(raw, np.uint32)
            save_arrays(uri, {"lengths": total.reshape(-1)})
            yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32())], ["n"])

        # Each task has an array of its own: few tasks, each of many texts.
        tasks = max(1, 2 * texts.sparkSession.sparkContext.defaultParallelism)
        blocks = texts.select("text").coalesce(tasks).mapInArrow(count, "block int, counts binary").groupBy("block").applyInArrow(add, "block int, counts binary")
        scratch.table(blocks, "lengths").coalesce(1).mapInArrow(save, "n int").count()  # SLOTS numbers, whatever the input

    def order(self, hashes: np.ndarray) -> np.ndarray:
        """``hashes`` (ascending) by the length of their lists, shortest first, and then by hash."""
        return hashes[np.argsort(mapped(self.uri)["lengths"][(hashes & np.uint64(self.slots - 1)).astype(np.int64)], kind="stable")]


def class_counts(hashes: np.ndarray) -> bytes:
    """Shingles per hash class in a byte each, rounded up to a step, and the step (4 bytes) in front."""
    found = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % CLASSES, minlength=CLASSES)
    step = max(1, -(-int(found.max()) // 255))
    return np.uint32(step).tobytes() + (-(-found // step)).astype(np.uint8).tobytes()


def class_bounds(rows: list[bytes]) -> np.ndarray:
    """Of each row of ``class_counts``, numbers that are at least the true ones."""
    raw = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), 4 + CLASSES)
    return raw[:, 4:].astype(np.int32) * raw[:, :4].copy().view(np.uint32).astype(np.int32)


def postings(texts: DataFrame, lengths: ListLengths, percent: int, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, d1, d2 (digest of the set), short (shingles of its short lists, shortest first), classes (``class_counts``)."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = near_dups.shingle_sets(batch.column("text"), size)
            digests = [near_dups.digest(s) for s in sets]
            short = [lengths.order(s)[: len(s) - least_overlap(len(s), percent) + in_common(len(s), percent)].view(np.int64) if len(s) else None for s in sets]
            columns = [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *[pa.array([d[k] for d in digests], pa.int64()) for k in (0, 1)]]
            columns += [pa.array(short, pa.list_(pa.int64())), pa.array([class_counts(s) if len(s) else None for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "d1", "d2", "short", "classes"])

    return texts.mapInArrow(post, "doc_id long, n_shingles long, d1 long, d2 long, short array<long>, classes binary")


def sized_lists(reps: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(key, id, centre): short lists cut by size, with two sets or more; ``centre`` is the smallest id.

    Linked sets differ in size by a factor of 100 / percent at most, so a set stands in the
    list's part of its own size step and in that of the next.  A set that shares fewer than K
    lists of a step (K of the smallest size that it may link to) leaves that step.
    """

    def several(rows: DataFrame) -> DataFrame:
        lists = rows.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key")
        return rows.join(lists, "key", "left_semi")

    def often(rows: DataFrame, *by: str) -> DataFrame:
        return rows.join(rows.groupBy(*by).agg(F.count("*").alias("_n"), F.min("needed").alias("_k")).where("_n >= _k").select(*by), list(by), "left_semi")

    least = lambda n: F.ceil(n * percent / 100.0 - 1e-9)
    needed = F.least(F.greatest(F.lit(1), least(least(F.col("n_shingles")))), 1 + F.floor(least(F.col("n_shingles")) / PER_LIST))
    keyed = reps.select("id", F.explode("short").alias("key"))
    sizes = reps.select("id", "n_shingles", needed.alias("needed"))
    shared = scratch.table(several(keyed), "shared").join(sizes, "id")
    step = F.floor(F.log(F.col("n_shingles")) / (math.log(100 / percent) * (1 + 1e-9))) if percent < 100 else F.col("n_shingles")
    parts = often(shared, "id").select("id", "needed", F.explode(F.array(step, step + 1)).alias("step"), "key").withColumn("key", F.xxhash64("key", "step"))
    parts = scratch.table(often(scratch.table(several(parts), "steps"), "id", "step").select("key", "id"), "parts")
    lists = parts.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("hi")).where("centre < hi").drop("hi")
    met = scratch.table(parts.join(lists, "key").select("key", "id", "centre"), "met")
    scratch.drop("shared", "steps", "parts")
    return met


def texts_of(texts: DataFrame, wanted: DataFrame, signed: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(id, text) of the nodes ``wanted`` (id, rep, d1, d2), each once; texts cross the network once where doc_ids are not repeated."""
    if not signed.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return near_dups.bodies_of(texts, wanted, size)
    return texts.join(wanted.select(F.col("rep").alias("doc_id"), "id"), "doc_id").select("id", "text")


def search_centres(pairs: DataFrame, bodies: DataFrame, percent: int, size: int = SHINGLE) -> DataFrame:
    """Those (a, b) of ``pairs``, with a in one pair only, that link: every b is searched for in an index of its a's.

    A centre's sets are dealt over salts, and its text is sent to each.
    """
    fans = pairs.groupBy("b").agg(F.ceil(F.count("*") / FAN).alias("salts"))
    dealt = pairs.join(fans, "b").select("b", F.pmod(F.xxhash64("a"), F.col("salts")).alias("salt"), F.col("a").alias("id"))
    centres = fans.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.col("b").alias("id"))
    both = dealt.withColumn("asked", F.lit(1)).union(centres.withColumn("asked", F.lit(0))).join(bodies, "id").withColumn("group", F.xxhash64("b", "salt"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, group = None, None
        for whole in batches:
            for batch in slices(iter([whole]), "text"):
                sets, ids = near_dups.shingle_sets(batch.column("text"), size), batch.column("id").to_pylist()
                asked, groups, b = (batch.column(c).to_pylist() for c in ("asked", "group", "b"))
                cuts = [0, *[i for i in range(1, len(ids)) if groups[i] != groups[i - 1] or not asked[i]], len(ids)]
                found: list[tuple[int, int]] = []
                for start, end in zip(cuts[:-1], cuts[1:]):
                    if not asked[start]:
                        centre, group, start = sets[start], groups[start], start + 1
                    if start < end and groups[start] == group:
                        found += [(ids[start + k], b[start]) for k in Lists(sets[start:end]).search(centre, percent, lambda _: True)]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    dealt = both.select("group", "b", "salt", "asked", "id", "text").repartition("group").sortWithinPartitions("group", "b", "salt", "asked")
    return dealt.mapInArrow(search, "a long, b long")


def whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by tile in tables that end where a tile does."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        tile = batch.column("tile").to_numpy()
        last = int(np.searchsorted(tile, tile[-1]))  # where the last tile of the batch begins
        if held and (last or held[-1].column("tile")[0].as_py() != tile[0]):
            end = int(np.searchsorted(tile, held[-1].column("tile")[0].as_py(), side="right"))
            yield pa.Table.from_batches([*held, batch.slice(0, max(end, last))]).combine_chunks()
            held, batch = [], batch.slice(max(end, last))
        elif last:
            yield pa.Table.from_batches([batch.slice(0, last)])
            batch = batch.slice(last)
        if batch.num_rows:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def suspects(rows: DataFrame, percent: int) -> DataFrame:
    """(part, id, comp, is_main, partners): sets on a list of two components that may link across them.

    ``rows``: key, id, comp, n_shingles, classes, lead (the ``LEAD`` smallest keys of the set's rows).  A pair
    is left to a smaller key that both carry in ``lead``.  Parts are as in ``near_dups``.
    """
    most, side = near_dups.PART_SHINGLES, near_dups.PART_ROWS

    def wanted_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Places (i, j) of suspects, i < j, of all tiles of a table at once: rows of one tile stand together."""
        tile, comp, size, main = (table.column(c).to_numpy() for c in ("tile", "comp", "n_shingles", "is_main"))
        classes = class_bounds(table.column("classes").to_pylist())
        found, left = [], np.arange(len(tile))
        for d in range(1, len(tile)):  # each row with the one d places on, while tiles are that long
            left = left[left + d < len(tile)]
            left = left[tile[left] == tile[left + d]]
            if not len(left):
                break
            i = left[(comp[left] != comp[left + d]) & ~(main[left] & main[left + d]).astype(bool)]
            need = -(-percent * (size[i] + size[i + d]) // (100 + percent))
            i, need = (x[np.minimum(size[i], size[i + d]) >= need] for x in (i, need))
            found.append(np.stack([i, i + d])[:, np.minimum(classes[i], classes[i + d]).sum(axis=1) >= need])
        i, j = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
        if not len(i):
            return i, j
        key, lead = table.column("key").to_pylist(), table.column("lead").to_pylist()
        keep = [all(k >= key[x] or k not in lead[y] for k in lead[x]) for x, y in zip(i.tolist(), j.tolist())]
        return i[keep], j[keep]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_tiles(batches):
            i, j = wanted_of(table)
            order = np.lexsort((j, i))
            i, j = i[order], j[order]
            ids, sizes, tiles = (table.column(c).to_numpy() for c in ("id", "n_shingles", "tile"))
            cuts = np.flatnonzero(np.diff(tiles[i])) + 1
            for rows, partners in zip(np.split(i, cuts), np.split(j, cuts)):
                if not len(rows):
                    continue
                mine, begin = np.unique(rows, return_index=True)
                wanted = list(zip(mine.tolist(), np.split(partners, begin[1:])))
                number = np.asarray([int(tiles[rows[0]]) % 2**64], np.uint64)
                for n, part in enumerate(p for some in near_dups._squares(wanted, side) for p in near_dups._parts(some, sizes, most)):
                    at = np.unique(np.concatenate([*part.values(), np.fromiter(part, np.int64)]))
                    kept = table.select(["id", "comp", "is_main"]).take(pa.array(at)).combine_chunks().to_batches()[0]
                    named = [ids[part[x]] if x in part else ids[:0] for x in at.tolist()]
                    part_id = mix64(number + np.uint64(n)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part_id, len(at))), *kept.columns, pa.array(named, pa.list_(pa.int64()))], ["part", *kept.schema.names, "partners"])

    dealt = near_dups._tiled(rows).select("tile", "key", "id", "comp", "is_main", "n_shingles", "classes", "lead")
    return dealt.repartition("tile").sortWithinPartitions("tile").mapInArrow(find, "part long, id long, comp long, is_main boolean, partners array<long>")


def search_suspects(found: DataFrame, bodies: DataFrame, percent: int, size: int = SHINGLE) -> DataFrame:
    """Links (a, b) among suspects, searched for in an index of their part; only those that join two components anew."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in near_dups._runs(batches, "part"):
            ids, comps, partners = (table.column(c).to_pylist() for c in ("id", "comp", "partners"))
            index = Lists(near_dups.shingle_sets(table.column("text").combine_chunks(), size))
            root, links = {c: c for c in comps}, []

            def top(c: int) -> int:
                while root[c] != c:  # noqa: B023
                    root[c] = root[root[c]]  # noqa: B023
                    c = root[c]  # noqa: B023
                return c

            for i, named in enumerate(partners):
                if not named:
                    continue
                mine = set(named)
                for j in index.search(index.sets[i], percent, lambda y: ids[y] in mine and top(comps[y]) != top(comps[i])):  # noqa: B023
                    x, y = top(comps[i]), top(comps[j])
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        links.append((ids[i], ids[j]))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([k[n] for k in links], pa.int64()) for n in (0, 1)], ["a", "b"])

    joined = found.join(bodies, "id").select("part", "id", "comp", "is_main", "partners", "text")
    return joined.repartition("part").sortWithinPartitions("part").mapInArrow(search, "a long, b long").distinct()


def jaccard_components(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, slots: int = SLOTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept (the row whose doc_id names the component)."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "jaccard")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = scratch.table(postings(texts, ListLengths(texts, scratch, size, slots), percent, size), "signed")
    reps, apart = near_dups.representatives(signed, ["n_shingles", "short", "classes"], scratch)
    met = sized_lists(reps, percent, scratch)
    wanted = reps.select("id", "rep", "d1", "d2").join(met.select("id").distinct(), "id", "left_semi")
    bodies = scratch.table(texts_of(texts, wanted, signed, size), "bodies")

    first = met.where("id <> centre").groupBy("id", "centre").count()
    first = first.groupBy("id").agg(F.max_by("centre", F.struct("count", -F.col("centre"))).alias("b")).select(F.col("id").alias("a"), "b")
    labels = near_dups.components(search_centres(scratch.table(first, "first"), bodies, percent, size), scratch, "cc")

    placed = met.join(labels, "id", "left").select("key", "id", F.coalesce("component", "id").alias("comp"))
    several = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    rows = scratch.table(placed.join(several, "key", "left_semi"), "several")
    lead = rows.groupBy("id").agg(F.slice(F.array_sort(F.collect_set("key")), 1, LEAD).alias("lead"))  # as many keys as a set has short lists
    rows = scratch.table(rows.join(reps.select("id", "n_shingles", "classes").join(lead, "id"), "id"), "open")
    found = scratch.table(suspects(rows, percent), "suspects")
    scratch.drop("met", "open", "first")
    return near_dups.settle(signed, reps, apart, labels, search_suspects(found, bodies, percent, size), scratch)
