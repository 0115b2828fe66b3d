"""MinHash near-duplicate detection.

1. Every text becomes its set of distinct five-word shingles (64-bit hashes), a digest of
   the whole set, and the minima of ``BANDS * ROWS`` universal hashes of it.  Documents
   with one digest are copies, one node of the graph, named by their smallest doc_id (by
   a hash of the digest where rows that share a doc_id differ).
2. Representatives whose minima agree in a whole band share a bucket.  Each is compared
   with the bucket centre (smallest id) that it meets in most bands, on full sets.
3. Connected components of the confirmed links are found by alternating large-star and
   small-star.
4. In every bucket that still holds two components or more, documents of different
   components whose signatures agree in ``SIGNATURE_FLOOR`` of the minima are compared on
   full sets too, inside a task: rows name their suspects in a list, and only links that
   join components anew come out.  Pairs inside a component add nothing and are never
   looked at.  Large buckets are cut into tiles of bounded size, and the suspects of a
   tile are dealt on in parts of bounded text.
5. Components joined by such links are merged in the same way.

A pair at the threshold s shares no band with probability (1 - s^ROWS)^BANDS: at 0.85
with 6 rows and 30 bands under 1e-6.  The floor is more than five standard deviations
below the threshold, so no link is lost to it in practice.  ``ROWS``, ``BANDS`` and
``SIGNATURE_FLOOR`` are fitted to 0.85; a caller with another threshold gives its own.

Cases: null or empty texts have no shingles and stand alone; texts under five words are
one shingle; rows that share a doc_id are judged each by its own text (their components
may differ, and "kept" tells whether the row's component is named by its doc_id); rows
with a null doc_id are never linked (component_id is null, kept is true); an empty table gives an
empty result; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import hash_words, mix64, slices, words_of
from shelfwise.session import Scratch, ship

SHINGLE = 5
ROWS, BANDS = 6, 30
SIGNATURE_FLOOR = 0.70
#: Rows of a block of a bucket; two blocks meet in one tile.
TILE = 256
#: Shingles of the texts that a task compares at once, rows of either side of such a part, and links to one centre from
#: which there are more salts.
PART_SHINGLES, PART_ROWS, FAN = 2_000_000, 128, 2_000
SEED = 20_240_501

def _multipliers(size: int) -> np.ndarray:
    return mix64(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``size`` words."""
    words, starts = words_of(texts, lower=True)
    hashed, c = hash_words(words), _multipliers(size)
    out, n = [], len(hashed)
    if n >= size:
        windows = hashed[: n - size + 1] * c[0]
        for k in range(1, size):
            windows += hashed[k : n - size + 1 + k] * c[k]
        windows = mix64(windows)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(windows[a : b - size + 1]))
        elif b > a:
            short = (hashed[a:b] * c[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix64(np.asarray([short], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def digest(hashes: np.ndarray) -> tuple[int, int] | tuple[None, None]:
    """128-bit hash of a set; none of an empty one."""
    import xxhash

    return tuple(np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), np.int64).tolist()) if len(hashes) else (None, None)


class MinHasher:
    """Minima of many universal hashes a * x + b over 32-bit words."""

    def __init__(self, rows: int = ROWS, bands: int = BANDS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        n = rows * bands
        self.rows, self.bands = rows, bands
        self.a = (rng.integers(0, 2**31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.b = rng.integers(0, 2**32, n, dtype=np.uint32)[:, None]
        self.weight = mix64(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
        self.salt = mix64(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(977))

    def minima(self, hashes: np.ndarray, step: int = 1024) -> np.ndarray:
        x = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32)
        least = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(x), step):
            np.minimum(least, (self.a * x[None, at : at + step] + self.b).min(axis=1), out=least)
        return least

    def band_keys(self, minima: np.ndarray) -> np.ndarray:
        grid = minima.reshape(self.bands, self.rows).astype(np.uint64)
        return mix64((grid * self.weight).sum(axis=1, dtype=np.uint64) ^ self.salt).view(np.int64)


def signatures(docs: DataFrame, hasher: MinHasher) -> DataFrame:
    """doc_id, n_shingles, d1, d2 (digest of the set), bands, sig (16 bits of each minimum)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n, digests, bands, sigs = [], [], [], []
            for s in shingle_sets(batch.column("text")):
                n.append(len(s))
                digests.append(digest(s))
                if not len(s):
                    bands.append(None)
                    sigs.append(None)
                    continue
                least = hasher.minima(s)
                bands.append(hasher.band_keys(least))
                sigs.append(least.astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sigs, pa.binary()),
                ],
                ["doc_id", "n_shingles", "d1", "d2", "bands", "sig"],
            )

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sig binary")


def bodies_of(texts: DataFrame, wanted: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(id, text) of the nodes ``wanted`` (id, rep, d1, d2): a text of each, told by its digest, since rows may share a doc_id."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [digest(s) for s in shingle_sets(batch.column("text"), size)]
            yield pa.RecordBatch.from_arrays([*[pa.array([d[k] for d in found], pa.int64()) for k in (0, 1)], batch.column("text")], ["d1", "d2", "text"])

    theirs = texts.join(wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").select("text")
    one = theirs.mapInArrow(sign, "d1 long, d2 long, text string").groupBy("d1", "d2").agg(F.first("text").alias("text"))
    return one.join(wanted, ["d1", "d2"]).select("id", "text")


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b), with a in one pair only, whose full sets have 100 * intersection >= percent * union.

    Pairs of a b that is in many are dealt over salts, and its text is sent to each.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(iter([whole]), "text_a"):
                left, right = shingle_sets(batch.column("text_a")), shingle_sets(batch.column("text_b"))
                keep = []
                for x, y in zip(left, right):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    fans = pairs.groupBy("b").agg(F.ceil(F.count("*") / FAN).alias("salts")).where("salts > 1")
    dealt = pairs.join(fans, "b", "left").withColumn("salt", F.pmod(F.xxhash64("a"), F.coalesce("salts", F.lit(1)))).drop("salts")
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")).join(fans, "b", "left")
    right = right.select("b", "text_b", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    joined = dealt.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(right, ["b", "salt"])
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long").distinct()


def components(edges: DataFrame, scratch: Scratch, label: str) -> DataFrame:
    """(id, component): smallest id reachable over ``edges`` (a, b), by alternating large-star and small-star.

    Ids without an edge do not occur.  Only a count and a sum of hashes come to the driver.
    """
    state = scratch.table(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), f"{label}-0"
    )
    mark, step, last = None, 0, f"{label}-0"
    while True:
        found = state.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (found.n, found.h) == mark or not found.n:
            break
        mark, step = (found.n, found.h), step + 1
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = scratch.table(large, f"{label}-{step}-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(least, "u")
        small = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        state = scratch.table(small.distinct(), f"{label}-{step}")
        scratch.drop(last, f"{label}-{step}-large")
        last = f"{label}-{step}"
    return state.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _tiled(rows: DataFrame) -> DataFrame:
    """Deal the rows of each bucket (key, id, comp, ...) into tiles; adds ``tile`` and ``is_main``.

    A bucket's rows of its largest component ("main") and its other rows are dealt into
    blocks; a tile joins one block of others with one block of either kind, so a task
    never holds more than two blocks of a bucket at once, and main never meets main.
    """
    sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("n"))
    buckets = (
        sizes.groupBy("key")
        .agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("total"))
        .select("key", F.col("top.comp").alias("main"), F.ceil(F.col("top.n") / TILE).alias("mains"), F.ceil((F.col("total") - F.col("top.n")) / TILE).alias("others"))
    )
    placed = rows.join(buckets, "key").withColumn("is_main", F.col("comp") == F.col("main"))
    block = F.pmod(F.xxhash64("id"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others")))
    spot = lambda other, second, with_main: F.struct(other.alias("other"), second.alias("second"), F.lit(with_main).alias("with_main"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    block_col = F.col("block")
    tiles = F.when(F.col("is_main"), F.transform(upto("others"), lambda o: spot(o, block_col, True))).otherwise(
        F.concat(
            F.transform(upto("mains"), lambda m: spot(block_col, m, True)),
            F.transform(upto("others"), lambda o: spot(F.greatest(o, block_col), F.least(o, block_col), False)),
        )
    )
    dealt = placed.withColumn("block", block).select(*rows.columns, "is_main", F.explode(tiles).alias("t"))
    return dealt.withColumn("tile", F.xxhash64("key", "t.other", "t.second", "t.with_main")).drop("t")


def _runs(batches: Iterator[pa.RecordBatch], by: str = "tile") -> Iterator[pa.Table]:
    """The rows of one tile after another, from batches sorted by tile."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        tile = batch.column(by).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(tile)) + 1).tolist(), len(tile)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and tile[a] != current:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            current = tile[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _others_first(table: pa.Table) -> tuple[pa.Table, int]:
    main = table.column("is_main").to_numpy().astype(bool)
    return table.take(pa.array(np.argsort(main, kind="stable"))), int((~main).sum())


def suspects(rows: DataFrame, width: int, bands: int, floor: float) -> DataFrame:
    """(part, id, comp, is_main, partners): rows of open buckets that may be linked across components.

    ``rows``: key, band, id, comp, n_shingles, sig, bands.  ``partners`` are the ids whose
    signatures agree well enough; a pair is named only in the first band that both share,
    by one of the two.  Rows that are merely named have an empty list.  A part holds at most
    ``PART_ROWS`` rows with partners and as many partners, of ``PART_SHINGLES`` in all (two
    texts always fit); a row may be in several parts.
    """

    most, side = PART_SHINGLES, PART_ROWS

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            if table.num_rows < 2:
                continue
            table, others = _others_first(table)
            ids, comps = table.column("id").to_numpy(), table.column("comp").to_numpy()
            sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(-1, width)
            keys = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, bands)
            band, sizes = int(table.column("band")[0].as_py()), table.column("n_shingles").to_numpy()
            wanted: list[tuple[int, np.ndarray]] = []
            for i in range(others):
                j = np.flatnonzero(comps[i + 1 :] != comps[i]) + i + 1
                j = j[(sigs[j] == sigs[i]).sum(axis=1) >= floor * width]
                j = j[~(keys[j, :band] == keys[i, :band]).any(axis=1)]
                if len(j):
                    wanted.append((i, j))
            for n, part in enumerate(p for some in _squares(wanted, side) for p in _parts(some, sizes, most)):
                at = np.unique(np.concatenate([*part.values(), np.fromiter(part, np.int64)]))
                kept = table.select(["id", "comp", "is_main"]).take(pa.array(at)).combine_chunks().to_batches()[0]
                number = mix64(np.asarray([int(table.column("tile")[0].as_py()) % 2**64], np.uint64) + np.uint64(n)).view(np.int64)
                named = [ids[part[i]] if i in part else ids[:0] for i in at.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(number, len(at))), *kept.columns, pa.array(named, pa.list_(pa.int64()))], ["part", *kept.schema.names, "partners"])

    dealt = _tiled(rows).select("tile", "id", "comp", "is_main", "n_shingles", "sig", "band", "bands")
    return dealt.repartition("tile").sortWithinPartitions("tile").mapInArrow(find, "part long, id long, comp long, is_main boolean, partners array<long>")


def _squares(wanted: list[tuple[int, np.ndarray]], side: int) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Comparisons (a row, its partners) dealt into squares of ``side`` rows and as many partners."""
    squares: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
    for i, partners in wanted:
        for b in np.unique(partners // side).tolist():
            squares.setdefault((i // side, b), []).append((i, partners[partners // side == b]))
    yield from squares.values()


def _parts(wanted: list[tuple[int, np.ndarray]], sizes: np.ndarray, most: int) -> Iterator[dict[int, np.ndarray]]:
    """Cut comparisons (a row, its partners) into parts whose rows have ``most`` shingles, or are two."""
    part: dict[int, np.ndarray] = {}
    held: set[int] = set()
    total = 0
    for i, partners in wanted:
        at = 0
        while at < len(partners):
            new = [] if i in held else [i]
            size, to = total + sum(int(sizes[x]) for x in new), at
            while to < len(partners):
                j = int(partners[to])
                more = 0 if j in held or j in new else int(sizes[j])
                if size + more > most and (part or to > at):
                    break
                size, to = size + more, to + 1
                new.append(j)
            if to > at:
                part[i] = np.concatenate([part[i], partners[at:to]]) if i in part else partners[at:to]
                held.update(new)
                total, at = size, to
            if at < len(partners):
                yield part
                part, held, total = {}, set(), 0
    if part:
        yield part


def confirm_suspects(found: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among suspects, confirmed on full sets; per part only those that join two components anew."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, "part"):
            table, others = _others_first(table)
            ids, partners = table.column("id").to_numpy(), table.column("partners").to_pylist()
            sets = shingle_sets(table.column("text").combine_chunks())
            sizes = [len(s) for s in sets]
            codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
            cuts = np.cumsum([0, *sizes])
            parts = [codes[cuts[i] : cuts[i + 1]] for i in range(len(sets))]
            root = {c: c for c in table.column("comp").to_pylist()}
            comps = table.column("comp").to_pylist()
            place = {int(x): i for i, x in enumerate(ids)}

            def top(c: int) -> int:
                while root[c] != c:  # noqa: B023
                    root[c] = root[root[c]]  # noqa: B023
                    c = root[c]  # noqa: B023
                return c

            mark, links = np.zeros(int(codes.max(initial=-1)) + 1, bool), []
            for i in range(others):
                if not partners[i]:
                    continue
                mark[parts[i]] = True
                for j in sorted(place[p] for p in partners[i] if p in place):
                    x, y = top(comps[i]), top(comps[j])
                    if x == y or 100 * min(sizes[i], sizes[j]) < percent * max(sizes[i], sizes[j]):
                        continue
                    both = int(np.count_nonzero(mark[parts[j]]))
                    if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                        root[max(x, y)] = min(x, y)
                        links.append((int(ids[i]), int(ids[j])))
                mark[parts[i]] = False
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([k[n] for k in links], pa.int64()) for n in (0, 1)], ["a", "b"])

    joined = found.join(texts, "id").select("part", "id", "comp", "is_main", "partners", "text")
    return joined.repartition("part").sortWithinPartitions("part").mapInArrow(check, "a long, b long").distinct()


def representatives(signed: DataFrame, keep: list[str], scratch: Scratch) -> tuple[DataFrame, bool]:
    """(d1, d2, rep, id, ...): one row per set, and whether no two sets share their smallest doc_id (``rep``, then ``id`` too)."""
    reps = signed.where("doc_id is not null and d1 is not null").groupBy("d1", "d2")
    reps = scratch.table(reps.agg(F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in keep]), "reps")
    shared = reps.groupBy("rep").count().where("count > 1").select("rep", F.lit(True).alias("shared"))
    apart = shared.isEmpty()
    reps = reps.withColumn("id", F.col("rep")) if apart else reps.join(shared, "rep", "left").withColumn("id", F.when(F.col("shared"), F.xxhash64("d1", "d2")).otherwise(F.col("rep"))).drop("shared")
    return reps, apart


def settle(signed: DataFrame, reps: DataFrame, apart: bool, labels: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row: components ``labels`` merged by ``links``, spread to all copies."""
    of = lambda side: labels.select(F.col("id").alias(side), F.col("component").alias(f"c{side}"))
    merged = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    top = components(merged, scratch, "top").select(F.col("id").alias("component"), F.col("component").alias("root"))

    placed = reps.select("id", "rep", "d1", "d2").join(labels, "id", "left").select("d1", "d2", "rep", F.coalesce("component", "id").alias("component"))
    placed = placed.join(top, "component", "left").select("d1", "d2", "rep", F.coalesce("root", "component").alias("root"))
    if not apart:  # a root may then be a hash: the component's smallest doc_id is looked up
        placed = scratch.table(placed, "rooted")
        placed = placed.join(placed.groupBy("root").agg(F.min("rep").alias("least")), "root").select("d1", "d2", F.col("least").alias("root"))
    placed = scratch.table(placed.select("d1", "d2", "root"), "placed")
    scratch.drop("bodies", "reps")
    result = signed.select("doc_id", "n_shingles", "d1", "d2").join(placed, ["d1", "d2"], "left")
    owner = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return result.select("doc_id", "n_shingles", owner.alias("component_id"), F.coalesce(F.col("doc_id") == owner, F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, percent: int = 85, rows: int = ROWS, bands: int = BANDS, floor: float = SIGNATURE_FLOOR) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked where 100 * intersection >= percent * union of their shingle sets.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch, hasher = Scratch(spark, "near-dups"), MinHasher(rows, bands)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = scratch.table(signatures(texts, hasher), "signed")
    reps, apart = representatives(signed, ["n_shingles", "bands", "sig"], scratch)
    keyed = reps.select("id", F.posexplode("bands").alias("band", "key"))
    buckets = keyed.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("most")).where("centre < most").drop("most")
    met = scratch.table(keyed.join(buckets, "key"), "met")
    wanted = reps.select("id", "rep", "d1", "d2").join(met.select("id").distinct(), "id", "left_semi")
    bodies = scratch.table(bodies_of(texts, wanted), "bodies")

    first = (
        met.where("id <> centre").groupBy("id", "centre").count()
        .groupBy("id").agg(F.max_by("centre", F.struct("count", -F.col("centre"))).alias("b"))
        .select(F.col("id").alias("a"), "b")
    )
    first = scratch.table(first, "first")
    labels = components(confirm(first, bodies, percent), scratch, "cc")

    placed = met.join(labels, "id", "left").select("key", "band", "id", F.coalesce("component", "id").alias("comp"))
    open_keys = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    open_rows = placed.join(open_keys, "key", "left_semi")
    open_rows = scratch.table(open_rows.join(reps.select("id", "n_shingles", "sig", "bands"), "id"), "open")
    found = scratch.table(suspects(open_rows, rows * bands, bands, floor), "suspects")
    links = confirm_suspects(found, bodies, percent)
    scratch.drop("met", "open", "first")
    return settle(signed, reps, apart, labels, links, scratch)
