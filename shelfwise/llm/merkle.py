"""Merkle manifest of a table: one root, a root per tree, and a proof per row.

A node is a row (tree, level, at, digest, size): ``at`` counts nodes of its level from 0
and ``size`` is the number of leaves of its tree, so how many children a parent must have
(its arity) follows from its place alone.

1. ``leaves`` hashes rows in the JVM.  ``numbered`` gives each leaf its place: rows are dealt by
   range of (tree, order), each task counts its own, and counts before a task come
   from one small sum per task and tree.  No tree is sorted in one task.
2. ``climb`` is a combineByKey whose combiners are parents: a digest that arrives is put
   at its place in its parent; a parent that has all its children is hashed and itself
   arrives at its own parent.  A task first combines what it holds, by blocks of
   ``SPAN ** round`` leaves; the nodes whose parents stay incomplete (the frontier) are
   shuffled by the block of the next round and combined again, until every tree has one
   node.  A round multiplies the block by ``SPAN``, so a table of 10^12 rows takes three.
3. Every node keeps a reverse link (``top_level``, ``top_at``) to the node that it became
   part of in its round, and the siblings on the way there.  ``descend`` follows these
   links from the last round to the first: a node's proof is its own siblings and then its
   top's.  The root over the trees' roots is built and descended by the same two steps.

Digests are lowercase hex sha256 of concatenated inputs.

Cases: a null column is hashed as "-"; an empty text as "0:"; rows with a null doc_id come
first in their tree; rows that are equal are leaves of their own, next to each other, and
have proofs of their own; a null tree is a tree before the others, and unlike the empty
string; a tree of one leaf has that leaf as its root; an empty table gives no rows; further
columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import fresh
from shelfwise.session import Scratch, ship

ARITY = 2
#: Leaves of a block of the first round, as a power of the arity; each round multiplies by it.
SPAN_LEVELS = 12
#: Columns that a manifest adds.
PROOF = ("subroot", "root", "proof", "at", "size", "tree_at", "trees")


def digest_of(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(values: list[Column]) -> Column:
    """sha256 of the values, each as its UTF-8 length, a colon and itself, or "-" if null."""
    one = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.sha2(F.concat(*[one(c) for c in values]).cast("binary"), 256)


def height(size: int, arity: int = ARITY) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while size > 1:
        size, levels = -(-size // arity), levels + 1
    return levels


def children(size: int, level: int, at: int, arity: int = ARITY) -> int:
    """How many children the node ``at`` of ``level`` (at least 1) has, in a tree of ``size`` leaves."""
    return min(arity, -(-size // arity ** (level - 1)) - at * arity)


def numbered(rows: DataFrame, order: list[str], scratch: Scratch) -> tuple[DataFrame, int]:
    """``rows`` (tree, ...) with ``at`` (place in the tree by ``order``, nulls first) and ``size`` of the tree; and the largest size.

    ``order`` must tell all rows of a tree apart.
    """
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("task", F.spark_partition_id())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, n = None, 0
        for batch in batches:
            spots = []
            for t in batch.column("tree").to_pylist():
                tree, n = t, n + 1 if n and t == tree else 1
                spots.append(n - 1)
            yield batch.append_column("spot", pa.array(spots, pa.int64()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema) + ", spot long"
    placed = scratch.table(dealt.mapInArrow(count, schema), "placed")
    of_task = placed.groupBy("tree", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task, not per leaf
    counts = of_task.select("tree", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy("tree")).alias("size"))
    counts = counts.select(F.col("tree").alias("_tree"), F.col("task").alias("_task"), "before", "size")
    joined = placed.join(counts, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("task") == F.col("_task")))
    return joined.select(*rows.columns, (F.col("before") + F.col("spot")).alias("at"), "size"), counts.agg(F.max("size")).first()[0] or 1


class Block:
    """Parents of one block: digests arrive, complete parents are emitted upwards."""

    def __init__(self, size: int, top: int, arity: int):
        self.size, self.top, self.arity = size, top, arity
        self.nodes: dict[tuple[int, int], str] = {}
        self.parents: dict[tuple[int, int], dict[int, str]] = {}

    def arrive(self, level: int, at: int, digest: str) -> None:
        """An event: a node is known.  It may complete its parent, which arrives in turn."""
        while True:
            self.nodes[level, at] = digest
            if level >= self.top or -(-self.size // self.arity**level) == 1:
                return
            parent = (level + 1, at // self.arity)
            known = self.parents.setdefault(parent, {})
            known[at % self.arity] = digest
            if len(known) < children(self.size, *parent, self.arity):
                return
            (level, at), digest = parent, digest_of([known[k] for k in sorted(known)])

    def way_up(self, level: int, at: int) -> tuple[int, int, str]:
        """The highest node above one that is known here, and the siblings on the way, level by level, left to right."""
        beside = []
        while level < self.top and (level + 1, at // self.arity) in self.nodes:
            known = self.parents[level + 1, at // self.arity]
            beside += [known[k] for k in sorted(known) if k != at % self.arity]
            level, at = level + 1, at // self.arity
        return level, at, "".join(beside)


def climb(nodes: DataFrame, top: int, arity: int = ARITY) -> DataFrame:
    """``nodes`` (tree, level, at, size, digest, ...) with ``top_level``, ``top_at``, ``top_digest`` and ``siblings``.

    Rows of one block (arity ** top leaves of a tree) that follow each other in a task are
    combined together; ``top`` of a row is the highest node that they complete above it.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema) + ", top_level int, top_at long, top_digest string, siblings string"

    def combine(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        batch = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        level, at, digest = (batch.column(c).to_pylist() for c in ("level", "at", "digest"))
        block = Block(batch.column("size")[0].as_py(), top, arity)
        for event in zip(level, at, digest):
            block.arrive(*event)
        ways = [block.way_up(x, y) for x, y in zip(level, at)]
        more = [pa.array([w[0] for w in ways], pa.int32()), pa.array([w[1] for w in ways], pa.int64()), pa.array([block.nodes[w[:2]] for w in ways], pa.string()), pa.array([w[2] for w in ways], pa.string())]
        return pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "top_level", "top_at", "top_digest", "siblings"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None
        for batch in batches:
            keys = [(t, a // arity ** (top - x)) for t, x, a in zip(*(batch.column(c).to_pylist() for c in ("tree", "level", "at")))]
            start = 0
            for i, key in enumerate(keys):
                if key != current:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    if held:
                        yield combine(held)
                    held, current, start = [], key, i
            if len(keys) > start:
                held.append(batch.slice(start))
        if held:
            yield combine(held)

    return nodes.mapInArrow(fold, schema)


class Forest:
    """All rounds of building trees from numbered leaves (tree, at, size, digest, ...)."""

    def __init__(self, leaves: DataFrame, largest: int, scratch: Scratch, label: str, arity: int = ARITY, span: int = SPAN_LEVELS):
        self.arity, self.rounds = arity, []
        events, levels = leaves.withColumn("level", F.lit(0)).sortWithinPartitions("tree", "at"), height(largest, arity)
        while True:
            top = span * (len(self.rounds) + 1)
            done = scratch.table(climb(events, top, arity), f"{label}-{len(self.rounds)}")
            self.rounds.append(done)
            reached = done.select("tree", F.col("top_level").alias("level"), F.col("top_at").alias("at"), "size", F.col("top_digest").alias("digest")).distinct()
            if len(self.rounds) > 1 and top >= levels:
                break
            block = F.floor(F.col("at") / F.pow(F.lit(float(arity)), top + span - F.col("level")))
            events = reached.repartition("tree", block).sortWithinPartitions("tree", block, "level", "at")
        #: (tree, size, digest): a row per tree.
        self.roots = reached.select("tree", "size", "digest")

    def descend(self, above: DataFrame) -> DataFrame:
        """The leaves with ``proof``: siblings up to the tree's root and then ``above`` (tree, above, ...), whose further columns come along."""
        links = above.select(F.col("tree").alias("_tree"), *[c for c in above.columns if c != "tree"])
        proofs = None
        for done in reversed(self.rounds):
            if proofs is None:
                # A last round has a row per node left over by the tasks before it.
                joined = done.join(links, F.col("tree").eqNullSafe(F.col("_tree"))).withColumn("proof", F.concat("siblings", "above"))
            else:
                joined = done.join(proofs, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("top_level") == F.col("_level")) & (F.col("top_at") == F.col("_at")))
                joined = joined.withColumn("proof", F.concat("siblings", "_proof"))
            carried = [c for c in links.columns if c not in ("_tree", "above")]
            proofs = joined.select(F.col("tree").alias("_tree"), F.col("level").alias("_level"), F.col("at").alias("_at"), F.col("proof").alias("_proof"), *carried)
        return joined.drop("_tree", "_level", "_at", "_proof", "level", "above", "top_level", "top_at", "top_digest", "siblings")


def fold_proof(digest: str, proof: str, spots: list[tuple[int, int]], arity: int = ARITY) -> str:
    """The root that a leaf digest and its siblings give; ``spots`` are (place, size) in each tree on the way."""
    taken = 0
    for at, size in spots:
        while size > 1:
            beside = min(arity, size - at // arity * arity) - 1
            parts = [proof[64 * k : 64 * k + 64] for k in range(taken, taken + beside)]
            parts.insert(at % arity, digest)
            digest, taken = digest_of(parts), taken + beside
            at, size = at // arity, -(-size // arity)
    return digest


def manifest(rows: DataFrame, tree: str, order: str, digest: str, arity: int = ARITY, span: int = SPAN_LEVELS) -> DataFrame:
    """``rows`` with subroot, root, proof (digests in hex, concatenated), at, size, tree_at and trees.

    ``at`` of ``size`` is the row's place in its tree, ``tree_at`` of ``trees`` the tree's
    among the trees; with them ``verify`` folds a proof.  Further columns of ``rows`` stay, but for those of these names.
    """
    spark = rows.sparkSession
    ship(spark)
    scratch = Scratch(spark, "merkle")
    names = {"tree": tree, "order": order, "digest": digest}
    rest = [c for c in rows.columns if c.lower() not in {x.lower() for x in (tree, order, digest, *PROOF)}]
    inner = rows.select(*[F.col(v).alias(k) for k, v in names.items()], *[F.col(c).alias(f"r_{i}") for i, c in enumerate(rest)])
    # Equal rows are told apart by an id that is stored with them, so a task that runs again deals them alike.
    stored = scratch.table(inner.withColumn("row", F.monotonically_increasing_id()), "leaves")
    leaves = Forest(*numbered(stored, ["order", "digest", "row"], scratch), scratch, "leaves-round", arity, span)
    roots = scratch.table(leaves.roots, "roots")
    over = Scratch(spark, "merkle-over")
    tops, n = numbered(roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", F.col("size").alias("leaves")), ["name"], over)
    trees = Forest(tops, n, over, "trees-round", arity, span)
    root = trees.roots.select("tree", F.lit("").alias("above"), F.col("digest").alias("root"))
    placed = trees.descend(root).select(F.col("name").alias("tree"), F.col("proof").alias("above"), "root", F.col("digest").alias("subroot"), F.col("at").alias("tree_at"), F.col("size").alias("trees"))
    out = leaves.descend(over.table(placed, "placed-trees"))
    return out.select(*[F.col(k).alias(v) for k, v in names.items()], *[F.col(f"r_{i}").alias(c) for i, c in enumerate(rest)], *PROOF)


def verify(proved: DataFrame, digest: str, arity: int = ARITY) -> DataFrame:
    """``proved`` (rows of ``manifest``) with ``folded_root``, the root that the column ``digest`` and the proof give, and ``verified``."""
    ship(proved.sparkSession)
    name = fresh(proved, "folded_root")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in (digest, "proof", "at", "size", "tree_at", "trees"))
            found = [fold_proof(d, p, [(a, n), (b, m)], arity) for d, p, a, n, b, m in zip(*columns)]
            yield batch.append_column(name, pa.array(found, pa.string()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in proved.schema) + f", {name} string"
    return proved.mapInArrow(fold, schema).withColumn("verified", F.col(name) == F.col("root"))


def documents_manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, checked (the leaf after tampering, where a row is tampered with), and what ``manifest`` and ``verify`` add."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    leaf = lambda n: leaf_digest([n if c == "n_chars" else F.col(c) for c in fields])
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False)) & F.col("n_chars").isNotNull()
    rows = docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("leaf"), F.when(hit, leaf(F.col("n_chars").cast("decimal(20,0)") + 1)).alias("tampered"))
    proved = manifest(rows, "lang", "doc_id", "leaf")
    return verify(proved.withColumn("checked", F.coalesce("tampered", "leaf")), "checked")
