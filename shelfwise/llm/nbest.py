"""N-best SentencePiece segmentation and decoding.

A text is a lattice of pieces.  Forward Viterbi gives the best score up to every place;
these scores are exact heuristics for a backward A-star search: a partial path is worth exactly what its
best completion is.  So complete paths are found in falling order of score, the first N
are the N best, and no more than N open paths need to be kept.

No piece of the vocabulary has a space mark behind another character or holds a line
feed, and some punctuation stands beside a letter in none (``Pieces.before`` and
``Pieces.after``, worked out from the vocabulary).  A text may be cut before a run of
spaces, around a run of line feeds and between a letter and such punctuation: its
segmentations are free combinations of its segments'.  Each distinct segment of the corpus is searched once; results go
to sorted tables in the shared folder, which tasks memory-map.  A text's N best combine
segments: a path among the N best leaves its segment's best only in the N - 1 segments
with the smallest gaps to their second best, so those alone are combined.  The tables hold the ids
of all N paths of a segment, so each of a text's N segmentations is put together in full.

Characters outside the vocabulary are spelled as byte pieces, each at ``BYTE_PENALTY``
below the lowest piece score.  Ties go to the smaller ids, compared from the end.
A piece's score is the one that the model file gives it; in a BPE vocabulary that is its
negative merge rank, so the best path need not be what greedy merging yields.

Cases: a text that holds U+2581, the space mark, is encoded as if it held spaces there, so its
``round_trip`` is false; null and empty texts have no pieces and one empty segmentation of score 0; a text
with fewer than N segmentations returns what there is; repeated rows are taken each on
their own; an empty table gives an empty result; further columns are not looked at.
Segments are told apart by 64-bit hashes.
"""

from __future__ import annotations

import bisect
import itertools
import re
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import hash_words, slices
from shelfwise.llm.files import mapped, save_arrays
from shelfwise.llm.lm import EliasFano
from shelfwise.session import Scratch, ship

MODEL = "piece_bpe_32k.model"
N_BEST = 4
BYTE_PENALTY = 10.0
SHARD_SEGMENTS = 150_000
SPACE = "▁"
#: Places of a text whose pieces a search remembers.
HELD_PLACES = 50_000

_vocabularies: dict[str, "Pieces"] = {}


class Branch:
    """An open path: what it falls short of the best, where it left the best path on its way from the end, and its place.

    A turn is (place, ids of its piece, ids that the best path has there), so two paths of one shortfall are told apart
    from the end without their pieces.
    """

    __slots__ = ("short", "turns", "start")

    def __init__(self, short: float, turns: tuple[tuple[int, tuple[int, ...], tuple[int, ...]], ...], start: int):
        self.short, self.turns, self.start = short, turns, start

    def __lt__(self, other: "Branch") -> bool:
        if self.short != other.short:
            return self.short < other.short
        for a, b in itertools.zip_longest(self.turns, other.turns, fillvalue=(-1, (), ())):
            if a[:2] != b[:2]:  # the first place where they part: one of them may still follow the best path there
                return a[1] < (b[1] if b[0] == a[0] else a[2]) if a[0] >= b[0] else b[2] < b[1]
        return False


class Pieces:
    """The vocabulary of a SentencePiece model, its lattice search and its decoder."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.names = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = {int(self.names[i][3:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.id_bytes = {i: b for b, i in self.byte_ids.items()}
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.pieces = {self.names[i]: (i, sp.get_score(i)) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece holds a space mark behind another character: segments are not independent")
        if any("\n" in p for p in self.pieces):
            raise ValueError("a piece holds a line feed: segments are not independent")
        beside = {(p[i], p[i + 1]) for p in self.pieces for i in range(len(p) - 1)}
        #: ASCII punctuation that in no piece follows a letter, and that in none precedes one.
        self.before = "".join(c for c in string.punctuation if not any(b == c and a.isalpha() for a, b in beside))
        self.after = "".join(c for c in string.punctuation if not any(a == c and b.isalpha() for a, b in beside))
        #: Every ending of a piece, with the piece if it is one.
        self.tails: dict[str, tuple[tuple[int, ...], float] | None] = {p[k:]: None for p in self.pieces for k in range(len(p))}
        self.tails |= {p: ((i,), x) for p, (i, x) in self.pieces.items()}
        spelled = [bytes([self.id_bytes[i]]) if i in self.id_bytes else self.names[i].replace(SPACE, " ").encode() for i in range(n)]
        #: The bytes that each id stands for, in a row, and where each id's begin.
        self.spelled, self.spelled_at = np.frombuffer(b"".join(spelled), np.uint8), np.cumsum([0, *map(len, spelled)])
        self.byte_score = min(s for _, s in self.pieces.values()) - BYTE_PENALTY

    def into(self, text: str, end: int) -> list[tuple[int, tuple[int, ...], float]]:
        """The pieces that end at ``end``: (start, ids, score)."""
        edges, get = [], self.tails.get
        for start in range(end - 1, -1, -1):
            got = get(text[start:end], 0)
            if got:
                edges.append((start, *got))
            elif got == 0:
                break
        if not edges or edges[0][0] != end - 1:
            raw = text[end - 1].encode("utf-8", "surrogatepass")
            edges.append((end - 1, tuple([self.byte_ids[b] for b in raw]), self.byte_score * len(raw)))
        return edges

    def search(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations of ``text`` (space marks in place): (score, ids), best first.

        Time and memory follow the text's length: of the lattice ``HELD_PLACES`` places are remembered, and an open path
        is where it leaves the best one, not its pieces.
        """
        held: dict[int, tuple[list, tuple]] = {}
        best = array("d", [0.0]) * (len(text) + 1)

        def at_place(end: int) -> tuple[list, tuple]:
            """The pieces that end here, and the one that the best path up to here takes (smaller ids on ties)."""
            if end not in held:
                if len(held) >= HELD_PLACES:
                    held.clear()
                edges = self.into(text, end)
                chosen, top = edges[0], best[edges[0][0]] + edges[0][2]
                for edge in edges[1:]:
                    x = best[edge[0]] + edge[2]
                    if x > top or (x == top and edge[1] < chosen[1]):
                        chosen, top = edge, x
                held[end] = edges, chosen
            return held[end]

        for j in range(1, len(text) + 1):  # forward: the best score up to j
            chosen = at_place(j)[1]
            best[j] = best[chosen[0]] + chosen[2]
        found: list[tuple[float, tuple[int, ...]]] = []
        open_paths = [Branch(0.0, (), len(text))]
        while open_paths and len(found) < n:
            path = open_paths.pop(0)
            room, at = n - len(found) - 1, path.start
            while at:
                edges, chosen = at_place(at)
                for edge in edges if room else ():
                    if edge is not chosen:
                        x = path.short + best[at] - best[edge[0]] - edge[2]
                        if len(open_paths) < room or x <= open_paths[-1].short:
                            bisect.insort(open_paths, Branch(x, (*path.turns, (at, edge[1], chosen[1])), edge[0]))
                            del open_paths[room:]
                at = chosen[0]
            turns, pieces, at = {a: ids for a, ids, _ in path.turns}, [], len(text)
            while at:  # the pieces of the path, from the end: its own where it turns, else the best ones
                edges, chosen = at_place(at)
                if at in turns:
                    chosen = next(e for e in edges if e[1] == turns[at])
                pieces.append(chosen[1])
                at = chosen[0]
            found.append((best[-1] - path.short, tuple([k for ids in reversed(pieces) for k in ids])))
        return found

    def decode(self, ids: list[int]) -> str:
        """The text of a whole text's ids; the leading space of the dummy prefix goes."""
        text = self.spell(ids)
        return text[1:] if text.startswith(" ") else text

    def decode_all(self, ids: np.ndarray, cuts: np.ndarray) -> list[bytes]:
        """The texts (UTF-8) of many texts' ids in a row, text k's from ``cuts[k]`` to ``cuts[k + 1]``."""
        begin = self.spelled_at[ids]
        size = self.spelled_at[ids + 1] - begin
        raw = self.spelled[_ranges(begin, size)].tobytes()
        at = np.concatenate(([0], np.cumsum(size)))[cuts].tolist()
        return [raw[a + 1 : b] if raw[a : a + 1] == b" " and a < b else raw[a:b] for a, b in zip(at[:-1], at[1:])]

    def spell(self, ids: list[int] | tuple[int, ...]) -> str:
        raw = b"".join(bytes([self.id_bytes[i]]) if i in self.id_bytes else self.names[i].encode() for i in ids)
        return raw.decode("utf-8", "surrogatepass").replace(SPACE, " ")


def vocabulary(path: str) -> Pieces:
    if path not in _vocabularies:
        _vocabularies[path] = Pieces(path)
    return _vocabularies[path]


MARK = "\x01"


def segments_of(texts: pa.Array, pieces: Pieces) -> tuple[pa.Array, np.ndarray]:
    """Segments of all texts in a row (a space before each text is the dummy prefix), and where each text's begin."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    full = np.asarray(pc.greater(pc.binary_length(texts), 0))
    marked = pc.binary_join_element_wise(" ", texts, "")
    before, after = (f"[{re.escape(c)}]" if c else r"[^\s\S]" for c in (pieces.before, pieces.after))
    if pc.any(pc.match_substring(texts, MARK)).as_py():  # a text holds the mark itself
        import regex

        cut = regex.compile(rf"(?<=\p{{L}})(?={before})|(?<={after})(?=\p{{L}})|(?<=[^ ])(?= )|(?<=[^\n])(?=\n)|(?<=\n)(?=[^\n])", regex.V1)
        lists = pa.array([cut.split(t) for t in marked.to_pylist()], pa.list_(pa.string()))
    else:
        replace = pc.replace_substring_regex
        marked = replace(marked, rf"(\pL)({before})", rf"\1{MARK}\2")
        marked = replace(marked, rf"({after})(\pL)", rf"\1{MARK}\2")
        marked = replace(replace(marked, "\n+", rf"{MARK}\0{MARK}"), " +", rf"{MARK}\0")
        lists = pc.split_pattern(marked, MARK)
    flat, offsets = lists.flatten(), np.asarray(lists.offsets).astype(np.int64)
    offsets -= offsets[0] if len(offsets) else 0
    keep = np.asarray(pc.binary_length(flat)) > 0
    keep &= np.repeat(full, np.diff(offsets))
    return flat.filter(pa.array(keep)), np.concatenate(([0], np.cumsum(keep)))[offsets]


def combine_paths(gaps: list[list[float]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n smallest sums of one gap from each list (lists begin with 0), and which gap each takes of every list."""
    sums: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
    for g in gaps:
        sums = sorted((a + b, (*chosen, k)) for a, chosen in sums for k, b in enumerate(g))[:n]
    return sums


def combine(gaps: list[list[float]], n: int) -> list[float]:
    """The sums of ``combine_paths`` alone."""
    return [x for x, _ in combine_paths(gaps, n)]


def _nearest(gaps: np.ndarray, k: int) -> list[int]:
    """Places of the k smallest gaps in order of place; of equal ones the first."""
    if len(gaps) <= k:
        return list(range(len(gaps)))
    most = np.partition(gaps, k - 1)[k - 1]
    below = np.flatnonzero(gaps < most)
    return sorted([*below.tolist(), *np.flatnonzero(gaps == most)[: k - len(below)].tolist()])


class SegmentTable:
    def __init__(self, uri: str, bits: int):
        self.uri, self.bits = uri, bits

    def look_up(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Best score, gaps to the next best (columns), number of ids of each path (columns), where they begin, and all ids in a row."""
        order = np.argsort(hashes)
        ordered = hashes[order]
        best, gaps = np.zeros(len(hashes)), np.zeros((len(hashes), n - 1))
        count, ids = np.zeros((len(hashes), n), np.int64), []
        shards = (ordered >> np.uint64(64 - self.bits)).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)] if len(shards) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            at = order[a:b]
            level = mapped(f"{self.uri}/segments-{int(shards[a])}")
            place, same = EliasFano.of(level, "hash").successor(ordered[a:b] & np.uint64((1 << (64 - self.bits)) - 1))
            if not same.all():
                raise KeyError("a segment is missing from the table")
            best[at], gaps[at] = level["best"][place], level["gaps"].reshape(-1, n - 1)[place]
            edges = level["starts"][place[:, None] * n + np.arange(n + 1)].astype(np.int64)
            count[at] = np.diff(edges, axis=1)
            ids.append(level["ids"][_ranges(edges[:, 0], edges[:, -1] - edges[:, 0])])
        flat = np.concatenate(ids) if ids else np.empty(0, "<u4")
        sizes = count[order].ravel()
        begins = np.empty((len(hashes), n), np.int64)
        begins[order] = (np.cumsum(sizes) - sizes).reshape(-1, n)
        return best, gaps, count, begins, flat


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0] .. begin[0]+size[0]-1, begin[1] .. and so on, in a row."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - size), size)


def build_table(texts: DataFrame, scratch: Scratch, model_path: str, n: int) -> SegmentTable:
    """Search every distinct segment of ``texts`` (text) once."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            flat = segments_of(batch.column("text"), vocabulary(model_path))[0]
            met, first = np.unique(hash_words(flat), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(met.view(np.int64)), flat.take(pa.array(first))], ["h", "segment"])

    segments = scratch.table(texts.mapInArrow(distinct, "h long, segment string").distinct(), "segments")
    bits = max(3, int(np.ceil(np.log2(max(1, segments.count()) / SHARD_SEGMENTS))))
    table = SegmentTable(scratch.path("table"), bits)

    def search(group: pa.Table) -> pa.Table:
        pieces = vocabulary(model_path)
        h = group.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        h, words = h[order], group.column("segment").take(pa.array(order)).to_pylist()
        best, gaps, starts, ids = np.zeros(len(h)), np.full((len(h), n - 1), np.inf), [0], array("I")
        for k, word in enumerate(words):
            found = pieces.search(word.replace(" ", SPACE), n)
            best[k] = found[0][0]
            gaps[k, : len(found) - 1] = [found[0][0] - f[0] for f in found[1:]]
            for j in range(n):  # the ids of path j of segment k begin at starts[k * n + j]
                ids.extend(found[j][1] if j < len(found) else ())
                starts.append(len(ids))
        shard = int(h[0] >> np.uint64(64 - bits))
        arrays = EliasFano.build(h & np.uint64((1 << (64 - bits)) - 1)).arrays("hash")
        arrays |= {"best": best, "gaps": gaps.ravel(), "starts": np.asarray(starts, np.uint32), "ids": np.asarray(ids, "<u4")}
        save_arrays(f"{table.uri}/segments-{shard}", arrays)
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(h)], pa.int64())})

    keyed = segments.withColumn("shard", F.shiftrightunsigned("h", 64 - bits))
    keyed.groupBy("shard").applyInArrow(search, "shard int, n long").agg(F.sum("n")).collect()
    return table


def encode_nbest(docs: DataFrame, model_path: str, n: int = N_BEST, with_ids: bool = True) -> DataFrame:
    """doc_id, n_pieces, scores (the n best, falling), ids_crc32, paths_crc32, round_trip; if asked for, ids and paths.

    ``paths`` holds the ids of the n best segmentations, in the order of ``scores``; ``ids``
    and ``n_pieces`` are of the best.  ``ids_crc32`` and ``paths_crc32`` are of ids as
    little-endian unsigned 32-bit numbers; ``round_trip`` tells whether decoding the text's
    whole list of ids gives the text.
    """
    if n < 2:
        raise ValueError("n must be at least 2")
    ship(docs.sparkSession)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    table = build_table(texts.where("text is not null").select("text"), Scratch(docs.sparkSession, "nbest"), model_path, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            flat, starts = segments_of(batch.column("text"), vocabulary(model_path))
            met, use = np.unique(hash_words(flat), return_inverse=True)
            best, gaps, count, begins, ids = table.look_up(met, n)
            size = count[:, 0][use]
            ends = np.concatenate(([0], np.cumsum(size)))
            every = ids[_ranges(begins[:, 0][use], size)]
            tops = np.diff(np.concatenate(([0], np.cumsum(best[use])))[starts])
            first = gaps[:, 0][use]
            scores, crc, paths = [], [], []
            for d, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
                near = [a + k for k in _nearest(first[a:b], n - 1)]
                found = combine_paths([[0.0, *(g for g in gaps[use[k]].tolist() if g < np.inf)] for k in near], n)
                top, whole = float(tops[d]), every[ends[a] : ends[b]].tobytes()
                scores.append([top - x for x, _ in found])
                own = []
                for _, chosen in found:
                    parts, at = [], 0
                    for k, j in zip(near, chosen):
                        if j:
                            begin, k_at = begins[use[k], j], int(ends[k] - ends[a]) * 4
                            parts += [whole[at:k_at], ids[begin : begin + count[use[k], j]].tobytes()]
                            at = int(ends[k + 1] - ends[a]) * 4
                    own.append(b"".join([*parts, whole[at:]]) if parts else whole)
                crc.append([zlib.crc32(x) for x in own])
                if with_ids:
                    paths.append([np.frombuffer(x, "<u4").astype(np.int32) for x in own])
            cuts = ends[starts]
            texts_ = pc.fill_null(batch.column("text").cast(pa.binary()), b"").to_pylist()
            whole = [x == y for x, y in zip(vocabulary(model_path).decode_all(every.astype(np.int64), cuts), texts_)]
            columns = [batch.column("doc_id"), pa.array(np.diff(cuts)), pa.array(scores, pa.list_(pa.float64())), pa.array([c[0] for c in crc], pa.int64()), pa.array(crc, pa.list_(pa.int64())), pa.array(whole, pa.bool_())]
            names = ["doc_id", "n_pieces", "scores", "ids_crc32", "paths_crc32", "round_trip"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(every.astype(np.int32))))
                columns.append(pa.array(paths, pa.list_(pa.list_(pa.int32()))))
                names += ["ids", "paths"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, n_pieces long, scores array<double>, ids_crc32 long, paths_crc32 array<long>, round_trip boolean" + (", ids array<int>, paths array<array<int>>" if with_ids else ""))


def decode(encoded: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """doc_id and the text that its ids (array<int>) stand for; null ids give null."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            cuts = np.concatenate(([0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0))))).astype(np.int64)
            made = vocabulary(model_path).decode_all(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), cuts)
            texts = [t.decode("utf-8", "replace") if ok else None for t, ok in zip(made, lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", F.col(ids).alias("ids")).mapInArrow(run, f"doc_id {kind}, text string")
