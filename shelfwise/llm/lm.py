"""N-gram language model in an Elias-Fano trie.

Levels are files in the shared folder, cut into shards; tasks memory-map them.
  words     sorted 64-bit word hashes (Elias-Fano) with exact counts; a word's id is its rank;
  bigrams   for each context word: a monotone pointer to its successors, the successors'
            ids as one monotone sequence (each context starts where the last one ended),
            quantised discounted probabilities, and the quantised weight left for the
            lower order;
  trigrams  the same, with bigram ranks as contexts.
A gram is found by a successor search for the context's base plus the word id.

Smoothing is interpolated absolute discounting.  For a context u seen c(u) times,
P(w|u) = (c(u,w) - D) / c(u) + g(u) * P(w|shorter), where g(u) is all that the kept
successors leave.  Lowest order: (c(w) - D) / N for known words, D * V / N for any
unknown word.  Quantising rounds down, so a context's probabilities never sum to over 1.
Grams of two words or more seen fewer than ``least`` times (by default none) are left out;
their mass is part of g.

Tasks send sorted, delta-coded blobs of counts per shard, so each gram crosses the
network at most once per task and no gram is hot.  Shard sizes follow from the number of
tokens, which the first pass counts.  Contexts are numbered within their shard, counts
have 64 bits, and where contexts and words need over 64 bits together they are sorted as
pairs, so no size is too large.  Where shards begin is noted in files, which tasks map for
the shards that they meet.  Words are told apart by 64-bit hashes.

Cases: null and empty texts are one end token; repeated rows are scored, and counted,
each on their own; rows with a null doc_id are not held out; with nothing to learn from
all scores equal the base score; an empty table gives an empty result; further columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import hash_words, slices, words_of
from shelfwise.llm.files import mapped, save_arrays
from shelfwise.session import Scratch, ship

#: Documents per shard of words.
SHARD_DOCS = 4_000
DISCOUNT = (0.5, 0.6, 0.6)
MIN_COUNT = 1
#: Tokens per shard of a gram level, and counts that a task gathers before it sends them.
SHARD_TOKENS, GATHER = 3_000_000, 2_000_000
#: Shards whose places are noted in one file.
GROUP = 4096
#: Steps per factor of ten of a quantised probability.
STEPS = 4000
END_HASH = np.uint64(0x5EED_0F_E4D0_0001)

_nth = np.full((256, 8), 8, np.uint8)
for _b in range(256):
    for _k, _i in enumerate(i for i in range(8) if _b >> i & 1):
        _nth[_b, _k] = _i
_ODD, _PAIRS, _NIBBLES, _LOW, _HIGH = (np.uint64(int(x * 8, 16)) for x in ("55", "33", "0f", "01", "80"))
_1, _2, _4, _8, _56, _255 = map(np.uint64, (1, 2, 4, 8, 56, 255))


def _nth_bit(words: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th one (from 0) of each 64-bit word, which has more than r."""
    r = r.astype(np.uint64)
    s = words - ((words >> _1) & _ODD)
    s = (s & _PAIRS) + ((s >> _2) & _PAIRS)
    s = ((s + (s >> _4)) & _NIBBLES) * _LOW  # byte i: ones up to byte i
    shift = np.bitwise_count(((r * _LOW | _HIGH) - s) & _HIGH).astype(np.uint64) * _8
    before = ((s << _8) >> shift) & _255
    return (shift + _nth[(words >> shift) & _255, (r - before).astype(np.int64)]).astype(np.int64)


class EliasFano:
    """A monotone sequence of 64-bit integers: packed low bits, unary high bits, counts of ones and zeros per 64 bits."""

    FIELDS = ("low", "high", "ones", "zeros")

    def __init__(self, n: int, shift: int, **fields: np.ndarray):
        self.n, self.shift = n, shift
        self.low, self.high, self.ones, self.zeros = (fields[f] for f in self.FIELDS)

    @staticmethod
    def build(values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        shift = max(0, min(57, (max(1, top // max(1, n))).bit_length() - 1))
        heads = (values >> np.uint64(shift)).astype(np.int64)
        bits = np.zeros((n + (int(heads[-1]) if n else 0) + 2 + 63) // 64 * 64, np.uint8)
        bits[heads + np.arange(n)] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        per = bits.reshape(-1, 64).sum(axis=1, dtype=np.int64)
        ones = np.cumsum(per) - per
        low = np.zeros(n * shift // 64 + 2, np.uint64)
        if shift and n:
            rest = values & np.uint64((1 << shift) - 1)
            at = np.arange(n, dtype=np.int64) * shift
            word, off = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(low, word, rest << off)
            over = np.flatnonzero((at & 63) + shift > 64)
            np.bitwise_or.at(low, word[over] + 1, rest[over] >> (np.uint64(64) - off[over]))
        return EliasFano(n, shift, low=low, high=high, ones=ones.astype(np.uint32), zeros=(np.arange(len(per)) * 64 - ones).astype(np.uint32))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.shift:
            return np.zeros(len(i), np.uint64)
        at = i * self.shift
        word, off = at >> 6, (at & 63).astype(np.uint64)
        spill = np.where(off == 0, np.uint64(0), self.low[word + 1] << ((np.uint64(64) - off) & np.uint64(63)))
        return (self.low[word] >> off | spill) & np.uint64((1 << self.shift) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """Values at the places ``i``."""
        word = np.searchsorted(self.ones, i.astype(self.ones.dtype), side="right") - 1
        bit = word * 64 + _nth_bit(self.high[word], i - self.ones[word])
        return ((bit - i).astype(np.uint64) << np.uint64(self.shift)) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first value >= x (n if there is none), and whether it is x."""
        place = np.full(len(x), self.n, np.int64)
        same = np.zeros(len(x), bool)
        if not self.n:
            return place, same
        head = (x >> np.uint64(self.shift)).astype(np.int64)
        inside = np.flatnonzero(head < len(self.high) * 64 - self.n)
        head, low = head[inside], x[inside] & np.uint64((1 << self.shift) - 1)
        lo, hi = self._ones_before(head - 1), self._ones_before(head)
        end = hi.copy()
        work = np.flatnonzero(lo < hi)
        while len(work):
            mid = (lo[work] + hi[work]) >> 1
            less = self._low(mid) < low[work]
            lo[work] = np.where(less, mid + 1, lo[work])
            hi[work] = np.where(less, hi[work], mid)
            work = work[lo[work] < hi[work]]
        found = np.flatnonzero(lo < end)
        equal = found[self._low(lo[found]) == low[found]]
        place[inside] = lo
        same[inside[equal]] = True
        return place, same

    def _ones_before(self, h: np.ndarray) -> np.ndarray:
        """Number of values whose high part is at most ``h``."""
        out = np.zeros(len(h), np.int64)
        at = np.flatnonzero(h >= 0)
        want = h[at]
        word = np.searchsorted(self.zeros, want.astype(self.zeros.dtype), side="right") - 1
        bit = word * 64 + _nth_bit(~self.high[word], want - self.zeros[word])
        out[at] = bit - want
        return out

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.{f}": getattr(self, f) for f in self.FIELDS} | {f"{name}.meta": np.asarray([self.n, self.shift], np.int64)}

    @staticmethod
    def of(level: dict[str, np.ndarray], name: str) -> "EliasFano":
        n, shift = level[f"{name}.meta"].tolist()
        return EliasFano(n, shift, **{f: level[f"{name}.{f}"] for f in EliasFano.FIELDS})


# ---- counting ------------------------------------------------------------------------


def _order(context: np.ndarray, word: np.ndarray, bits: int) -> np.ndarray:
    """Order by (context, word), words having ``bits`` bits."""
    if not len(context):
        return np.empty(0, np.int64)
    if int(context.max()).bit_length() + bits <= 64:
        return np.argsort(context.astype(np.uint64) << np.uint64(bits) | word if bits < 64 else word, kind="stable")
    return np.lexsort((word, context))


def distinct_pairs(context: np.ndarray, word: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (context, word) in order, and for each row its place among them."""
    if len(context) and int(context.max()).bit_length() + bits <= 64:
        keys, back = np.unique(context.astype(np.uint64) << np.uint64(bits) | word, return_inverse=True)
        return (keys >> np.uint64(bits)).astype(np.int64), keys & np.uint64((1 << bits) - 1), back
    order = _order(context, word, bits)
    first = _firsts(context[order], word[order])
    back = np.empty(len(order), np.int64)
    back[order] = np.cumsum(first) - 1
    return context[order][first], word[order][first], back


def _firsts(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """True where a pair differs from the one before it."""
    new = np.ones(len(context), bool)
    new[1:] = (context[1:] != context[:-1]) | (word[1:] != word[:-1])
    return new


def sum_pairs(context: np.ndarray, word: np.ndarray, counts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (context, word) in order with the sums of their counts."""
    order = _order(context, word, bits)
    context, word = context[order], word[order]
    first = np.flatnonzero(_firsts(context, word))
    return context[first], word[first], np.add.reduceat(counts[order], first) if len(first) else counts[order]


class Gatherer:
    """Counts of (context, word), sent as one blob per shard whenever many have gathered.

    ``split`` gives each context's shard and its number within the shard.
    """

    def __init__(self, split: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], bits: int, limit: int):
        self.split, self.bits, self.limit, self.parts, self.size = split, bits, limit, [], 0

    def _sum(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return sum_pairs(*(np.concatenate([p[j] for p in self.parts]) for j in range(3)), self.bits)

    def add(self, context: np.ndarray, word: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(context) and int(context.max()).bit_length() + self.bits <= 64:
            keys, counts = np.unique(context.astype(np.uint64) << np.uint64(self.bits) | word, return_counts=True)
            found = (keys >> np.uint64(self.bits)).astype(np.int64), keys & np.uint64((1 << self.bits) - 1), counts
        else:
            found = sum_pairs(context, word, np.ones(len(word), np.int64), self.bits)
        self.parts.append(found)
        self.size += len(found[0])
        if self.size > self.limit:
            self.parts = [self._sum()]
            self.size = len(self.parts[0][0])
            if self.size > self.limit // 2:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        context, word, counts = self._sum()
        self.parts, self.size = [], 0
        shards, inner = self.split(context)
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield pa.RecordBatch.from_arrays([pa.array([shards[a]], pa.int64()), pa.array([pack_counts(inner[a:b], word[a:b], counts[a:b])], pa.binary())], ["shard", "blob"])


def _planes(x: np.ndarray) -> bytes:
    """The bytes of unsigned numbers, as many as the largest needs, byte by byte; the width first."""
    width = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
    return bytes([width]) + np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T[:width]).tobytes()


def _unplaned(raw: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    width = raw[at]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, width * n, at + 1).reshape(width, n).T
    return out.view("<u8").ravel(), at + 1 + width * n


def pack_counts(context: np.ndarray, word: np.ndarray, counts: np.ndarray) -> bytes:
    """Pairs in order as differences: of contexts, and of the words of one context; and counts; compressed."""
    import zstandard

    steps = np.diff(context, prepend=0)
    gaps = word.copy()
    same = np.flatnonzero(steps[1:] == 0) + 1
    gaps[same] -= word[same - 1]
    return zstandard.ZstdCompressor(level=1).compress(len(word).to_bytes(8, "little") + _planes(steps) + _planes(gaps) + _planes(counts))


def unpack_counts(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at = int.from_bytes(raw[:8], "little"), 8
    steps, at = _unplaned(raw, at, n)
    gaps, at = _unplaned(raw, at, n)
    counts, at = _unplaned(raw, at, n)
    first = np.flatnonzero((steps > 0) | (np.arange(n) == 0))
    sums = np.cumsum(gaps, dtype=np.uint64)  # wraps, and unwraps below
    before = np.repeat(sums[first] - gaps[first], np.diff(np.append(first, n)))
    return np.cumsum(steps).astype(np.int64), sums - before, counts.astype(np.int64)


def _merged(table: pa.Table, bits: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    parts = [unpack_counts(b) for b in table.column("blob").to_pylist()]
    return table.column("shard")[0].as_py(), *sum_pairs(*(np.concatenate([p[j] for p in parts]) for j in range(3)), bits)


def quantised(p: np.ndarray) -> np.ndarray:
    """Steps below one on a logarithmic scale, rounded so that the value never grows."""
    return np.minimum(np.ceil(-np.log10(np.maximum(p, 1e-300)) * STEPS - 1e-9), 65535).astype(np.uint16)


_value = 10.0 ** (-np.arange(65536) / STEPS)


# ---- the trie ------------------------------------------------------------------------


class Trie:
    """Reads the levels; everything takes and gives arrays.

    ``info`` is small: of each level's shards only the number and, for every ``GROUP`` of
    them, the rank of the first entry are in it; the rest is in files of the shared folder.
    """

    def __init__(self, uri: str, info: dict):
        self.uri, self.info = uri, info

    def set_words(self, n: int, total: int) -> None:
        self.info |= {"V": n, "N": total, "word_bits": _word_bits(n), "ids": _ids_type(n)}

    def _starts(self, order: int, group: int) -> np.ndarray:
        """Ranks of the first entries of a group's shards (one more at the end)."""
        groups = self.info[f"groups{order}"]
        if groups[group] == groups[group + 1]:
            return np.full(self.info["group"] + 1, groups[group], np.int64)
        return mapped(f"{self.uri}/starts{order}-{group}")["starts"]

    def span(self, order: int, shard: int) -> tuple[int, int]:
        """Ranks of a shard's entries: first, and one past the last."""
        group, at = divmod(shard, self.info["group"])
        starts = self._starts(order, group)
        return int(starts[at]), int(starts[at + 1])

    def shard_at(self, order: int, rank: int) -> int:
        """The shard that holds an entry."""
        group = int(np.searchsorted(self.info[f"groups{order}"], rank, side="right")) - 1
        return group * self.info["group"] + int(np.searchsorted(self._starts(order, group), rank, side="right")) - 1

    def words(self, shard: int) -> dict[str, np.ndarray]:
        return mapped(f"{self.uri}/words-{shard}")

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of word hashes; -1 for unknown words."""
        bits = self.info["bits"]
        order = np.argsort(hashes)
        ordered = hashes[order]
        shards = (ordered >> np.uint64(64 - bits)).astype(np.int64)
        out = np.full(len(hashes), -1, np.int64)
        for s, a, b in _stretches(shards):
            first, last = self.span(1, s)
            if first < last:
                place, same = EliasFano.of(self.words(s), "hash").successor(ordered[a:b] & np.uint64((1 << (64 - bits)) - 1))
                out[order[a:b]] = np.where(same, place + first, -1)
        return out

    def word_counts(self, ids: np.ndarray) -> np.ndarray:
        """Exact counts of word ids; 0 for -1."""
        distinct, back = np.unique(ids, return_inverse=True)
        out, at = np.zeros(len(distinct), np.int64), int(np.searchsorted(distinct, 0))
        while at < len(distinct):
            s = self.shard_at(1, int(distinct[at]))
            first, last = self.span(1, s)
            to = int(np.searchsorted(distinct, last))
            out[at:to] = self.words(s)["counts"][distinct[at:to] - first]
            at = to
        return out[back]

    def counts_of(self, order: int, first: int, last: int) -> np.ndarray:
        """Exact counts of the grams with ranks first..last-1, while the trie is built."""
        parts, at = [np.empty(0, np.int64)], first
        while at < last:
            s = self.shard_at(order, at)
            begin, end = self.span(order, s)
            to = min(end, last)
            held = self.words(s)["counts"] if order == 1 else wide_counts(mapped(f"{self.uri}/counts{order}/{s}"))
            parts.append(held[at - begin : to - begin].astype(np.int64))
            at = to
        return np.concatenate(parts)

    def split(self, order: int) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Shards of contexts of an order, and the contexts' numbers within them."""
        n, shards = self.info[f"contexts{order}"], self.info[f"shards{order}"]

        def of(context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            shard = ((context + 1) * shards - 1) // max(1, n)
            return shard, context - n * shard // shards

        return of

    def edges(self, order: int, shard: int) -> tuple[int, int]:
        """First context of a shard, and of the next."""
        n, shards = self.info[f"contexts{order}"], self.info[f"shards{order}"]
        return n * shard // shards, n * (shard + 1) // shards

    def find(self, order: int, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For distinct (context, word) in order: rank of the gram or -1, its discounted probability (0 if it is not kept), the context's weight."""
        rank, prob, weight = np.full(len(word), -1, np.int64), np.zeros(len(word)), np.ones(len(word))
        shards, inner = self.split(order)(context)
        for s, a, b in _stretches(shards):
            first, last = self.span(order, s)
            if first == last:
                continue
            level = mapped(f"{self.uri}/grams{order}-{s}")
            pointers, values = EliasFano.of(level, "pointers"), EliasFano.of(level, "values")
            new = np.ones(b - a, bool)
            new[1:] = inner[a + 1 : b] != inner[a : b - 1]
            at, back = inner[a:b][new], np.cumsum(new) - 1
            begin, end = pointers[at].astype(np.int64), pointers[at + 1].astype(np.int64)
            base = np.zeros(len(at), np.uint64)
            later = begin > 0
            base[later] = values[begin[later] - 1] + np.uint64(1)
            weight[a:b] = _value[level["weights"][at]][back]
            some = np.flatnonzero((begin < end)[back])
            owner = back[some]
            place, same = values.successor(base[owner] + word[a:b][some])
            hit = same & (place < end[owner])
            rank[a + some[hit]] = place[hit] + first
            prob[a + some[hit]] = _value[level["probs"][place[hit]]]
        return rank, prob, weight

    def look_up(self, order: int, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``find`` for any pairs; a context of -1 has no grams and weight 1, a word of -1 no probability."""
        rank, prob, weight = np.full(len(word), -1, np.int64), np.zeros(len(word)), np.ones(len(word))
        at = np.flatnonzero(context >= 0)
        if len(at):
            unknown = self.info["V"]
            w = np.where(word[at] >= 0, word[at], unknown).astype(np.uint64)
            contexts, words, back = distinct_pairs(context[at], w, self.info["word_bits"])
            r, p, g = self.find(order, contexts, words)
            r[words == unknown], p[words == unknown] = -1, 0
            rank[at], prob[at], weight[at] = r[back], p[back], g[back]
        return rank, prob, weight


def _stretches(shards: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Each shard met, with the first place of its stretch and the place behind its last, from shards in order."""
    if len(shards):
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield int(shards[a]), a, b


def narrow_counts(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Counts as bytes, and those of 255 or more apart."""
    large = np.flatnonzero(counts >= 255)
    return {"small": np.minimum(counts, 255).astype(np.uint8), "places": large, "large": counts[large].astype(np.uint64)}


def wide_counts(level: dict[str, np.ndarray]) -> np.ndarray:
    out = level["small"].astype(np.int64)
    out[level["places"]] = level["large"].astype(np.int64)
    return out


def _build_words(uri: str, bits: int) -> Callable[[pa.Table], pa.Table]:
    def build(table: pa.Table) -> pa.Table:
        shard, _, low, counts = _merged(table, 64 - bits)
        save_arrays(f"{uri}/words-{shard}", EliasFano.build(low).arrays("hash") | {"counts": counts.astype(np.uint64)})
        return _built(shard, len(low), int(counts.sum()))

    return build


def _built(shard: int, n: int, total: int) -> pa.Table:
    return pa.table({c: pa.array([x], pa.int64()) for c, x in (("shard", shard), ("n", n), ("total", total))})


def _build_grams(trie: Trie, order: int, last_order: bool, least: int = MIN_COUNT) -> Callable[[pa.Table], pa.Table]:
    discount = DISCOUNT[min(order, len(DISCOUNT)) - 1]

    def build(table: pa.Table) -> pa.Table:
        shard, context, word, counts = _merged(table, trie.info["word_bits"])
        seen = len(word)
        keep = counts >= least
        context, word, counts = context[keep], word[keep], counts[keep]
        first, last = trie.edges(order, shard)
        pointers = np.searchsorted(context, np.arange(last - first + 1))
        begins = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(word) else np.empty(0, np.int64)
        ends = np.concatenate((begins[1:], [len(word)])).astype(np.int64) if len(word) else begins
        jumps = word[ends - 1] + np.uint64(1) if len(word) else word
        base = np.cumsum(jumps, dtype=np.uint64) - jumps
        values = word + np.repeat(base, ends - begins)
        above = trie.counts_of(order - 1, first, last)
        p = (counts - discount) / np.maximum(above[context], 1)
        taken = np.bincount(context, weights=p, minlength=last - first)
        arrays = EliasFano.build(pointers.astype(np.uint64)).arrays("pointers") | EliasFano.build(values).arrays("values")
        save_arrays(f"{trie.uri}/grams{order}-{shard}", arrays | {"probs": quantised(p), "weights": quantised(np.clip(1 - taken, 1e-16, 1))})
        if not last_order:
            save_arrays(f"{trie.uri}/counts{order}/{shard}", narrow_counts(counts))
        return _built(shard, len(word), seen)

    return build


BUILT, BLOBS = "shard long, n long, total long", "shard long, blob binary"


def _level(trie: Trie, scratch: Scratch, order: int, shards: int, blobs: DataFrame, build: Callable[[pa.Table], pa.Table]) -> tuple[int, int]:
    """Build a level's shards and note where each one's entries begin; number of entries, and of what they count."""
    built, size, uri = blobs.groupBy("shard").applyInArrow(build, BUILT), trie.info["group"], trie.uri
    if shards <= size:  # one group: its few rows need no table and no further jobs
        rows = built.collect()
        sizes = np.zeros(size, np.int64)
        for r in rows:
            sizes[r.shard] = r.n
        save_arrays(f"{uri}/starts{order}-0", {"starts": np.concatenate(([0], np.cumsum(sizes)))})
        trie.info[f"groups{order}"] = [0, int(sizes.sum())]
        return int(sizes.sum()), sum(r.total for r in rows)
    built = scratch.table(built, f"built{order}")
    of = F.floor(F.col("shard") / size).alias("group")
    sums = {r.group: (r.n, r.total) for r in built.groupBy(of).agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()}
    groups = [0, *np.cumsum([sums.get(g, (0, 0))[0] for g in range(-(-shards // size))]).tolist()]

    def note(table: pa.Table) -> pa.Table:
        group, sizes = table.column("group")[0].as_py(), np.zeros(size, np.int64)
        sizes[table.column("shard").to_numpy() - group * size] = table.column("n").to_numpy()
        save_arrays(f"{uri}/starts{order}-{group}", {"starts": groups[group] + np.concatenate(([0], np.cumsum(sizes)))})
        return table.select(["group"]).slice(0, 1)

    built.select("shard", "n", of).groupBy("group").applyInArrow(note, "group long").collect()
    trie.info[f"groups{order}"] = groups
    return groups[-1], sum(t for _, t in sums.values())


def _ids_type(v: int) -> str:
    """How ids of v words are stored."""
    return "<i4" if v < 1 << 31 else "<i8"


def _word_bits(v: int) -> int:
    """Bits of a word id, the unknown word's included."""
    return (v + 1).bit_length()


def _with_context(batch: pa.RecordBatch, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' ids in a row, the ids before them (the end token's before a first one), and where texts begin."""
    column = batch.column("ids")
    raw = np.frombuffer(b"".join(column.to_pylist()), kind).astype(np.int64)
    lengths = pa.compute.binary_length(column).to_numpy() // np.dtype(kind).itemsize
    starts = np.concatenate(([0], np.cumsum(lengths)))
    return raw, np.roll(raw, 1) if len(raw) else raw, starts


def train(texts: DataFrame, scratch: Scratch, max_order: int = 3, least: int = MIN_COUNT) -> tuple[Trie, DataFrame]:
    """Build the levels from the rows of ``texts`` (doc_id, text, learn) with ``learn``; also returns all rows' word ids (doc_id, learn, ids)."""
    spark = texts.sparkSession
    ship(spark)
    bits = int(np.clip(np.ceil(np.log2(max(1, texts.where("learn").count()) / SHARD_DOCS)), 3, 40))
    trie, limit = Trie(scratch.path("levels"), {"bits": bits, "group": GROUP}), GATHER

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.uint64((1 << (64 - bits)) - 1)
        gather = Gatherer(lambda c: (c, np.zeros(len(c), np.int64)), 64 - bits, limit)
        for batch in slices(batches, "text"):
            found = np.append(hash_words(words_of(batch.column("text"), lower=True)[0]), np.repeat(END_HASH, batch.num_rows))
            yield from gather.add((found >> np.uint64(64 - bits)).astype(np.int64), found & low)
        yield from gather.flush()

    blobs = texts.where("learn").select("text").mapInArrow(count_words, BLOBS)
    trie.set_words(*_level(trie, scratch, 1, 1 << bits, blobs, _build_words(trie.uri, bits)))
    kind = trie.info["ids"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = trie.word_ids(np.asarray([END_HASH]))[0]
        for batch in slices(batches, "text"):
            words, starts = words_of(batch.column("text"), lower=True)
            met, back = np.unique(hash_words(words), return_inverse=True)
            ids = trie.word_ids(met)[back]
            ids = np.insert(ids, starts[1:], end).astype(kind)
            cuts = (starts + np.arange(len(starts))) * ids.itemsize
            raw = ids.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("learn"), pa.array([raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.binary())], ["doc_id", "learn", "ids"])

    numbered = texts.select("doc_id", "learn", "text").mapInArrow(number, "doc_id long, learn boolean, ids binary")
    numbered.write.option("compression", "zstd").parquet(scratch.path("ids"))
    numbered = spark.read.schema(numbered.schema).parquet(scratch.path("ids"))
    contexts, shards = trie.info["V"], max(1, -(-trie.info["N"] // SHARD_TOKENS))
    for order in range(2, max_order + 1):
        if not contexts:
            break
        trie.info |= {f"contexts{order}": contexts, f"shards{order}": shards}

        def count(batches: Iterator[pa.RecordBatch], order: int = order) -> Iterator[pa.RecordBatch]:
            gather = Gatherer(trie.split(order), trie.info["word_bits"], limit)
            for batch in slices(batches, "ids"):
                ids, before, starts = _with_context(batch, kind)
                if order == 2:
                    context, ok = before, np.ones(len(ids), bool)
                    if least > 1:
                        often = trie.word_counts(ids) >= least
                        ok = often & np.roll(often, 1)
                else:
                    rank = trie.look_up(2, before, ids)[0]
                    context = np.roll(rank, 1)
                    ok = (rank >= 0) & (context >= 0)
                    ok[starts[:-1]] = False
                yield from gather.add(context[ok], ids[ok].astype(np.uint64))
            yield from gather.flush()

        grams = numbered.where("learn").select("ids").mapInArrow(count, BLOBS)
        contexts = _level(trie, scratch, order, shards, grams, _build_grams(trie, order, order == max_order, least))[0]
        if contexts:
            trie.info["order"] = order
        scratch.drop(f"levels/counts{order - 1}")
    return trie, numbered


def score(trie: Trie, numbered: DataFrame) -> DataFrame:
    """doc_id, learn, n_tokens, n_known, base_score, score."""
    info, kind = trie.info, trie.info["ids"]
    n, v = info["N"], info["V"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            ids, before, starts = _with_context(batch, kind)
            c = trie.word_counts(ids)
            base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
            if n:
                p = np.where(c > 0, c - DISCOUNT[0], DISCOUNT[0] * v) / n
                if info.get("order", 1) >= 2:
                    rank, prob, weight = trie.look_up(2, before, ids)
                    p = prob + weight * p
                if info.get("order", 1) >= 3:
                    context = np.roll(rank, 1)
                    context[starts[:-1]] = -1
                    _, prob, weight = trie.look_up(3, context, ids)
                    p = prob + weight * p
                model = np.log10(np.minimum(p, 1.0))
            else:
                model = base
            at = starts[:-1]
            total = lambda x: np.add.reduceat(x, at)  # noqa: B023, E731
            columns = [np.diff(starts), total((c > 0).astype(np.int64)), total(base), total(model)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("learn"), *map(pa.array, columns)], ["doc_id", "learn", "n_tokens", "n_known", "base_score", "score"])

    return numbered.mapInArrow(run, "doc_id long, learn boolean, n_tokens long, n_known long, base_score double, score double")


def train_and_score(docs: DataFrame, learn: F.Column, max_order: int = 3, least: int = MIN_COUNT) -> DataFrame:
    """Score every row of ``docs`` with a model of those where ``learn`` holds and of its grams seen ``least`` times; train_tokens is the number of tokens learned from."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), learn.alias("learn"))
    scratch = Scratch(docs.sparkSession, "lm")
    trie, numbered = train(texts, scratch, max_order, least)
    return score(trie, numbered).withColumn("train_tokens", F.lit(trie.info["N"]).cast("long"))
