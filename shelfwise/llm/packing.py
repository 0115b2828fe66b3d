"""Packing by power-of-two decomposition.

A document's token ids (with the end id) are cut into pieces whose lengths are the
binary digits of its length: as many pieces of ``max_len`` as fit, then falling powers
of two.  Each piece is a sequence of its own and goes to the bucket of its length, so
no sequence holds two documents and none needs padding: every length is a power of two.

The plan has no shuffle.  Sequence ids are Spark's monotonically increasing ids over
the pieces; they do not depend on which executor runs a task or how often.

Cases: null and empty texts are one piece holding the end id; null doc_ids stay null;
repeated rows are packed each on their own; very long texts have many ``max_len``
pieces; an empty table gives no pieces; further columns are not looked at.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import hash_words, slices, words_of
from shelfwise.session import ship

TOKENIZER = "word_bpe_49k.json"
MAX_LEN = 2048
END_ID = 1
#: Words whose ids a Python worker remembers.
CACHE_WORDS = 800_000

#: Marks and letters that a space may part before the tokenizer does; each is proved with the tokenizer at hand (``parted``).
MARKS = ".,!?;:"
LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and (c.isascii() or c >= "\xc0"))

_encoders: dict[str, "WordEncoder"] = {}


def parted(tokenizer) -> str:
    """The letters of ``LETTERS`` that the tokenizer parts from every mark on either side, whatever stands beyond.

    A letter that it takes for more than a letter (a capital I with a dot, which it lowers to an i and a combining dot
    that joins the mark behind it) is left out, and keeps its place inside its word.
    """
    cases = [(c, x, y) for c in LETTERS for m in MARKS for b in ("", "a", "\u0301") for x, y in ((b + c, m), (c, m + b), (b + m, c), (m, c + b))]
    ids = [e.ids for e in tokenizer.encode_batch_fast([t for _, x, y in cases for t in (x + y, f"{x} {y}")], add_special_tokens=False)]
    bad = {c for k, (c, _, _) in enumerate(cases) if ids[2 * k] != ids[2 * k + 1]}
    return "".join(c for c in LETTERS if c not in bad)


class WordEncoder:
    """Ids of words.  The tokenizer drops white space and never joins what it parts, so words stand alone.

    Words are told apart by 64-bit hashes; the ids of those met last are remembered in
    arrays, sorted by hash.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        letters, mark = parted(self.tokenizer), f"([{re.escape(MARKS)}])"
        letter = "([" + "".join(rf"\x{{{ord(c):X}}}" for c in letters) + "])" if letters else r"([^\s\S])"
        self.letter_mark, self.mark_letter = letter + mark, mark + letter
        self.limit = limit
        self.keys, self.begin, self.count = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Remember the ids of words that are not known; the older half of too many goes first."""
        if len(self.keys) + len(keys) > self.limit and len(self.keys):
            cut = int(np.median(self.begin))
            young = self.begin >= cut
            self.flat, self.keys, self.begin, self.count = self.flat[cut:], self.keys[young], self.begin[young] - cut, self.count[young]
        ids, count = array("I"), []
        for at in range(0, len(words), 4_000):
            for e in self.tokenizer.encode_batch_fast(words[at : at + 4_000], add_special_tokens=False):
                ids.extend(e.ids)
                count.append(len(e.ids))
        counts = np.asarray(count, np.int64)
        begin = len(self.flat) + np.cumsum(counts) - counts
        self.flat = np.concatenate((self.flat, np.frombuffer(ids, np.uint32))) if ids else self.flat
        every = np.concatenate((self.keys, keys))
        order = np.argsort(every)
        self.keys, self.begin, self.count = every[order], np.concatenate((self.begin, begin))[order], np.concatenate((self.count, counts))[order]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin (one more at the end)."""
        texts = pc.replace_substring_regex(texts.cast(pa.string()), self.letter_mark, r"\1 \2")
        words, starts = words_of(pc.replace_substring_regex(texts, self.mark_letter, r"\1 \2"))
        if not len(words):
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        met, first, use = np.unique(hash_words(words), return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.keys, met), max(0, len(self.keys) - 1))
        unseen = np.flatnonzero(self.keys[place] != met) if len(self.keys) else np.arange(len(met))
        if len(unseen):
            self._learn(met[unseen], words.take(pa.array(first[unseen])).to_pylist())
            place = np.minimum(np.searchsorted(self.keys, met), len(self.keys) - 1)
            gone = np.flatnonzero(self.keys[place] != met)
            if len(gone):  # known before, but just forgotten
                self._learn(met[gone], words.take(pa.array(first[gone])).to_pylist())
                place = np.searchsorted(self.keys, met)
        each = self.count[place][use]
        ends = np.cumsum(each)
        take = np.arange(int(ends[-1])) + np.repeat(self.begin[place][use] - (ends - each), each)
        return self.flat[take], np.concatenate(([0], ends))[starts]


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def binary_pieces(n: int, max_len: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids, longest first."""
    rest = n % max_len
    return [max_len] * (n // max_len) + [1 << b for b in range(max_len.bit_length() - 2, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (if asked for), ids_crc32, doc_tokens, bucket, sequence_id, offset.

    ``bucket`` is the binary logarithm of the length; ``write_buckets`` stores sequences of
    one length together.
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in slices(batches, "text"):
            flat, starts = enc.texts(batch.column("text"))
            owner, start, length, crc, total, ids = [], [], [], [], [], []
            for d in range(batch.num_rows):
                a, b = int(starts[d]), int(starts[d + 1])
                raw, n, at = flat[a:b].astype("<u4", copy=False).tobytes() + end, b - a + 1, 0
                for size in binary_pieces(n, max_len):
                    piece = raw[at * 4 : (at + size) * 4]
                    owner.append(d)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
                    if with_ids:
                        ids.append(np.frombuffer(piece, "<i4"))
                    at += size
            columns = [batch.column("doc_id").take(pa.array(owner, pa.int64()))]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if with_ids else "")
    pieces = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(cut, schema)
    return pieces.select(
        "*",
        F.round(F.log2("length")).cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write pieces to one folder per bucket, so that a reader of a folder sees sequences of one length only."""
    pieces.write.mode("overwrite").partitionBy("bucket").parquet(path)
