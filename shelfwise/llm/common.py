"""What the operators share: text batches of bounded size, word splitting, table reading."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker looks at together; a longer text is alone.
SLICE_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(folds)


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of a piece hold about ``size`` bytes at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(at, to - at)
            at = to
        del batch
        pa.default_memory_pool().release_unused()


def words_of(texts: pa.Array, lower: bool = False) -> tuple[pa.StringArray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts in a row, and where each text's words begin (one more at the end).

    Null texts have no words.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    starts = np.asarray(lists.offsets).astype(np.int64) - int(lists.offsets[0].as_py() if len(lists.offsets) else 0)
    full = np.asarray(pc.binary_length(words)) > 0
    if not full.all():
        kept = np.concatenate(([0], np.cumsum(full)))
        words, starts = words.filter(pa.array(full)), kept[starts]
    return words, starts


def mix64(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3 (public domain), elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


#: Bytes of a word that are hashed by table.
TABLE_BYTES = 64
#: A random number for every byte at every place of a word.
_TABLE = np.random.default_rng(20_240_417).integers(0, 2**64, TABLE_BYTES * 256, dtype=np.uint64)


def hash_words(words: pa.StringArray) -> np.ndarray:
    """64-bit hash of every word, none of them null: by tabulation, all words at once (xxHash for words beyond TABLE_BYTES)."""
    import xxhash

    if not len(words):
        return np.empty(0, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    lengths, begins = np.diff(offsets), offsets[:-1] - offsets[0]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    place = np.arange(len(data), dtype=np.int32) - np.repeat(begins, lengths).astype(np.int32)
    place &= TABLE_BYTES - 1
    place <<= 8
    place |= data
    out, some = np.zeros(len(words), np.uint64), np.flatnonzero(lengths)
    if len(some):
        out[some] = np.bitwise_xor.reduceat(_TABLE[place], begins[some])
    for i in np.flatnonzero(lengths > TABLE_BYTES).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[begins[i] : begins[i] + lengths[i]].tobytes())
    return out
