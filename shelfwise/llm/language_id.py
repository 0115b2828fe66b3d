"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point.  A letter
trigram binds them: first vector rotated twice, times second rotated once, times third.
A text bundles (sums) the vectors of its trigrams; word ends count as a letter.  A
language's prototype bundles the texts known to be in it.  The prediction is the
prototype with the largest cosine, and the score that cosine, cut to 0..1.

Only sums of integer vectors, one per language and dimension, reach the driver.  Trigrams
are counted sparsely and their vectors made for ``CHUNK`` of them at once, so neither very
long texts nor many letters need much memory.

Cases: texts beyond ``PIECE`` characters are bundled in pieces that share two characters, which changes
nothing; null texts and texts without letters are ``und`` with score 0; ties go to the
smallest language name; if nothing can be learned every text is ``und``; rows without a
language teach nothing; empty tables give empty results; further columns are not looked
at by ``predict``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import slices
from shelfwise.session import ship

DIMS = 1024
SEED = 7
BATCH_BYTES, ROWS = 1 << 20, 2_000
#: Characters of text whose trigrams are worked out at once, trigrams that have a vector at once, counts held at once, letters remembered.
PIECE, CHUNK, CELLS, LETTERS_HELD = 1 << 20, 8192, 1 << 23, 20_000

_alpha: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _alpha:
        _alpha.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _alpha[0]


class Encoder:
    def __init__(self, dims: int = DIMS, seed: int = SEED):
        self.dims, self.seed, self.vectors = dims, seed, {}

    def letter(self, code: int) -> np.ndarray:
        got = self.vectors.get(code)
        if got is None:
            got = np.random.default_rng([self.seed, code]).integers(0, 2, self.dims).astype(np.float32) * 2 - 1
            self.vectors[code] = got
        return got

    def letters(self, codes: np.ndarray) -> np.ndarray:
        if len(self.vectors) > LETTERS_HELD:
            self.vectors.clear()
        return np.stack([self.letter(int(c)) for c in codes])

    def add(self, pieces: list[str], owners: np.ndarray, out: np.ndarray) -> None:
        """Add the trigrams of each piece (``pieces_of``) to its owner's row of ``out``."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        codes = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        codes = np.where(_letters()[codes], codes, 0)
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0) | (piece[1:] != piece[:-1])
        codes, piece = codes[keep], piece[keep]
        seen = np.zeros(0x110000, bool)
        seen[codes] = True
        alphabet = np.flatnonzero(seen)
        place = np.zeros(0x110000, np.int64)
        place[alphabet] = np.arange(len(alphabet))
        s, size = place[codes], len(alphabet)
        whole = (piece[2:] == piece[:-2]) & (codes[1:-1] != 0)
        grams = ((s[:-2] * size + s[1:-1]) * size + s[2:])[whole]
        if not len(grams):
            return
        if size**3 <= 1 << 22:
            met = np.flatnonzero(np.bincount(grams, minlength=size**3))
            code = np.zeros(size**3, np.int64)
            code[met] = np.arange(len(met))
            code = code[grams]
        else:
            met, code = np.unique(grams, return_inverse=True)
        rows, owner = np.unique(owners, return_inverse=True)
        owner = owner[piece[:-2][whole]].astype(np.int64)
        width = max(256, min(CHUNK, CELLS // len(rows)))
        if len(met) > width:
            order = np.argsort(code, kind="stable")
            code, owner = code[order], owner[order]
        for lo in range(0, len(met), width):
            here = met[lo : lo + width]
            a, b = np.searchsorted(code, [lo, lo + len(here)]) if len(met) > width else (0, len(code))
            table = np.bincount(owner[a:b] * len(here) + code[a:b] - lo, minlength=len(rows) * len(here)).reshape(len(rows), len(here)).astype(np.float32)
            used, at = np.unique(np.stack([here // (size * size), here // size % size, here % size]), return_inverse=True)
            base, at = self.letters(alphabet[used]), at.reshape(3, -1)
            vectors = np.roll(base, 2, axis=1)[at[0]]
            vectors *= np.roll(base, 1, axis=1)[at[1]]
            vectors *= base[at[2]]
            out[rows] += table @ vectors

    def bundle(self, texts: list[str | None], owners: np.ndarray | None = None, n: int | None = None) -> np.ndarray:
        """The sums of the texts' trigram vectors, a row for each text (or for each of ``n`` owners)."""
        owners = np.arange(len(texts)) if owners is None else owners
        out, held, whose, size = np.zeros((len(texts) if n is None else n, self.dims)), [], [], 0
        for text, owner in zip(texts, owners.tolist()):
            for piece in pieces_of(text or ""):
                held.append(piece)
                whose.append(owner)
                size += len(piece)
                if size >= PIECE:
                    self.add(held, np.asarray(whose), out)
                    held, whose, size = [], [], 0
        if held:
            self.add(held, np.asarray(whose), out)
        return out


def pieces_of(text: str) -> Iterator[str]:
    """The text, lower-cased and with an end on both sides, in pieces of at most PIECE characters.

    A piece ends behind a letter and the next one begins with its last two characters, so every
    trigram of the text is one of exactly one piece.  Characters that are no letters count as one.
    """
    line, at = f" {text.lower()} ", 0
    while len(line) - at > PIECE:
        to = at + PIECE
        while to > at + 2 and not line[to - 1].isalpha():
            to -= 1
        if to > at + 2:
            yield line[at:to]
            at = to - 2
        else:  # no letter but perhaps in the first two places
            yield line[at : at + 3]
            at += PIECE - 1
    yield line[at:]


def prototypes(docs: DataFrame, dims: int = DIMS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Language to unit vector, learned from ``text`` and ``lang``."""
    ship(docs.sparkSession)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, sums = Encoder(dims, seed), {}
        for batch in slices(batches, "text", BATCH_BYTES):
            langs, owners = np.unique(np.asarray(batch.column("lang").to_pylist(), object), return_inverse=True)
            for lang, total in zip(langs, enc.bundle(batch.column("text").to_pylist(), owners, len(langs))):
                sums[lang] = sums.get(lang, 0) + np.rint(total).astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array(list(sums.values()), pa.list_(pa.int64()))], ["lang", "total"])

    known = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    parts = known.mapInArrow(learn, "lang string, total array<long>").select("lang", F.posexplode("total").alias("dim", "value"))
    out: dict[str, np.ndarray] = {}
    for r in parts.groupBy("lang", "dim").agg(F.sum("value").alias("value")).collect():
        out.setdefault(r.lang, np.zeros(dims))[r.dim] = r.value
    return {k: v / np.linalg.norm(v) for k, v in sorted(out.items()) if v.any()}


def predict(docs: DataFrame, known: dict[str, np.ndarray], dims: int = DIMS, seed: int = SEED, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with two more columns, language and score, called ``names``; all columns stay, but one of such a name is replaced."""
    ship(docs.sparkSession)
    made_names = list(names)
    docs = docs.drop(*names).withColumn("text", F.col("text").cast("string"))
    names, langs = docs.columns, list(known)
    place = [c.lower() for c in names].index("text")
    matrix = np.stack([known[x] for x in langs]).astype(np.float32) if langs else None

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(dims, seed)
        for batch in (part.slice(at, ROWS) for part in slices(batches, names[place], BATCH_BYTES) for at in range(0, part.num_rows, ROWS)):
            made = enc.bundle(batch.column(place).to_pylist())
            pred, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            if matrix is not None:
                cosine = np.round((made @ matrix.T) / np.maximum(np.linalg.norm(made, axis=1), 1e-9)[:, None], 6)
                some = made.any(axis=1)
                best = cosine.argmax(axis=1)
                pred = [langs[b] if ok else "und" for b, ok in zip(best, some)]
                score = np.where(some, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred), pa.array(score.astype(np.float64))], [*names, *made_names])

    return docs.mapInArrow(label, docs.withColumns({made_names[0]: F.lit(""), made_names[1]: F.lit(0.0)}).schema)
