from __future__ import annotations

import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import language_id, queries


def brute_bundle(enc, text):
    """Sum of the vectors of every letter trigram, one at a time."""
    kept = [c if c.isalpha() else " " for c in " " + (text or "").lower() + " "]
    marks = [c for i, c in enumerate(kept) if c != " " or not i or kept[i - 1] != " "]
    total = np.zeros(enc.dims)
    for (a, b, c), n in Counter(zip(marks, marks[1:], marks[2:])).items():
        if b != " ":
            v = [enc.letter(ord(x) if x != " " else 0) for x in (a, b, c)]
            total += n * np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
    return total


TEXTS = [None, "", "12 !", "a", "Ab", "ab ab  ab\n\tcd", "ünïcode Straße ΣΑΣ", "one two three " * 400, "x" * 900, "漢字かな交じり文 " * 50, "same", "same"]


@pytest.mark.parametrize(("piece", "chunk"), [(1 << 20, 8192), (64, 256)])
def test_bundles_equal_brute_force(monkeypatch, piece, chunk):
    monkeypatch.setattr(language_id, "PIECE", piece)
    monkeypatch.setattr(language_id, "CHUNK", chunk)
    enc = language_id.Encoder(64, 3)
    texts = [*TEXTS, "line\nfeeds\tonly\n" * 40, "." * 300 + "a" + "!" * 200 + "bc" + "-" * 64, "İstanbul ΟΔΟΣ" * 30]
    made = enc.bundle(texts)
    for text, row in zip(texts, made):
        assert np.array_equal(row, brute_bundle(enc, text)), text
    owners = np.arange(len(texts)) % 2
    assert np.array_equal(enc.bundle(texts, owners, 2), np.stack([made[0::2].sum(axis=0), made[1::2].sum(axis=0)]))


def test_pieces_of_a_text_without_spaces_bundle_exactly(monkeypatch):
    text = "".join(chr(97 + i * i % 23) for i in range(1_300_000)) + "\n" + "日本語" * 100_000
    enc = language_id.Encoder(64, 3)
    cut = enc.bundle([text])
    monkeypatch.setattr(language_id, "PIECE", 1 << 30)
    assert np.array_equal(cut, enc.bundle([text]))


@pytest.mark.parametrize("many", [300, 1])
def test_many_letters_and_long_texts_need_little_memory(many):
    rng = np.random.default_rng(0)
    letters = np.asarray([chr(0x4E00 + i) for i in range(3000)])
    texts = ["".join(letters[rng.integers(0, 3000, 1200)]) for _ in range(300)] if many > 1 else [" ".join("".join(row) for row in letters[rng.integers(0, 300, (900_000, 6))])]
    tracemalloc.start()
    language_id.Encoder().bundle(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 450 << 20


def test_predictions_equal_brute_force(spark):
    """Every document of the table against prototypes and cosines worked out one by one."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.withColumn("held", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).collect()
    enc = language_id.Encoder()
    made, sums = {r.doc_id: brute_bundle(enc, r.text) for r in rows}, {}
    for r in rows:
        if not r.held and r.lang is not None and r.text is not None:
            sums[r.lang] = sums.get(r.lang, 0) + made[r.doc_id]
    units = {k: v / np.linalg.norm(v) for k, v in sorted(sums.items()) if np.any(v)}
    for r in queries.op3_language_id(spark, "/root/testdata/sf0.001").collect():
        v = made[r.doc_id]
        cosines = {k: round(float(v @ u) / max(np.linalg.norm(v), 1e-9), 6) for k, u in units.items()}
        want = max(cosines, key=cosines.get) if v.any() else "und"
        assert (r.lang_pred, r.score) == (want, pytest.approx(max(0.0, cosines[want]) if v.any() else 0.0, abs=2e-6))
