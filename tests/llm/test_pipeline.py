from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import queries
from tests.llm.test_text_operators import SCHEMA, brute_components, brute_lines


def test_stages_take_effect(spark, tmp_path):
    good = [" ".join(f"{'ab cd ef gh ij kl mn'.split()[(i * j) % 7]}{'xyzuvw'[(i + j) % 6]}{'pqrst'[(i + 2 * j) % 5]}" for j in range(80)) for i in range(6)]
    copied = good[0] + " again"
    shared = "this is a line that is in many documents"
    texts = [*good, copied, "1234 5678", None, "", *(f"{g[:120]}{i}\n{shared}" for i, g in enumerate(good)), "say token=abcdef123 now and then some words"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], SCHEMA)
    path = f"file://{tmp_path}/documents.parquet"
    docs.write.parquet(path)
    at, seen = spark.read.parquet(path), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, f"file://{tmp_path}")
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"file://{tmp_path}/{name}")
        at = spark.read.parquet(f"file://{tmp_path}/{name}")
        seen[name] = {r.doc_id: r.asDict().get("text") for r in at.collect()}
    assert set(seen["language_id"]) == set(range(len(texts))) - {7, 8, 9}
    lines = brute_lines(seen["language_id"])
    assert {i: (seen["language_id"][i].count("\n") + 1, seen["language_id"][i].count("\n") - t.count("\n") if t else 1) for i, t in seen["line_dedup"].items() if t}.items() <= {i: v[:2] for i, v in lines.items()}.items()
    want = brute_components(seen["line_dedup"])
    assert set(seen["near_dedup"]) == {i for i, (_, c) in want.items() if c == i}
    assert seen["secret_scan"][len(texts) - 1] == "say [SECRET] now and then some words"
    assert set(seen["packing"]) == set(seen["secret_scan"])
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").select("doc_id").distinct().count() == len(seen["packing"])


def test_near_dedup_stage_links_from_80_percent(spark):
    texts = {}
    for g in range(40):
        words, changed = [f"g{g}w{i}" for i in range(200)], 16 + g % 8
        texts[2 * g] = " ".join(words)
        texts[2 * g + 1] = " ".join(words[:-changed] + [f"other{i}" for i in range(changed)])
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], SCHEMA)
    want = {i for i, (_, c) in brute_components(texts, 80).items() if c == i}
    assert want != {i for i, (_, c) in brute_components(texts, 85).items() if c == i}
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()} == want


def odd_documents(spark):
    """Null and repeated doc_ids, null and empty texts, and columns whose names the stages use inside."""
    base = [" ".join(f"{a}{b}{c}{d}" for d in "kl" for c in "pqrst" for b in "xyzuvw") for a in ("alpha", "beta", "gamma")]
    line = "this line is in many of the documents"
    rows = [(1, base[0]), (1, base[1]), (1, base[0]), (2, base[0] + " more"), (None, base[0]), (None, base[0]), (3, None), (4, ""), (0, base[1]), *((i, f"{base[2]} number {i}\n{line}") for i in (5, 5, 6, 7, 8))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    return docs.withColumns({c: F.lit(c) for c in ("_row", "kept", "score", "lang_pred", "n_lines", "_line_owner", "drop", "spans", "start", "ids", "component_id")}), rows


def test_stages_on_odd_rows(spark):
    docs, rows = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0, name
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert kept.columns == docs.columns and sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted((i or 0, t) for i, t in rows if t)
    lines = corpus_pipeline.drop_repeated_lines(spark, docs, "")
    assert lines.columns == docs.columns and sorted(r.doc_id for r in lines.collect() if r.text and "many of" in r.text) == [8]
    near = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    got = sorted(((-1 if r.doc_id is None else r.doc_id), (r.text or "")[:5], r["_row"]) for r in near.collect())
    assert near.columns == docs.columns and got == [(-1, "alpha", "_row"), (-1, "alpha", "_row"), (0, "betax", "_row"), (1, "alpha", "_row"), (3, "", "_row"), (4, "", "_row"), (5, "gamma", "_row")]
    secret = corpus_pipeline.redact_secrets(spark, docs, "")
    assert secret.columns == docs.columns and secret.count() == len(rows)
    packed = corpus_pipeline.pack_sequences(spark, docs, "").where("start = 0")
    assert packed.count() == len(rows)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_gives_the_same(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    found = con.sql(queries.oracle_sql()[name])
    order = sorted(found.columns)
    at = [found.columns.index(c) for c in order]
    want = sorted(tuple(r[i] for i in at) for r in found.fetchall())
    got = sorted(tuple(r) for r in queries.queries()[name](spark, sf_dir).select(*order).collect())
    assert got == want


def test_every_operator_has_its_query():
    names = [n for n in queries.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_contract_columns(spark, sf_dir):
    want = {
        "op1_ngram_lm": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
        "op3_language_id": {"doc_id", "held_out", "lang_pred", "score"},
        "op4_quality_model": {"doc_id", "held_out", "score", "predicted"},
        "op5_line_dedup": {"doc_id", "n_lines", "n_dropped", "kept_sha256"},
        "op6_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits", "policy"},
        "op7_secret_scan": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
        "op8_nbest": {"doc_id", "n_pieces", "scores", "ids_crc32", "paths_crc32", "round_trip"},
        "op9_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"},
        "op10_near_dups": {"doc_id", "n_shingles", "component_id", "kept"},
    }
    assert {"query_id", "rank", "vec_id", "score"} <= set(queries.op2_nearest(spark, sf_dir).columns)
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name, columns in want.items():
        df = queries.queries()[name](spark, sf_dir)
        assert columns <= set(df.columns) and df.select(F.countDistinct("doc_id")).first()[0] == n
