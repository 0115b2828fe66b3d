from __future__ import annotations

import ftplib
import zipfile
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfwise.operators import adjudicate, brands, match, vectors
from shelfwise.session import Scratch, setting, written
from shelfwise.sources import files, ingest, sinks, workbook
from shelfwise.streaming.ingest import windowed_counts


def test_tables_over_jdbc(spark, tmp_path):
    """Append, truncate, replace, and reads with pushed columns and filters, on the database that Spark brings along."""
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id long, t string")
    sinks.write_jdbc(df, url, "items")
    sinks.write_jdbc(df, url, "items")
    assert files.read_table(spark, "items", url=url).count() == 4
    some = files.read_table(spark, "items", ["t"], "id = 2", url)
    assert [r.t for r in some.collect()] == ["y", "y"] and some.columns == ["t"]
    assert "PushedFilters: [*IsNotNull(id), *EqualTo(id,2)]" in some._jdf.queryExecution().toString().replace("ID", "id")
    sinks.write_jdbc(df.limit(1), url, "items", "truncate")
    assert files.read_table(spark, "items", url=url).count() == 1
    sinks.write_jdbc(df.withColumn("u", F.lit(1)), url, "items", "replace")
    assert [c.lower() for c in files.read_table(spark, "items", url=url).columns] == ["id", "t", "u"]


class FakeServer:
    """Stands for a server in the tests: two files."""

    kept = {"/in/a_1.csv": b"k\n1\n", "/in/a_2.csv": b"k\n2\n"}
    log: list[str] = []

    def __init__(self, host, user, password):
        self.log.append(f"{type(self).__name__} {host} {user} {password}")

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.log.append("closed")

    def prot_p(self):
        self.log.append("secured")

    def nlst(self, folder):
        return [f for f in self.kept if f.startswith(folder)]

    def retrbinary(self, command, take):
        content = self.kept[command.removeprefix("RETR ")]
        take(content[:2])
        take(content[2:])


def test_files_come_from_a_server(spark, tmp_path, monkeypatch):
    for name in ("FTP", "FTP_TLS"):
        monkeypatch.setattr(ftplib, name, type(name, (FakeServer,), {}))
    FakeServer.log.clear()
    store = ingest.FtpStore(spark, "h", "u", "p", f"file://{tmp_path}/staged")
    assert store.list("/in") == ["a_1.csv", "a_2.csv"] and FakeServer.log == ["FTP_TLS h u p", "secured", "closed"]
    paths = store.fetch("/in", ingest.choose_files(store.list("/in"))[0])
    FakeServer.kept.clear()  # the second phase needs no server
    assert [files.read_delimited(spark, paths[n]).first().k for n in sorted(paths)] == ["1", "2"]
    ingest.FtpStore(spark, "h", "u", "p", f"file://{tmp_path}/staged", secure=False).list("/in")
    assert FakeServer.log[-2:] == ["FTP h u p", "closed"]


def test_remote_embedder_tries_again():
    calls = []

    def remote(texts):
        calls.append(len(texts))
        if len(calls) == 1:
            raise ConnectionError
        return [[3.0, 4.0]] * (len(texts) - (len(calls) == 2))

    made = vectors.RetryingEmbedder("m", remote, batch=2, base=0.0).embed(["a", "b", "c"])
    assert calls == [2, 2, 2, 1] and np.allclose(made, [[0.6, 0.8]] * 3)
    with pytest.raises(adjudicate.CallFailed):
        vectors.RetryingEmbedder("m", lambda t: [], attempts=2, base=0.0).embed(["a"])


def test_picks_outside_the_list_are_none(spark):
    class Wrong:
        def answer(self, questions):
            return [{"match_index": {"A": 9, "B": "2", "C": None, "D": "x"}[questions[0]["asked"]], "confidence": 70}]

    asked = spark.createDataFrame([(i, n) for i, n in enumerate("ABCD")], "row_id long, name string")
    candidates = asked.select("row_id", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("rank")).select("row_id", "rank", (F.col("rank") * 10).cast("long").alias("src_id"), F.lit("n").alias("name"))
    got = adjudicate.pick_candidates(asked, candidates, Wrong()).collect()
    assert {r.row_id: r.src_id for r in got} == {0: None, 1: 20, 2: None, 3: None} and all(r.error is None for r in got)


def test_learning_is_replayed(spark, tmp_path):
    rows = [("A", 1, "5", 50, "Fuzzy", 95), ("B", 2, "5", 77, "Fuzzy", 80), ("B", 3, "9", 1, "Fuzzy", 99), ("B", 4, "7", 60, "Fuzzy", 99)]
    plain = spark.createDataFrame(rows, "label string, row_id long, bc string, src_id long, method string, confidence int")
    matches = plain.select("*", F.lit(None).cast("double").alias("c_weight"), F.lit(None).cast("double").alias("s_weight"), *[F.array().cast("array<string>").alias(c) for c in ("c_brands", "s_brands")])
    index, cache = spark.createDataFrame([("9", 9)], "bc string, src_id long"), f"file://{tmp_path}/learned"
    first, done = match.learn_in_order(index, matches, ["A"], Scratch(spark, "l"), cache)
    none = matches.where("label <> 'A'")  # the first step is not worked out again
    final, done = match.learn_in_order(index, none, ["A", "B"], Scratch(spark, "l"), cache)
    assert {(r.label, r.row_id, r.src_id, r.found_by) for r in done.collect()} == {("A", 1, 50, "Fuzzy"), ("B", 2, 50, "Barcode"), ("B", 3, 9, "Barcode"), ("B", 4, 60, "Fuzzy")}
    assert {(r.bc, r.src_id, r.via) for r in final.collect()} == {("9", 9, None), ("5", 50, "Fuzzy A"), ("7", 60, "Fuzzy B")}
    out = {r.row_id: (r.found_by, r.confidence, r.barcode_source, r.borrowed_barcode, r.barcode_link) for r in match.finalise_barcodes(done, index, final).collect()}
    assert out == {1: ("Fuzzy", 95, "Learned", None, None), 2: ("Barcode (Bridged)", 97, "Learned", "5", "Fuzzy A"), 3: ("Barcode", 99, "Original", None, "Catalogue"), 4: ("Fuzzy", 99, "Learned", None, None)}


def test_brand_cascade_skips_and_claims(spark):
    names = ["AL NOOR", "NOOR", "KRAFT", "NOOR KRAFT"]
    dictionary = spark.createDataFrame([(n.replace(" ", ""), n, len(n.split())) for n in names], "key string, brand string, n_words int")
    none = spark.createDataFrame([], "g string, brand string, n long, share double")
    rows = [
        (1, "", "FZ CKN KRAFT CHEESE"), (2, "", "BOX AL NOOR KRAFT"), (3, "", "BOX OF NOOR AND KRAFT"), (4, "AL-NOOR", "x"), (5, "old NOOR KRAFT things", "x"),
        (6, "", "FZ CKN CO FZ KRAFT"), (7, "", "KRAFT"), (8, "", "nothing"), (9, None, None), (10, "", "OIL NOOR NOOR"),
    ]
    df = spark.createDataFrame(rows, "row_id long, g string, t string")
    got = {r.row_id: (r.brand, r.method, r.evidence) for r in brands.resolve_brands(df, dictionary, none, ["OLD"], "row_id", "g", "t").collect()}
    assert got == {
        1: ("KRAFT", "text_opening", "KRAFT"),
        2: ("UNKNOWN", "ambiguous", "AL NOOR~AL NOOR; KRAFT~KRAFT"),  # AL NOOR is met before NOOR KRAFT, which shares a word with it
        3: ("UNKNOWN", "ambiguous", "NOOR~NOOR; KRAFT~KRAFT"),
        4: ("AL NOOR", "group_text", "AL-NOOR"),
        5: ("NOOR KRAFT", "group_text", "old NOOR KRAFT things"),
        6: ("KRAFT", "text_scan", "KRAFT"),  # three words are skipped at most
        7: ("KRAFT", "text_opening", "KRAFT"),
        8: ("UNKNOWN", "unresolved", ""),
        9: ("UNKNOWN", "unresolved", ""),
        10: ("NOOR", "text_scan", "NOOR"),
    }


def test_close_texts_lose_no_pair(spark):
    import random

    from shelfwise.functions.scores import ratio

    rng = random.Random(4)
    words = sorted({"".join(rng.choices("abcd", k=rng.randint(3, 14))) for _ in range(250)})
    words += [w[:i] + w[i + 1 :] for w in words[:60] if len(w) > 8 for i in (2,)]
    a, b = sorted(set(words[::2])), sorted(set(words[1::2] + words[:40]))
    frame = lambda values, name: spark.createDataFrame([(v,) for v in values], f"{name} string")
    got = {(r.asked, r.known) for r in brands.close_texts(frame(a, "asked"), frame(b, "known"), 80.0).collect()}
    want = {(x, y) for x in a for y in b if ratio(x, y) >= 80}
    assert len(want) > 60 and want <= got


def test_workbooks_hold_text_and_colours(spark, tmp_path):
    df = spark.createDataFrame([(1, "a & <b>", "FF0000"), (2, None, None), (3, " ünï\x01", "00FF00")], "n long, t string, tint string")
    path = f"{tmp_path}/b.xlsx"
    workbook.write_workbook({"one": df, "empty": df.limit(0)}, f"file://{path}", "tint")
    got = sorted((r.sheet, r.row_no, r.cells) for r in workbook.read_workbooks(spark, path).collect())
    assert got == [("empty", 0, ["n", "t"]), ("one", 0, ["n", "t"]), ("one", 1, ["1", "a & <b>"]), ("one", 2, ["2"]), ("one", 3, ["3", " ünï"])]
    book = zipfile.ZipFile(path)
    assert b'rgb="FFFF0000"' in book.read("xl/styles.xml") and book.read("xl/worksheets/sheet1.xml").count(b' s="') == 4
    assert all(workbook.column_number(workbook.column_letters(n) + "1") == n for n in (0, 25, 26, 701, 702, 16383))


def test_workbooks_of_many_blocks(spark, tmp_path, monkeypatch):
    """Rows keep their order over partitions, blocks and windows, and the archive holds together."""
    monkeypatch.setattr(workbook, "BLOCK_ROWS", 70)
    monkeypatch.setattr(workbook, "HELD_BYTES", 2_000)
    df = spark.range(0, 1000, 1, 7).selectExpr("id", "concat('text ', id * id) AS t", "CASE WHEN id % 3 = 0 THEN '00FF00' END AS tint")
    path = f"{tmp_path}/many.xlsx"
    workbook.write_workbook({"rows": df, "again": df.drop("tint")}, f"file://{path}", "tint")
    book = zipfile.ZipFile(path)
    assert book.testzip() is None and book.read("xl/worksheets/sheet1.xml").count(b' s="1"') == 2 * 334
    got = sorted((r.row_no, r.cells) for r in workbook.read_workbooks(spark, path, "rows").collect())
    assert got == [(0, ["id", "t"])] + [(i + 1, [str(i), f"text {i * i}"]) for i in range(1000)]
    monkeypatch.setattr(workbook, "MOST_ROWS", 1000)
    with pytest.raises(ValueError, match="at most"):
        workbook.write_workbook({"rows": df}, f"file://{path}", "tint")


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300), st.binary(max_size=300))
def test_checksums_of_joined_texts(a, b):
    assert workbook.crc_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_streamed_windows(spark, tmp_path):
    rows = [("2024-01-01 00:01:00", "a"), ("2024-01-01 00:09:00", "a"), ("2024-01-01 00:11:00", "b")]
    spark.createDataFrame(rows, "t string, k string").selectExpr("to_timestamp(t) AS t", "k").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("t timestamp, k string").parquet(f"{tmp_path}/in")
    windowed_counts(stream, "t", "k").writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.window_start.minute, r.k, r.n) for r in spark.table("windows").collect()) == [(0, "a", 2), (10, "b", 1)]


def test_settings_come_back_and_tables_are_seen(spark, tmp_path):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with setting(spark, key, "3"):
        assert spark.conf.get(key) == "3"
    assert spark.conf.get(key) == before
    assert not written(spark, f"file://{tmp_path}/x")
    spark.range(1).write.parquet(f"file://{tmp_path}/x")
    assert written(spark, f"file://{tmp_path}/x")


def test_lineage_and_corrupt_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k\n1\n")
    assert files.with_lineage(files.read_delimited(spark, f"{tmp_path}/a.csv", drop_empty=False)).first()._source_file == "a.csv"
    (tmp_path / "m.csv").write_text('k,t\n1,"two\nlines"\n')
    assert files.read_delimited(spark, f"{tmp_path}/m.csv", multiline=True).first().t == "two\nlines"
    (tmp_path / "l.csv").write_bytes("k\né\n".encode("latin-1"))
    assert files.pick_encoding(spark, str(tmp_path)) == "latin-1"  # one of several files decides


def test_brands_merged_by_hand(spark):
    rows = [("OREO", "MASTER"), ("OREAO", "OTHER"), ("POMI", "OTHER"), ("BUSH", "OTHER"), ("BUSH'S BEST", "MASTER"), ("AL MARRAI", "OTHER"), ("AL MARAI", "OTHER"), ("ALMARAAI", "OTHER"), ("CLASSIC", "OTHER"), ("CLASSICO", "OTHER"), ("KELLOGGS", "X")]
    df = spark.createDataFrame(rows, "brand string, source_customer string")
    counts = brands.brand_counts(df)
    keys = counts.groupBy("key").agg(F.min("brand").alias("position"))
    stars = brands.greedy_stars(keys, brands.close_keys(keys, brands.not_one(spark)))
    got = {r.brand: (r.standardized_brand, r.match_type) for r in brands.standardise(counts, stars, "MASTER", brands.by_hand(counts, "MASTER")).collect()}
    assert got["OREAO"] == got["OREO"] == ("OREO", "fuzzy_curated")
    assert got["POMI"] == ("POMI", "single") and got["CLASSICO"] == ("CLASSICO", "single") and got["KELLOGGS"][0] == "KELLOGGS"
    assert got["BUSH"] == got["BUSH'S BEST"] == ("BUSH'S", "curated_forced_canonical")
    assert got["AL MARRAI"][0] == got["ALMARAAI"][0] == "ALMARAAI" and got["AL MARAI"][0] in ("AL MARAI", "AL MARRAI")


def test_neighbours_in_rounds(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-2, 3, 3 if i % 10 else 4).astype(float).tolist()) for i in range(400)] + [(900, [1.0, float("nan"), 0.0]), (901, None), (902, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(3)
    queries = df.where("id % 4 = 0").withColumnRenamed("id", "query_id")
    unit = {i: np.asarray(v) / (np.linalg.norm(v) or 1) for i, v in rows if v and np.isfinite(v).all()}
    want = set()
    for q in (i for i in unit if i % 4 == 0):
        near = sorted((-round(float(unit[q] @ v), 9), i) for i, v in unit.items() if len(v) == len(unit[q]))[:5]
        want |= {(q, i, r + 1) for r, (_, i) in enumerate(near)}
    for size in (vectors.ROUND_BYTES, 900):
        monkeypatch.setattr(vectors, "ROUND_BYTES", size)
        got = {(r.query_id, r.item_id, r.rank) for r in vectors.knn(queries, df.withColumnRenamed("id", "item_id"), 5).collect()}
        assert got == want
