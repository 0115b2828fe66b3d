"""From raw documents to packed sequences: five stages, each an operator of ``shelfwise.llm``.

Cases, in every stage: a null text is an empty one (language ID rejects both, as they have no letters); texts are taken
whole, however long; an empty table gives an empty one; further columns stay as they are, whatever their names, until
packing, which returns pieces.  Rows that share a doc_id are documents of their own, but that line dedup counts them as
one.  Rows with a null doc_id lose no lines and are nobody's copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import language_id, line_dedup, near_dups, packing, secrets
from shelfwise.llm.common import fresh
from shelfwise.session import Scratch

#: Texts of at least MIN_JUDGED characters whose best cosine is below MIN_COSINE are in no known language; shorter ones cannot be judged so.
MIN_COSINE, MIN_JUDGED = 0.10, 50
#: Near copies share 80 of 100 shingles; bands and floor are fitted to that (a pair at 0.80 shares no band with probability 6e-7, the floor is 5.4 standard deviations below).
NEAR = {"percent": 80, "rows": 5, "bands": 36, "floor": 0.64}


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents of no known language (no letters, or far from every profile)."""
    known = language_id.prototypes(docs)
    lang, score = fresh(docs, "_lang_pred"), fresh(docs, "_lang_score")
    out = language_id.predict(docs, known, names=(lang, score))
    foreign = (F.col(score) < MIN_COSINE) & (F.char_length("text") >= MIN_JUDGED)
    return out.where((F.col(lang) != "und") & ~foreign).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that three documents or more share, but in the last one."""
    return _sized(line_dedup.dedup_lines(docs).select(*docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates (0.80 or more of five-word shingles), the smallest doc_id.

    Where rows share a doc_id, rows are numbered and of a group the first of those with the smallest doc_id stays.
    """
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        gone = near_dups.near_duplicates(docs, **NEAR).where("not kept").select("doc_id").distinct()
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    row = fresh(docs, "_row")
    numbered = Scratch(spark, "numbered").table(docs.withColumn(row, F.monotonically_increasing_id()), "docs")
    texts = numbered.where("doc_id is not null").select(F.col(row).alias("doc_id"), "text")
    found = near_dups.near_duplicates(texts, **NEAR).select(F.col("doc_id").alias(row), "component_id")
    first = found.join(numbered.select(row, "doc_id"), row).groupBy("component_id").agg(F.min_by(row, F.struct("doc_id", row)).alias("first"))
    gone = found.join(first, "component_id").where(F.col(row) != F.col("first")).select(row)
    return numbered.join(gone, row, "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a label; no document goes."""
    return _sized(secrets.redact(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every document into pieces of power-of-two length."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(packing.TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: No SQL engine expresses these stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
