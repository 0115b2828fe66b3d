"""The registered queries of the operators: thin, whole tables, contract columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import filter_audit, jaccard_join, language_id, line_dedup, lm, merkle, nbest, near_dups, nearest, packing, quality_model, quality_rules, secrets
from shelfwise.llm.common import fold, read


def op1_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(fold("doc_id", 5) == 1, F.lit(False))
    out = lm.train_and_score(read(spark, sf_dir, "documents"), ~held, least=1)
    return out.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP2_SQL = """
WITH good AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id, sqrt(list_reduce(list_prepend(0::DOUBLE,
    list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), lambda a, b: a + b)) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    known = language_id.prototypes(docs.where(~held))
    out = language_id.predict(docs.select("doc_id", "text"), known)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    model = quality_model.fit(docs.where(~held), read(spark, sf_dir, "labels").where(~held))
    out = quality_model.score(docs, model)
    return out.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH lines AS (
  SELECT rowid AS r, doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT row_number() OVER () AS rowid, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (
  SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT keyed.*, common.k IS NOT NULL AND keyed.doc_id <> common.top AS gone FROM keyed LEFT JOIN common USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_rules.apply_policy(quality_rules.write_ledger(read(spark, sf_dir, "documents")), "v1")
    base = F.col("fail_bits").bitwiseAND(F.lit(quality_rules.mask_of("base"))) != 0
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "fail_bits", "policy")


def quality_rule_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.ablation(quality_rules.write_ledger(read(spark, sf_dir, "documents")), "v1")


LEDGER_SQL = r"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT r, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
windows AS (
  SELECT r, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    len(lines) AS n_lines, length(t) - length(replace(t, '!', '')) AS n_bangs
  FROM texts JOIN words USING (r) LEFT JOIN covered USING (r)),
judged AS (SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repeats, 10 * n_symbols > n_words AS symbols,
    n_lines >= 4 AND 2 * n_dup_lines > n_lines AS dup_lines, n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words) AS word_length,
    5 * n_bangs > n_words AS shouting FROM measured),
book AS (SELECT *, CAST(short::INT + 2 * repeats::INT + 4 * symbols::INT + 8 * dup_lines::INT + 16 * word_length::INT + 32 * shouting::INT AS BIGINT) AS fail_bits FROM judged)
"""

OP6_SQL = f"""{LEDGER_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed, fail_bits = 0 AS kept, fail_bits, 'v1' AS policy
FROM book
"""

ABLATION_SQL = f"""{LEDGER_SQL}
SELECT rule, count(*) AS n_failed, count(*) FILTER (WHERE fail_bits = bit) AS n_only
FROM book JOIN (VALUES ('short', 1), ('repeats', 2), ('symbols', 4), ('dup_lines', 8), ('word_length', 16), ('shouting', 32)) AS r(rule, bit) ON (fail_bits & bit) <> 0
GROUP BY rule
"""


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op8_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = nbest.encode_nbest(read(spark, sf_dir, "documents"), public_tokenizers.path(nbest.MODEL), with_ids=False)
    return out.select("doc_id", "n_pieces", "scores", "ids_crc32", "paths_crc32", "round_trip")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(packing.TOKENIZER), with_ids=False)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


def op10_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(read(spark, sf_dir, "documents"))


#: Components of documents whose shingle sets link; SIZE, LAST and PERCENT are put in.
SETS_SQL = r"""
WITH RECURSIVE
texts AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT r, doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < SIZE THEN [array_to_string(w, chr(10))]
    ELSE list_transform(range(1, len(w) - LAST), lambda i: array_to_string(w[i:i + LAST + 1], chr(10))) END)) AS s FROM texts),
marked AS (SELECT r, doc_id, s, len(s) AS n, CASE WHEN len(s) > 0 AND doc_id IS NOT NULL THEN md5(array_to_string(s, chr(13))) END AS d FROM sets),
nodes AS (SELECT d, min(doc_id) AS rep, any_value(n) AS n, any_value(s) AS s FROM marked WHERE d IS NOT NULL GROUP BY d),
grams AS (SELECT d, n, unnest(s) AS g FROM nodes),
links AS (
  SELECT a.d AS x, b.d AS y FROM grams a JOIN grams b ON a.g = b.g AND a.d <> b.d AND 100 * least(a.n, b.n) >= PERCENT * greatest(a.n, b.n)
  GROUP BY a.d, b.d, a.n, b.n HAVING 100 * count(*) >= PERCENT * (a.n + b.n - count(*))),
reach AS (SELECT d AS x, d AS y FROM nodes UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
owners AS (SELECT x AS d, min(rep) AS least FROM reach JOIN nodes ON y = d GROUP BY x),
judged AS (SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, CASE WHEN doc_id IS NOT NULL THEN coalesce(least, doc_id) END AS component_id FROM marked LEFT JOIN owners USING (d))
"""

OP10_SQL = SETS_SQL.replace("SIZE", "5").replace("LAST", "3").replace("PERCENT", "85") + "SELECT doc_id, n_shingles, component_id, coalesce(doc_id = component_id, TRUE) AS kept FROM judged"
OP12_SQL = SETS_SQL.replace("SIZE", "3").replace("LAST", "1").replace("PERCENT", "90") + "SELECT doc_id, n_shingles, component_id FROM judged"


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH RECURSIVE
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
judged AS (
  SELECT part, coalesce(good, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS toxic,
    CAST(len(w) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 65 * len(w) AS INT)
    + 4 * CAST(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) AS INT)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
    + 16 * CAST(coalesce(texts.doc_id > min(texts.doc_id) OVER (PARTITION BY t), FALSE) AS INT) AS f
  FROM texts LEFT JOIN marks ON texts.doc_id = marks.doc_id),
found AS (SELECT part, f, good, toxic, count(*) AS n FROM judged GROUP BY ALL),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(letter, bit)),
steps AS (
  SELECT letter AS prefix, 0 AS before, bit, 1 AS step FROM letters
  UNION ALL SELECT prefix || letter, before + steps.bit, letters.bit, step + 1 FROM steps JOIN letters ON strpos(prefix, letter) = 0),
counts AS (
  SELECT part, before, bit, any_value(step) AS step,
    sum(n) FILTER (WHERE f & before = 0 AND f & bit = 0) AS kept, sum(n) FILTER (WHERE f & before = 0 AND f & bit <> 0) AS removed,
    sum(n) FILTER (WHERE f & before <> 0 AND f & bit <> 0) AS redundant, sum(n) FILTER (WHERE f = bit) AS unique_fails,
    sum(n) FILTER (WHERE f & before = 0 AND f & bit <> 0 AND good) AS good_lost, sum(n) FILTER (WHERE f & before = 0 AND f & bit <> 0 AND toxic) AS toxic_lost
  FROM found CROSS JOIN (SELECT DISTINCT before, bit, step FROM steps) GROUP BY part, before, bit),
shares AS (SELECT part, bit, sum(removed * [24, 6, 4, 6, 24][step]) AS shapley FROM counts GROUP BY part, bit)
SELECT counts.part, whole.prefix AS filter_order, CAST(steps.step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(coalesce(shapley, 0) AS BIGINT) AS shapley
FROM steps JOIN steps AS whole ON whole.step = 5 AND starts_with(whole.prefix, steps.prefix)
JOIN counts ON counts.before = steps.before AND counts.bit = steps.bit JOIN shares ON shares.part = counts.part AND shares.bit = counts.bit
"""


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = merkle.documents_manifest(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"), "folded_root", "verified")


OP13_SQL = r"""
WITH RECURSIVE
crc_table AS (
  SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS b(i))),
texts AS (SELECT row_number() OVER () AS r, *, CAST(doc_id AS VARCHAR) AS d FROM documents),
fields AS (
  SELECT r, doc_id, lang, n_chars, coalesce(strlen(d) || ':' || d, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail, coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(d) + 1), lambda i: CAST(ord(d[i]) AS BIGINT))),
      lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) % 7 = 0, FALSE) AS hit FROM texts, crc_table),
counted AS (SELECT *, coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS now,
    coalesce(strlen(CAST(n_chars::HUGEINT + 1 AS VARCHAR)) || ':' || (n_chars::HUGEINT + 1), '-') AS later FROM fields),
leaves AS (SELECT r, doc_id, lang, sha256(head || now || tail) AS leaf, sha256(head || CASE WHEN hit THEN later ELSE now END || tail) AS start FROM counted),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS spot FROM leaves),
levels AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY spot) AS l FROM placed GROUP BY lang
  UNION ALL SELECT lang, level + 1, list_transform(range(0, (len(l) + 1) // 2), lambda i: sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], ''))) FROM levels WHERE len(l) > 1),
subroots AS (SELECT lang, l[1] AS subroot, level AS top, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree_at FROM levels WHERE len(l) = 1),
over_levels AS (
  SELECT 0 AS level, list(subroot ORDER BY tree_at) AS l FROM subroots
  UNION ALL SELECT level + 1, list_transform(range(0, (len(l) + 1) // 2), lambda i: sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], ''))) FROM over_levels WHERE len(l) > 1),
ways AS (
  SELECT r, level, (spot >> level) & 1 AS side, l[xor(spot >> level, 1) + 1] AS beside FROM placed JOIN levels ON placed.lang IS NOT DISTINCT FROM levels.lang WHERE len(l) > 1
  UNION ALL SELECT r, top + level, (tree_at >> level) & 1, l[xor(tree_at >> level, 1) + 1] FROM placed JOIN subroots ON placed.lang IS NOT DISTINCT FROM subroots.lang, over_levels WHERE len(l) > 1),
proofs AS (SELECT r, list(struct_pack(side := side, beside := beside) ORDER BY level) AS way, sha256(coalesce(string_agg(beside, '' ORDER BY level), '')) AS proof_sha256 FROM ways GROUP BY r),
folded AS (
  SELECT r, 0 AS level, start AS x FROM placed
  UNION ALL SELECT folded.r, level + 1, sha256(CASE WHEN way[level + 1].side = 1 THEN way[level + 1].beside || x ELSE x || coalesce(way[level + 1].beside, '') END)
  FROM folded JOIN proofs ON folded.r = proofs.r WHERE level < len(way)),
ends AS (SELECT r, arg_max(x, level) AS folded_root FROM folded GROUP BY r)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN ends USING (r) LEFT JOIN proofs USING (r) JOIN subroots ON placed.lang IS NOT DISTINCT FROM subroots.lang,
  (SELECT l[1] AS root FROM over_levels WHERE len(l) = 1)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_lm": op1_ngram_lm,
        "op2_nearest": op2_nearest,
        "op3_language_id": op3_language_id,
        "op4_quality_model": op4_quality_model,
        "op5_line_dedup": op5_line_dedup,
        "op6_quality_rules": op6_quality_rules,
        "op7_secret_scan": op7_secret_scan,
        "op8_nbest": op8_nbest,
        "op9_packing": op9_packing,
        "op10_near_dups": op10_near_dups,
        "op11_filter_audit": op11_filter_audit,
        "op12_jaccard_join": op12_jaccard_join,
        "op13_merkle": op13_merkle,
        "quality_rule_ablation": quality_rule_ablation,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_nearest": OP2_SQL, "op5_line_dedup": OP5_SQL, "op6_quality_rules": OP6_SQL, "op10_near_dups": OP10_SQL, "op11_filter_audit": OP11_SQL, "op12_jaccard_join": OP12_SQL, "op13_merkle": OP13_SQL, "quality_rule_ablation": ABLATION_SQL}
