"""The registered queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from foldcat.llm.bpe import bpe_documents
from foldcat.llm.circulant_minhash import document_groups
from foldcat.llm.containment import decontaminate
from foldcat.llm.conversation_repair import repair_damaged
from foldcat.llm.html_blocks import extract_pages
from foldcat.llm.importance_resampling import resample
from foldcat.llm.language_id import identify_documents
from foldcat.llm.line_templates import line_documents
from foldcat.llm.pairwise_quality import score_documents
from foldcat.llm.rule_cascade import judge_documents
from foldcat.llm.scaled_sketch import compare_edited
from foldcat.llm.trigram_secrets import find_secrets
from foldcat.llm.url_templates import judge_urls

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
# The url rules and the shingle size that the result of the query is defined by.
URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]
NEAR_SHINGLE = 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_documents(_table(spark, sf_dir, "documents"), VOCABULARY)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_documents(_table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Which rule rejected first follows the measured order, which may differ between runs.
    return judge_documents(_table(spark, sf_dir, "documents")).drop("rejected_by")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_documents(_table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_groups(_table(spark, sf_dir, "documents"), NEAR_SHINGLE)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(_table(spark, sf_dir, "conversations"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_bpe, op2_line_dedup, op3_quality, op4_html, op5_rules, op6_decontamination, op7_url_filter, op8_secrets, op9_language, op10_near_duplicates, op11_importance, op12_conversations, op13_fingerprints)
}

_DECONTAMINATION_SQL = r"""
WITH item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
), item_shingles AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    ELSE [array_to_string(w, ' ')] END) AS shingle FROM item_words WHERE len(w) > 0
), lengths AS (
  SELECT DISTINCT least(len(w), 5) AS k FROM item_words WHERE len(w) > 0
), doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
), doc_shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS shingle
  FROM doc_words, lengths
), sizes AS (
  SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id
), found AS (
  SELECT doc_id, item_id FROM doc_shingles JOIN item_shingles USING (shingle) JOIN sizes USING (item_id)
  GROUP BY doc_id, item_id, n HAVING 100 * count(*) >= 80 * n
), flagged AS (
  SELECT doc_id, count(*) AS n_items, array_to_string(list_sort(list(item_id)), ',') AS item_ids FROM found GROUP BY doc_id
)
SELECT d.doc_id, f.doc_id IS NOT NULL AS contaminated, f.doc_id IS NULL AS kept, coalesce(f.n_items, 0) AS n_items,
  coalesce(f.item_ids, '') AS item_ids
FROM documents d LEFT JOIN flagged f ON d.doc_id = f.doc_id
"""

_NEAR_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
    WHEN len(w) = 1 THEN [w[1]] ELSE [] END) AS shingle FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS overlap FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * overlap >= 80 * (x.n + y.n - overlap)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached(doc_id, seen) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON r.seen = l.a
), least AS (
  SELECT doc_id, min(seen) AS component_id FROM reached GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

# The crc32 of a text by its bytes, eight steps each, as DuckDB has no such function.
def _crc32_sql(text: str) -> str:
    byte = "('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::BIGINT".format(text)
    bits = f"list_transform(range(0, 8 * strlen({text})), lambda k: CASE WHEN k % 8 = 0 THEN list_extract(bytes, k // 8 + 1) ELSE 0 END)"
    step = "lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(xor(c, b) >> 1, 3988292384) ELSE xor(c, b) >> 1 END"
    return f"(SELECT xor(list_reduce({bits}, {step}, 4294967295::BIGINT), 4294967295) FROM (SELECT list_transform(range(0, strlen({text})), lambda i: {byte}) AS bytes))"


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_IMPORTANCE_SQL = rf"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
  SELECT regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), used AS (
  SELECT word, sum(s)::BIGINT AS s, sum(t)::BIGINT AS t FROM (
    SELECT unnest(w) AS word, 1 AS s, 0 AS t FROM doc_words UNION ALL SELECT unnest(w), 0, 1 FROM item_words) GROUP BY word
), hashed AS (
  SELECT word, s, t, {_crc32_sql("word")} % 10000 AS bucket FROM used
), counted AS (
  SELECT bucket, sum(s) AS s, sum(t) AS t FROM hashed GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * ((SELECT sum(s) FROM counted) + 10000)::DOUBLE)
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counted) + 10000)::DOUBLE)))::BIGINT AS gain FROM counted
), word_gains AS (
  SELECT word, gain FROM hashed JOIN gains USING (bucket)
), weighed AS (
  SELECT doc_id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM (SELECT doc_id, unnest(w) AS word FROM doc_words) JOIN word_gains USING (word) GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || d.doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents d LEFT JOIN weighed USING (doc_id)
), drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20
)
SELECT s.*, CASE WHEN rank <= 10 * (SELECT count(*) FROM drawn) // 100 THEN rank END AS rank FROM scored s LEFT JOIN drawn USING (doc_id)
"""

# Costs as four digits before the letters, so that the least text is the cheapest and then least audit.
_REPAIR_SQL = rf"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32_sql("(conv_id || ':' || turn)")} % 20 AS kind FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) FROM hashed) WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place, left(role, 1) AS initial,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last FROM damaged
), faulty AS (
  SELECT *, CASE WHEN last = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
    WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair FROM numbered
), edges(state, initial, after, cost, step) AS (
  SELECT s, i, CASE i WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, c, l FROM
  (VALUES (0, 's', 0, 'K'), (0, 'u', 0, 'K'), (1, 'u', 0, 'K'), (2, 'a', 0, 'K'), (3, 'u', 0, 'K'),
          (0, 'u', 1, 'R'), (1, 'u', 1, 'R'), (2, 'a', 1, 'R'), (3, 'u', 1, 'R')) AS e(s, i, c, l)
), paths(conv_id, place, state, best) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, '0000' FROM faulty
  UNION ALL
  SELECT conv_id, place, state, min(best) FROM (
    SELECT f.conv_id, f.place, e.after AS state,
      lpad((left(p.best, 4)::INT + e.cost + CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END)::VARCHAR, 4, '0') || substr(p.best, 5) || e.step AS best
    FROM paths p JOIN faulty f ON f.conv_id = p.conv_id AND f.place = p.place + 1 JOIN edges e ON e.state = p.state
    WHERE f.fault NOT IN ('blank', 'duplicate') AND (e.step = 'R' OR e.initial = f.initial)
    UNION ALL
    SELECT f.conv_id, f.place, p.state, lpad((left(p.best, 4)::INT + 2)::VARCHAR, 4, '0') || substr(p.best, 5) || 'D'
    FROM paths p JOIN faulty f ON f.conv_id = p.conv_id AND f.place = p.place + 1)
  GROUP BY conv_id, place, state
), looked AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, max(place) AS place,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
), chosen AS (
  SELECT conv_id, min(best) AS best FROM paths JOIN looked USING (conv_id, place) WHERE state IN (0, 3) GROUP BY conv_id
), kept AS (
  SELECT conv_id, f.place, role, text, initial, substr(best, f.place::INT + 4, 1) AS step FROM faulty f JOIN chosen USING (conv_id)
), lined AS (
  SELECT conv_id, place, text, CASE WHEN step = 'K' THEN role
    WHEN (row_number() OVER (PARTITION BY conv_id ORDER BY place) + (first_value(initial || step) OVER (PARTITION BY conv_id ORDER BY place) = 'sK')::INT) % 2 = 1
    THEN 'user' ELSE 'assistant' END AS role
  FROM kept WHERE step <> 'D'
), said AS (
  SELECT conv_id, string_agg(role || ':' || text, chr(10) ORDER BY place) AS whole FROM lined GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(left(best, 4)::BIGINT, 0) AS cost,
  coalesce(substr(best, 5), '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN looked USING (conv_id) LEFT JOIN chosen USING (conv_id) LEFT JOIN said USING (conv_id)
"""


def _sketch_sql(text: str) -> str:
    words = rf"list_filter(regexp_split_to_array({_LOWER.format(text)}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
    hashes = f"list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: left(md5(array_to_string(w[i:i + 4], ' ')), 16))))"
    return f"""(SELECT CASE WHEN len(w) = 0 THEN [] WHEN h[1] < '2000000000000000' THEN list_filter(h, lambda x: x < '2000000000000000')
      ELSE h[1:1] END FROM (SELECT w, {hashes} AS h FROM (SELECT {words} AS w)))"""


_FINGERPRINT_SQL = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM documents
), followed AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next FROM texts
), edited AS (
  SELECT doc_id, n_chars, text, next, left(text, n_chars - n_chars // 2) || left(next, n_chars // 2) AS edited FROM followed
), sketched AS (
  SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, {_sketch_sql("text")} AS own, {_sketch_sql("edited")} AS changed, {_sketch_sql("next")} AS next FROM edited
)
SELECT doc_id, n_chars, edited_sha256, array_to_string(own, ',') AS fingerprint, array_to_string(changed, ',') AS edited_fingerprint,
  CASE WHEN len(own) > 0 THEN len(list_intersect(own, changed)) / len(own) ELSE (len(changed) = 0)::DOUBLE END AS near_edited,
  CASE WHEN len(own) > 0 THEN len(list_intersect(own, next)) / len(own) ELSE (len(next) = 0)::DOUBLE END AS near_next
FROM sketched
"""

ORACLE_SQL: dict[str, str] = {
    "op6_decontamination": _DECONTAMINATION_SQL,
    "op10_near_duplicates": _NEAR_SQL,
    "op11_importance": _IMPORTANCE_SQL,
    "op12_conversations": _REPAIR_SQL,
    "op13_fingerprints": _FINGERPRINT_SQL,
}
