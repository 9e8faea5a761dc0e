"""Registered queries of the corpus operators, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import documents
from .exact_dedup import exact_dedup
from .hash_forest import nearest_neighbours
from .language_id import identify_languages
from .lm_score import stupid_backoff
from .merkle import merkle_manifest
from .packing import best_fit_pack, word_tokens
from .quality import quality_rules
from .sentencepiece_codec import encode_documents
from .simhash import simhash_components
from .spelling import LEAST_COUNT, spelled_words, spelling_variants
from .suffix_dedup import suffix_dedup
from .toxicity import toxicity_scores
from .warc_zip import archive_round_trip

QUERIES = {}
SQL = {}


def _register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


@_register("op1_best_fit_packing")
def op1(spark, sf_dir):
    return best_fit_pack(documents(spark, sf_dir), word_tokens(F.col("text")))


@_register("op2_exact_dedup", """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM t JOIN g USING (text_sha256)""")
def op2(spark, sf_dir):
    return exact_dedup(documents(spark, sf_dir))


@_register("op3_lm_scoring", r"""
WITH t AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM t),
k AS (SELECT doc_id, w[i] AS w2, CASE WHEN i > 1 THEN w[i - 1] END AS w1,
             CASE WHEN i > 2 THEN w[i - 2] END AS w0 FROM p),
u AS (SELECT w2 AS w, count(*) AS n FROM k GROUP BY 1),
b AS (SELECT w1, w2, count(*) AS n FROM k WHERE w1 IS NOT NULL GROUP BY 1, 2),
g AS (SELECT w0, w1, w2, count(*) AS n FROM k WHERE w0 IS NOT NULL GROUP BY 1, 2, 3),
s AS (
  SELECT k.doc_id, CASE WHEN k.w0 IS NOT NULL THEN g.n < 2 WHEN k.w1 IS NOT NULL THEN b.n < 2
                        ELSE false END AS off,
         CASE WHEN g.n >= 2 THEN ln(g.n / cb.n)
              WHEN b.n >= 2 THEN ln(b.n / cu.n) + CASE WHEN k.w0 IS NULL THEN 0 ELSE ln(0.4) END
              ELSE ln(u.n / (SELECT sum(n) FROM u)) + CASE WHEN k.w1 IS NULL THEN 0 ELSE ln(0.4) END
                   + CASE WHEN k.w0 IS NULL THEN 0 ELSE ln(0.4) END
         END AS score
  FROM k JOIN u ON u.w = k.w2 LEFT JOIN u cu ON cu.w = k.w1
  LEFT JOIN b ON b.w1 = k.w1 AND b.w2 = k.w2
  LEFT JOIN b cb ON cb.w1 = k.w0 AND cb.w2 = k.w1
  LEFT JOIN g ON g.w0 = k.w0 AND g.w1 = k.w1 AND g.w2 = k.w2)
SELECT t.doc_id, coalesce(len(any_value(t.w)), 0) AS n_tokens, count(*) FILTER (s.off) AS n_backoff,
       round(coalesce(sum(s.score), 0), 4) AS log_score
FROM t LEFT JOIN s USING (doc_id) GROUP BY t.doc_id""")
def op3(spark, sf_dir):
    return stupid_backoff(documents(spark, sf_dir)).select(
        "doc_id", "n_tokens", "n_backoff", F.round("log_score", 4).alias("log_score"))


@_register("op4_warc")
def op4(spark, sf_dir):
    return archive_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@_register("op5_simhash_near_dedup")
def op5(spark, sf_dir):
    return simhash_components(documents(spark, sf_dir))


@_register("op6_sentencepiece")
def op6(spark, sf_dir):
    return encode_documents(documents(spark, sf_dir))


def _fold(parts: int, held: int):
    """Rows whose crc32 of the id as text leaves this remainder."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts)) == held


@_register("op7_toxicity")
def op7(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity_scores(documents(spark, sf_dir), labels, _fold(4, 2))


@_register("op8_quality_rules")
def op8(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir)).drop("distance2")


@_register("op9_suffix_array_dedup")
def op9(spark, sf_dir):
    return suffix_dedup(documents(spark, sf_dir))


@_register("op10_language_id")
def op10(spark, sf_dir):
    return identify_languages(documents(spark, sf_dir), _fold(3, 1)).drop("languages")


# CRC-32 of a list of bytes goes by the table of its polynomial
_CRC = """list_transform(range(256), lambda i: list_reduce([i::UBIGINT] || range(8)::UBIGINT[],
           lambda c, k: xor(c >> 1, (c & 1) * 3988292384)))"""


@_register("op11_merkle_manifest", r"""
WITH RECURSIVE t AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, source,
         concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
                coalesce(strlen(source) || ':' || source, '-'),
                coalesce(strlen(lang) || ':' || lang, '-'),
                coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
         text, replace(text, chr(10), '') AS flat,
         list_transform(range(1, length(doc_id::VARCHAR) + 1),
                        lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::UBIGINT) AS b
  FROM documents),
tab AS MATERIALIZED (SELECT """ + _CRC + r""" AS crc),
l AS MATERIALIZED (
  SELECT rid, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(flat) || ':' || flat, '-')) AS changed,
         xor(list_reduce([4294967295::UBIGINT] || b,
                         lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255)::BIGINT + 1])),
             4294967295::UBIGINT) % 2 = 0 AS tampered
  FROM t, tab),
p AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf, rid) - 1 AS pos FROM l),
up AS (
  SELECT source, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM p GROUP BY source
  UNION ALL
  SELECT source, level + 1, list_transform(range(0, (len(nodes) + 2) // 3),
           lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], '')))
  FROM up WHERE len(nodes) > 1),
top AS MATERIALIZED (SELECT source, max(level) AS levels, arg_max(nodes, level)[1] AS subroot
                     FROM up GROUP BY source),
s AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM top),
roots AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM s HAVING count(*) > 0
  UNION ALL
  SELECT level + 1, list_transform(range(0, (len(nodes) + 2) // 3),
           lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], '')))
  FROM roots WHERE len(nodes) > 1),
root AS MATERIALIZED (SELECT max(level) AS levels, arg_max(nodes, level)[1] AS root FROM roots),
steps AS MATERIALIZED (
  SELECT p.rid, up.level, (pos // (3 ** up.level)::BIGINT) AS spot, up.nodes
  FROM p JOIN up ON up.source IS NOT DISTINCT FROM p.source AND len(up.nodes) > 1
  UNION ALL
  SELECT p.rid, s.levels + r.level, s.place // (3 ** r.level)::BIGINT, r.nodes
  FROM p JOIN s ON s.source IS NOT DISTINCT FROM p.source CROSS JOIN roots r WHERE len(r.nodes) > 1),
runs AS MATERIALIZED (
  SELECT rid, level, array_to_string(nodes[spot // 3 * 3 + 1:spot], '') AS a,
         array_to_string(nodes[spot + 2:spot // 3 * 3 + 3], '') AS b
  FROM steps),
proof AS (SELECT rid, sha256(string_agg(a || b, '' ORDER BY level)) AS proof FROM runs GROUP BY rid),
fold AS (
  SELECT rid, 0 AS level, CASE WHEN coalesce(tampered, false) THEN changed ELSE leaf END AS h FROM p
  UNION ALL
  SELECT rid, f.level + 1, sha256(a || h || b) FROM fold f JOIN runs USING (rid, level)),
folded AS (SELECT rid, arg_max(h, level) AS h FROM fold GROUP BY rid)
SELECT p.doc_id, p.leaf, s.subroot, root.root, coalesce(proof, sha256('')) AS proof_sha256,
       folded.h AS folded_root, folded.h = root.root AS verified
FROM p JOIN s ON s.source IS NOT DISTINCT FROM p.source JOIN folded USING (rid) LEFT JOIN proof USING (rid)
CROSS JOIN root""")
def op11(spark, sf_dir):
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    text = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle_manifest(documents(spark, sf_dir), {"text": text})


@_register("op12_spelling_variants", r"""
WITH RECURSIVE tab AS MATERIALIZED (SELECT """ + _CRC + r""" AS crc),
runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY 1, 2),
coded AS MATERIALIZED (
  SELECT run, n, xor(list_reduce([4294967295::UBIGINT] || list_transform(
             regexp_extract_all(hex(encode(concat(doc_id, ':', run))), '..'),
             lambda x: ('0x' || x)::UBIGINT),
           lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255)::BIGINT + 1])), 4294967295::UBIGINT) AS h
  FROM runs, tab),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN
                 substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
               ELSE run END AS word, n FROM coded)
  WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
cut AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON b.word = a.rest
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON b.word = a.rest),
best AS (SELECT word, count(*) AS n_near, max(n) AS top FROM near GROUP BY 1),
firsts AS (SELECT near.word, min(near) AS form FROM near JOIN best USING (word) WHERE n = top GROUP BY 1),
rows AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN top >= 5 * w.n THEN firsts.form END AS form,
         CASE WHEN top >= 5 * w.n THEN top END AS form_n
  FROM words w LEFT JOIN best USING (word) LEFT JOIN firsts USING (word)),
way AS (
  SELECT word, word AS root, 0 AS steps FROM rows
  UNION ALL SELECT way.word, rows.form, steps + 1 FROM way JOIN rows ON rows.word = way.root
  WHERE rows.form IS NOT NULL)
SELECT rows.word, form, root, n, n_near, form_n
FROM rows JOIN (SELECT word, arg_max(root, steps) AS root FROM way GROUP BY 1) USING (word)""")
def op12(spark, sf_dir):
    words = spelled_words(documents(spark, sf_dir), slips=199)
    return spelling_variants(words.filter(F.col("n") >= LEAST_COUNT))


@_register("op13_nearest_neighbours")
def op13(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(vectors, vectors.filter(F.pmod("vec_id", F.lit(20)) == 0))
