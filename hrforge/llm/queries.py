"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hrforge.llm import (bpe, exact_dedup, lm_score, merkle, merkle_sql, ngram_join, packing, phrases, quality_forest, secrets,
                         substring_dedup, surrogates, toxicity, warc_zip)
from hrforge.llm.common import documents, labels

#: Key of the surrogates of the registered query; a deployment passes its own.
SURROGATE_KEY = b"hrforge registered query"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(documents(spark, sf_dir))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_pii(documents(spark, sf_dir), SURROGATE_KEY)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir), texts=False)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = toxicity.score(docs, toxicity.train(docs, labels(spark, sf_dir)))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "toxic_spans")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_forest.judge(documents(spark, sf_dir), labels(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(documents(spark, sf_dir)).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op11_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc_zip.archived(spark, pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return merkle.verify(merkle.prove(docs, merkle.without_newlines(docs)))


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_lm_scoring, op3_bpe, op4_pii_surrogates, op5_substring_dedup, op6_ngram_join, op7_toxicity,
    op8_quality_rules, op9_exact_dedup, op10_secret_scan, op11_warc_zip,
    op12_phrase_collocations, op13_merkle_manifest)}

ORACLES = {
    # base32 of the SHA-1: four letters of five bits for every five hexadecimal digits
    "op11_warc_zip": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
r AS (
  SELECT page_id, strlen(html) AS payload_bytes,
         list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(h, (i // 4 * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), 'string_agg', '') AS payload_digest,
         max(page_id) OVER (PARTITION BY html) AS last,
         row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST) AS nth
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN nth > 1 THEN last END AS refers_to
FROM r""",
    "op12_phrase_collocations": """
WITH w AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(piece, '[ \t]'), lambda x: x <> '') AS words
  FROM (SELECT lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\v\f\r]')) AS piece
        FROM documents)),
spot AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w),
f AS (
  SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, m, count(*) AS f
  FROM spot, range(1, 6) t(m) WHERE i + m - 1 <= len(words) GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(words)) AS n FROM w GROUP BY lang),
c AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS words FROM f WHERE m > 1),
cut AS (
  SELECT c.lang, c.phrase, c.words, c.m, c.a, l.f AS l, r.f AS r, n.n, k,
         ((1000::HUGEINT * c.a * n.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM c JOIN n USING (lang), range(1, 5) t(k), f l, f r
  WHERE k < c.m AND l.lang = c.lang AND r.lang = c.lang AND l.phrase = array_to_string(c.words[1:k], ' ')
    AND r.phrase = array_to_string(c.words[k + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT c.lang, array_to_string(c.words[i:i + s - 1], ' ') AS phrase, max(c.a) AS longer
  FROM c, range(2, 5) t(s), range(1, 5) u(i) WHERE s < c.m AND i + s - 1 <= c.m GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n::BIGINT AS n, score
FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= 2000""",
    "op13_merkle_manifest": merkle_sql.ORACLE,
    "op9_exact_dedup": """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM n""",
}
