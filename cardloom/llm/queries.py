"""Registered queries of the corpus operators, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm import bpe, filteraudit, fingerprints, language, mixing, ngramjoin, pii, quality, repair, repair_sql, secretscan, vectors, webtext, wordpiece
from cardloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


@query()
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query()
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webtext.extract(table(spark, sf_dir, "pages"))


@query()
def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scan(table(spark, sf_dir, "documents"))


@query("""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT source, source_size, ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS w FROM s),
-- the sources by the level at which they reach their cap; the level holds from the first one that it leaves uncapped
c AS (
  SELECT *, 2.0::DOUBLE * source_size / w AS ratio,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / sum(w) OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM r),
l AS (SELECT arg_min(level, ratio) AS level FROM c WHERE ratio > level),
t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, coalesce((SELECT level FROM l), 0) * w) AS target FROM r),
b AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0::BIGINT
            ELSE (budget // source_size) * size + greatest(0, least(size, budget - (budget // source_size) * source_size - before)) END AS taken
FROM b
""")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(table(spark, sf_dir, "documents"))


@query()
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.near_duplicates(table(spark, sf_dir, "documents")).drop("rid")


@query()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = quality.fit(docs, table(spark, sf_dir, "labels"), ~quality.held_out())
    scores = quality.scored(docs, machine, ["doc_id"])
    return scores.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.GOOD).cast("int").alias("predicted"))


@query()
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = quality.held_out(folds=3, fold=1)
    return language.predicted(docs, language.fit(docs, ~kept), ["doc_id"]).select("doc_id", kept.alias("held_out"), "lang_pred", "score")


@query("""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
f AS (
  SELECT doc_id, part,
         (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
         + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS fails
  FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (
  SELECT a.c || b.c || d.c || e.c || g.c AS filter_order FROM x a, x b, x d, x e, x g
  WHERE len(list_distinct([a.c, b.c, d.c, e.c, g.c])) = 5),
s AS (
  SELECT filter_order, step::INT AS step, 1 << (ascii(filter_order[step]) - 65) AS bit,
         list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))) AS earlier
  FROM o, range(1, 6) r(step)),
c AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER ((fails & (coalesce(earlier, 0)::INT | bit)) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER ((fails & bit) > 0 AND (fails & coalesce(earlier, 0)::INT) = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER ((fails & bit) > 0 AND (fails & coalesce(earlier, 0)::INT) > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (fails = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER ((fails & bit) > 0 AND (fails & coalesce(earlier, 0)::INT) = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER ((fails & bit) > 0 AND (fails & coalesce(earlier, 0)::INT) = 0), 0)::BIGINT AS toxic_lost
  FROM m, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM c
""")
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.scan(docs, pii.fit(docs))


@query(repair_sql.SQL)
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(table(spark, sf_dir, "conversations"))
