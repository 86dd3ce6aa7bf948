"""The operators over the given tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crawlweave.llm import (chat, codes, forest, hpylm, jaccard, language, mixing, packing, repair, reputation, sharding, tokens,
                           topk)
from crawlweave.llm.common import table
from crawlweave.session import apply_defaults

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, source: str, sql: str | None = None):
    def register(fn: Callable[[DataFrame], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(table(apply_defaults(spark), folder, source))
        if sql:
            ORACLES[name] = sql
        return fn
    return register


EXTRA_CONVERSATION = "\\### Assistant: </turn> ok"


@_query("op1_chat_windows", "conversations")
def op1(turns: DataFrame) -> DataFrame:
    spark = turns.sparkSession
    more = spark.range(2).selectExpr(
        "cast(-7 as long) as conv_id", "id as turn", "if(id = 0, 'user', 'assistant') as role",
        f"r'{EXTRA_CONVERSATION}' as text")
    every = turns.select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.conversation_digests(chat.stored_windows(every))


@_query("op2_balanced_shards", "documents")
def op2(docs: DataFrame) -> DataFrame:
    return sharding.shard_documents(docs).drop("link")


@_query("op3_top_inner_products", "embeddings", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op3(rows: DataFrame) -> DataFrame:
    return topk.top_inner_products(rows)


@_query("op4_mixed_sources", "documents")
def op4(docs: DataFrame) -> DataFrame:
    return mixing.mix_sources(docs.select("doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken")


@_query("op5_nearest_neighbours", "embeddings")
def op5(rows: DataFrame) -> DataFrame:
    return forest.nearest_neighbours(rows)


@_query("op6_token_files", "documents")
def op6(docs: DataFrame) -> DataFrame:
    return tokens.tokenized(docs)


@_query("op7_languages", "documents")
def op7(docs: DataFrame) -> DataFrame:
    return language.identify_languages(docs)


@_query("op8_packed_sequences", "documents")
def op8(docs: DataFrame) -> DataFrame:
    return packing.pack_documents(docs).drop("piece")


@_query("op9_text_scores", "documents")
def op9(docs: DataFrame) -> DataFrame:
    return hpylm.score_texts(docs)


@_query("op10_similar_documents", "documents")
def op10(docs: DataFrame) -> DataFrame:
    return jaccard.jaccard_components(docs)


def op11(spark: SparkSession, folder: str) -> DataFrame:
    apply_defaults(spark)
    return reputation.judge_urls(table(spark, folder, "pages"), table(spark, folder, "labels"))


QUERIES["op11_url_filters"] = op11
ORACLES["op11_url_filters"] = """
WITH p AS (
  SELECT row_number() OVER () AS rn, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest
  FROM pages),
u AS (
  SELECT rn, page_id,
    translate(coalesce(regexp_extract(rest, '^[^/?#]*', 0), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p),
rules(rh, rp, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT u.rn, rules.rh || rules.rp AS rule, rules.verdict,
    row_number() OVER (PARTITION BY u.rn ORDER BY length(rules.rh || rules.rp) DESC, rules.verdict = 'block' DESC,
                       rules.rh || rules.rp) AS pick
  FROM u JOIN rules ON (u.host = rules.rh OR ends_with(u.host, '.' || rules.rh)) AND starts_with(u.path, rules.rp)),
o AS (
  SELECT doc_id, count(*) AS n, sum(bad) AS k FROM (
    SELECT doc_id, CASE WHEN toxic = 1 OR quality = 0 THEN 1 WHEN toxic = 0 OR quality = 1 THEN 0 END AS bad FROM labels)
  WHERE bad IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
h0 AS (
  SELECT u.host, coalesce(sum(o.n), 0)::DOUBLE AS n, coalesce(sum(o.k), 0)::DOUBLE AS k FROM u LEFT JOIN o ON u.page_id = o.doc_id
  GROUP BY u.host),
h AS (
  SELECT host, array_to_string(list_slice(string_split(host, '.'), greatest(len(string_split(host, '.')) - 1, 1),
                                          len(string_split(host, '.'))), '.') AS domain,
    string_split(host, '.')[-1] AS suffix, n, k FROM h0),
g AS (SELECT CASE WHEN sum(n) > 0 THEN sum(k) / sum(n) ELSE 0.0 END AS rate FROM h),
s0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT rate FROM g) AS prior FROM h GROUP BY suffix),
ms AS (SELECT 1.0 / least(greatest(CASE WHEN w > 0 THEN (d - e) / w ELSE 1e-4 END, 1e-4), 1.0) - 1.0 AS m FROM (
  SELECT sum((k - n * prior) ^ 2) AS d, coalesce(sum(n * prior * (1 - prior)), 0) AS e,
         coalesce(sum(n * (n - 1) * prior * (1 - prior)), 0) AS w FROM s0 WHERE n > 0)),
s AS (SELECT suffix, (k + (SELECT m FROM ms) * prior) / (n + (SELECT m FROM ms)) AS mean FROM s0),
d0 AS (SELECT domain, h.suffix, sum(n) AS n, sum(k) AS k, any_value(s.mean) AS prior FROM h JOIN s ON h.suffix = s.suffix
       GROUP BY domain, h.suffix),
md AS (SELECT 1.0 / least(greatest(CASE WHEN w > 0 THEN (d - e) / w ELSE 1e-4 END, 1e-4), 1.0) - 1.0 AS m FROM (
  SELECT sum((k - n * prior) ^ 2) AS d, coalesce(sum(n * prior * (1 - prior)), 0) AS e,
         coalesce(sum(n * (n - 1) * prior * (1 - prior)), 0) AS w FROM d0 WHERE n > 0)),
dm AS (SELECT domain, suffix, (k + (SELECT m FROM md) * prior) / (n + (SELECT m FROM md)) AS mean FROM d0),
h1 AS (SELECT h.host, h.n, h.k, dm.mean AS prior FROM h JOIN dm ON h.domain = dm.domain AND h.suffix = dm.suffix),
mh AS (SELECT 1.0 / least(greatest(CASE WHEN w > 0 THEN (d - e) / w ELSE 1e-4 END, 1e-4), 1.0) - 1.0 AS m FROM (
  SELECT sum((k - n * prior) ^ 2) AS d, coalesce(sum(n * prior * (1 - prior)), 0) AS e,
         coalesce(sum(n * (n - 1) * prior * (1 - prior)), 0) AS w FROM h1 WHERE n > 0)),
ab AS (SELECT host, k + (SELECT m FROM mh) * prior AS a, n - k + (SELECT m FROM mh) * (1 - prior) AS b FROM h1),
rep AS (SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) ^ 2 * (a + b + 1))) > 0.5 AS bad_host FROM ab)
SELECT u.page_id, u.host, u.path, f.rule,
  coalesce(f.verdict, CASE WHEN coalesce(rep.bad_host, false) THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN (SELECT * FROM fits WHERE pick = 1) f ON u.rn = f.rn LEFT JOIN rep ON u.host = rep.host
"""


@_query("op13_vector_codes", "embeddings")
def op13(rows: DataFrame) -> DataFrame:
    return codes.compress_vectors(rows)


@_query("op12_conversation_repair", "conversations")
def op12(turns: DataFrame) -> DataFrame:
    return repair.repaired_table(turns)
