"""Queries over pages and texts: extraction, content dedupe, labels, vectors, crawl."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweave.functions.urls import hostname_of
from crawlweave.operators import embed as embedding
from crawlweave.operators import enrich, extract, gates, vectors
from crawlweave.operators.dedupe import new_content
from crawlweave.operators.validate import parse_results
from crawlweave.plans.derived import table, view
from crawlweave.plans.frontier import crawl_frontier
from crawlweave.plans.registry import query
from crawlweave.session import scratch_path

# Text of markup without a parser: enough for the given pages.
_CLEAN = (r"trim(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace({x}, '<[^>]*>', '', 'g'), '&copy;', '©'), "
          r"'&middot;', '·'), '&quot;', chr(34)), '&amp;?', '&', 'g'), '[\t-\r\x20\x{{a0}}]+', ' ', 'g'))")
_BODY = _CLEAN.format(x="regexp_replace(substr(html, strpos(html, '<body>') + 6), '<!--.*?-->', '', 'gs')")
_TITLE = "nullif(trim(" + _CLEAN.format(x="regexp_extract(html, '(?s)<title>(.*?)</title>', 1)") + "), '')"
_LINK = (r"regexp_extract(url, '^(https?://[^/?#]+)', 1) || replace(replace(url_encode(h), '%2F', '/'), '%2C', ',')")
_EXTRACTED = f"""
extracted AS (
  SELECT page_id, url, html, {_TITLE} AS title, {_BODY} AS text,
    list_distinct(list_transform(regexp_extract_all(html, '<a href="([^"]*)"', 1), lambda h: {_LINK})) AS links
  FROM @pages)"""


def extracted(spark, folder):
    return extract.extract_pages(table(spark, folder, "pages"))


@query("extract_pages", f"""WITH {_EXTRACTED.strip()}
SELECT page_id, url, title, text, array_to_string(list_sort(links), ' ') AS links, sha256(text) AS content_hash,
  substr(sha1(substr(text, 1, 5000)), 1, 16) AS simhash
FROM extracted""")
def extract_pages(spark, folder):
    return extracted(spark, folder).select(
        "page_id", "url", "title", "text", F.array_join(F.array_sort("links"), " ").alias("links"), "content_hash",
        F.col("fingerprint").alias("simhash"))


_SELECTED = _CLEAN.format(
    x="""array_to_string(list_concat(regexp_extract_all(html, '(?s)<div class="ad">(.*?)</div>', 1),
         regexp_extract_all(html, '(?s)<h1>(.*?)</h1>', 1)), ' ')""")


@query("extract_selected", f"""
SELECT page_id, url, text, sha256(text) AS content_hash, CAST(0 AS INT) AS n_links
FROM (SELECT page_id, url, {_SELECTED} AS text FROM @pages) x""")
def extract_selected(spark, folder):
    found = extract.extract_pages(table(spark, folder, "pages"), selectors=".ad, h1")
    return found.select("page_id", "url", "text", "content_hash", F.size("links").alias("n_links"))


@query("fingerprints", """
SELECT doc_id, sha256(text) AS content_hash, substr(sha1(substr(text, 1, 5000)), 1, 16) AS simhash FROM @documents""")
def fingerprints(spark, folder):
    docs = extract.fingerprints(table(spark, folder, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "content_hash", F.col("fingerprint").alias("simhash"))


_PRODUCT = r"(lower(url) LIKE '%/auktion/%' OR regexp_matches(lower(url), '/[0-9]+(\?.*)?$'))"


@query("classify_pages", f"""
SELECT page_id, url, CASE WHEN {_PRODUCT} THEN 'product' ELSE 'page' END AS label,
  CASE WHEN {_PRODUCT} THEN CAST(0.85 AS DOUBLE) ELSE CAST(0.6 AS DOUBLE) END AS confidence
FROM @pages""")
def classify_pages(spark, folder):
    return enrich.classify(table(spark, folder, "pages").select("page_id", "url"))


@query("priority_tasks", f"""
SELECT 'crawl.priority' AS topic, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS key,
  '{{"url":"' || url || '","depth":0,"priority":"high"}}' AS value
FROM @pages WHERE {_PRODUCT}""")
def priority_tasks(spark, folder):
    return enrich.priority_tasks(enrich.classify(table(spark, folder, "pages").select("url")))


@query("custom_classifier", """
SELECT page_id, url, CASE WHEN ends_with(url, '.html') THEN 'product' ELSE 'page' END AS label,
  CAST(length(html) AS DOUBLE) / 100000 AS confidence
FROM @pages""")
def custom_classifier(spark, folder):
    @F.pandas_udf("label string, confidence double")
    def by_ending(url: pd.Series, text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"label": url.str.endswith(".html").map({True: "product", False: "page"}),
                             "confidence": text.str.len() / 100000})

    return enrich.classify(table(spark, folder, "pages"), by_ending, text="html").select(
        "page_id", "url", "label", "confidence")


@query("embed_text", """
SELECT doc_id, CAST(s AS INT) AS slot,
  round(coalesce(list_sum(list_transform(chars[s + 1:-:16], lambda c: unicode(c))), 0) / 255.0, 6) AS value
FROM (SELECT doc_id, string_split(text, '') AS chars FROM @documents) d, range(16) r(s)""")
def embed_text(spark, folder):
    docs = embedding.embed(table(spark, folder, "documents").select("doc_id", "text"), dim=16)
    return docs.select("doc_id", F.posexplode("embedding").alias("slot", "value")).select(
        "doc_id", "slot", F.round("value", 6).alias("value"))


@query("custom_embedder", """
SELECT doc_id, CAST(s AS INT) AS slot, CAST(length(low) - length(replace(low, chr(CAST(97 + s AS INT)), '')) AS DOUBLE) AS value
FROM (SELECT doc_id, text AS low FROM @documents) d, range(26) r(s)""")
def custom_embedder(spark, folder):
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def letters(texts: pd.Series) -> pd.Series:
        return pd.Series([[float(text.count(chr(97 + i))) for i in range(26)] for text in texts])

    docs = embedding.embed(table(spark, folder, "documents").select("doc_id", "text"), letters, dim=26)
    return docs.select("doc_id", F.posexplode("embedding").alias("slot", "value"))


@query("nonempty_text", """
SELECT seq, json_extract_string(value, '$.body.children[0].text') AS text FROM v_results_raw
WHERE json_extract_string(value, '$.body.children[0].text') <> ''""")
def nonempty_text(spark, folder):
    docs = parse_results(view(spark, folder, "v_results_raw"))
    return gates.nonempty_text(docs).select("seq", "text")


@query("new_content", """
SELECT doc_id, sha256(text) AS content_hash FROM (
  SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM @documents) d
WHERE rn = 1 AND text NOT IN (SELECT text FROM @documents WHERE source = 'src0')""")
def content_first_seen(spark, folder):
    docs = extract.fingerprints(table(spark, folder, "documents").select("doc_id", "source", "text"))
    docs = docs.select("doc_id", "source", "content_hash")
    seen = docs.filter(F.col("source") == "src0").select("content_hash")
    return new_content(docs, seen, order=("doc_id",)).select("doc_id", "content_hash")


def _wave(n: int) -> str:
    """One wave of the crawl as SQL: due urls, first content, the links that follow."""
    before = " UNION ALL ".join(f"SELECT url, h FROM f{i}" for i in range(n))
    unseen = f"WHERE url NOT IN (SELECT url FROM ({before}) b)" if n else ""
    new_only = f"WHERE h NOT IN (SELECT h FROM ({before}) b WHERE h IS NOT NULL)" if n else ""
    return f"""
f{n} AS MATERIALIZED (SELECT t.url, t.depth, p.h FROM (SELECT url, min(depth) AS depth FROM t{n} {unseen} GROUP BY url) t LEFT JOIN p ON p.url = t.url),
n{n} AS MATERIALIZED (SELECT min(url) AS url FROM (SELECT * FROM f{n} WHERE h IS NOT NULL) x {new_only} GROUP BY h),
t{n + 1} AS MATERIALIZED (SELECT DISTINCT link AS url, f.depth + 1 AS depth FROM f{n} f JOIN n{n} USING (url) JOIN l USING (url) WHERE f.depth + 1 <= 3)"""


CRAWL_WAVES = "WITH " + ",".join([
    """p AS MATERIALIZED (SELECT url, sha256(regexp_extract(html, '<p>(.*?)</p>', 1) || 'abcoff') AS h FROM v_graph_pages),
l AS MATERIALIZED (SELECT DISTINCT url, regexp_extract(url, '^(https?://[^/]+)', 1) || regexp_extract(href, '^([^#]*)', 1) AS link
  FROM (SELECT url, unnest(regexp_extract_all(html, '<a href="(/[^"]*)"', 1)) AS href FROM v_graph_pages) x),
t0 AS MATERIALIZED (SELECT url, depth FROM v_graph_tasks WHERE depth <= 3)"""] + [_wave(n) for n in range(4)])
_CRAWL = CRAWL_WAVES + """
SELECT url, CAST(depth AS BIGINT) AS depth, wave, CASE WHEN h IS NULL THEN 'retry' ELSE 'ok' END AS outcome,
  h AS content_hash, url IN (SELECT url FROM n0 UNION ALL SELECT url FROM n1 UNION ALL SELECT url FROM n2 UNION ALL SELECT url FROM n3) AS fresh
FROM (""" + " UNION ALL ".join(f"SELECT url, depth, h, {n} AS wave FROM f{n}" for n in range(4)) + ") w"


@query("crawl_frontier", _CRAWL)
def crawl(spark, folder):
    tasks = view(spark, folder, "v_graph_tasks")
    snapshot = view(spark, folder, "v_graph_pages").select("url", "html")
    found = crawl_frontier(spark, tasks, snapshot, scratch_path(spark, "crawl"))
    return found.select("url", "depth", "wave", "outcome", "content_hash", "fresh")


def vector_table(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("string").alias("url"), F.concat(F.lit("Vector "), F.col("vec_id").cast("string")).alias("title"),
        F.col("label").cast("string").alias("detected_type"), "embedding")


@query("similar_pages", """
SELECT CAST(e.vec_id AS VARCHAR) AS url, 'Vector ' || e.vec_id AS title, CAST(e.label AS VARCHAR) AS detected_type,
  round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])), 6) AS cosine_sim
FROM @embeddings e, (SELECT embedding FROM @embeddings WHERE vec_id = 7) r
WHERE e.vec_id <> 7 ORDER BY list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])) DESC, 1 LIMIT 10""")
def similar_pages(spark, folder):
    found = vectors.similar_pages(vector_table(spark, folder), "7")
    return found.withColumn("cosine_sim", F.round("cosine_sim", 6))


@query("ivf_build")
def ivf_build(spark, folder):
    """Index rows with their list; checked by tests (nearest list, no row lost)."""
    path = scratch_path(spark, "ivf")
    vectors.ivf_build(vector_table(spark, folder), path, lists=10)
    return spark.read.parquet(f"{path}/rows").select("url", "list_id")


@query("ivf_search", """
SELECT query_id, CAST(rank AS INT) AS rank, url, round(distance, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, url) AS rank FROM (
    SELECT q.vec_id AS query_id, CAST(e.vec_id AS VARCHAR) AS url,
      list_distance(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS distance
    FROM @embeddings e, @embeddings q) d) x
WHERE rank <= 10""")
def ivf_search(spark, folder):
    path = scratch_path(spark, "ivf")
    vectors.ivf_build(vector_table(spark, folder), path, lists=10)
    queries = table(spark, folder, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    found = vectors.ivf_search(spark, path, queries, k=10, nprobe=10)
    return found.withColumn("distance", F.round("distance", 6))


@query("ivf_search_probed")
def ivf_search_probed(spark, folder):
    """The same with 3 of 10 lists per query: approximate, recall is checked by a test."""
    path = scratch_path(spark, "ivf")
    vectors.ivf_build(vector_table(spark, folder), path, lists=10)
    queries = table(spark, folder, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    return vectors.ivf_search(spark, path, queries, k=10, nprobe=3).withColumn("distance", F.round("distance", 6))


_FLAGSHIP = f"""WITH {_EXTRACTED.strip()},
firsts AS (SELECT url, text, row_number() OVER (PARTITION BY text ORDER BY page_id) AS rn FROM extracted)
SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS domain, CASE WHEN {_PRODUCT} THEN 'product' ELSE 'page' END AS label,
  count(*) AS n_pages, CAST(sum(length(text)) AS BIGINT) AS n_chars
FROM firsts WHERE rn = 1 GROUP BY 1, 2"""


@query("pages_by_domain", _FLAGSHIP)
def pages_by_domain(spark, folder):
    """Extraction, content dedupe and labels in one plan; text itself is gone before the first shuffle."""
    pages = extracted(spark, folder).select("page_id", "url", "content_hash", F.length("text").alias("n"))
    fresh = enrich.classify(new_content(pages, order=("page_id",)))
    return (fresh.groupBy(hostname_of(F.col("url")).alias("domain"), "label")
            .agg(F.count("*").alias("n_pages"), F.sum("n").alias("n_chars")))
