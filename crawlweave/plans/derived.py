"""Inputs in the shape of tasks, topics, results and logs, derived from the given tables.

One SQL text per view serves both engines: ``@name`` is a given table, ``@ts`` the word for a timestamp without
zone. Every view covers its whole source tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("pages", "documents", "embeddings", "events", "part")

VIEWS = {
    # Tasks for every page; a second task for each, for a third of them under the same address.
    "v_tasks": """
SELECT page_id AS seq, url, CAST(page_id % 5 AS INT) AS depth,
       CASE WHEN page_id % 4 = 0 THEN 'high' ELSE 'normal' END AS priority,
       regexp_extract(url, '^(https?://[^/?#]+)', 1) AS origin
FROM @pages
UNION ALL
SELECT page_id + 1000000000, CASE WHEN page_id % 3 = 0 THEN url ELSE concat(url, '/again') END,
       CAST((page_id + 1) % 5 AS INT), 'normal', regexp_extract(url, '^(https?://[^/?#]+)', 1)
FROM @pages""",
    "v_queue": """
SELECT CASE page_id % 10 WHEN 0 THEN 'crawl.priority' WHEN 1 THEN 'crawl.revisit'
         WHEN 2 THEN 'crawl.initial.retry.30s' WHEN 3 THEN 'crawl.initial.retry.5m'
         ELSE 'crawl.initial' END AS topic,
       page_id AS seq,
       @ts '2024-01-01 00:00:00' + page_id * interval '1' minute AS ts,
       regexp_extract(url, '^(https?://[^/?#]+)', 1) AS key,
       CASE WHEN page_id % 10 IN (2, 3) THEN CAST(page_id % 5 AS VARCHAR(10)) END AS attempts,
       CASE page_id % 25
         WHEN 5  THEN NULL
         WHEN 7  THEN '{bad'
         WHEN 11 THEN '{"url":"' || url || '"}'
         WHEN 13 THEN '{"url":"' || url || '","depth":-1}'
         WHEN 15 THEN '{"url":"' || url || '","depth":1.0}'
         WHEN 16 THEN '{"url":"' || url || '","depth":1.5}'
         WHEN 17 THEN '{"url":"' || url || '","depth":1,"x":true}'
         WHEN 19 THEN '{"url":"' || url || '","depth":"1"}'
         WHEN 21 THEN '{"url":"' || url || '","depth":1,"priority":"urgent"}'
         WHEN 22 THEN '{"url":"not a uri","depth":1}'
         WHEN 23 THEN '[1]'
         ELSE '{"url":"' || url || '","depth":' || CAST(page_id % 5 AS VARCHAR(10)) || '}' END AS value
FROM @pages""",
    "v_fetch_log": """
SELECT event_id, 'https://s' || CAST(user_id % 20 AS VARCHAR(10)) || '.example.com' AS origin,
       CAST(event_id % 3 AS INT) AS attempt,
       ts AS started_at, ts + CAST(floor(value) AS INT) * interval '1' second AS ended_at,
       CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 301 WHEN 'signup' THEN 404
         WHEN 'purchase' THEN 429 ELSE 503 END AS status
FROM @events""",
    "v_outcomes": """
SELECT event_id, ts,
       CASE CAST(event_id % 5 AS INT) WHEN 0 THEN 'labeled' WHEN 1 THEN 'pages' WHEN 2 THEN 'lake'
         WHEN 3 THEN 'embed' ELSE 'worker' END AS stage,
       CASE WHEN event_type = 'error' THEN 'dlq' WHEN event_type = 'signup' THEN 'retry' ELSE 'ok' END AS outcome,
       CASE WHEN event_type = 'error' THEN CASE CAST(event_id % 3 AS INT) WHEN 0 THEN 'json' WHEN 1 THEN 'schema'
              ELSE 'result_schema' END
            WHEN event_type = 'signup' THEN 'extract' END AS reason,
       CASE WHEN user_id % 2 = 0 THEN 'css' ELSE 'ai' END AS mode, 'kafka' AS queue,
       CAST(user_id % 7 AS INT) AS n_links
FROM @events""",
    # Robots texts per origin; some origins have none.
    "v_robots": """
SELECT origin, CASE first_page % 6
         WHEN 0 THEN 'User-agent: *' || chr(10) || 'Disallow: /'
         WHEN 1 THEN 'User-agent: *' || chr(10) || 'Disallow: /en/' || chr(10) || 'Allow: /en/1'
         WHEN 2 THEN 'User-agent: other' || chr(10) || 'Disallow: /'
         WHEN 3 THEN 'User-agent: other' || chr(10) || 'User-agent: *' || chr(10) || 'Disallow: /*.html$ # files' || chr(10) || 'Disallow:'
         WHEN 4 THEN '' END AS body
FROM (SELECT regexp_extract(url, '^(https?://[^/?#]+)', 1) AS origin, min(page_id) AS first_page
      FROM @pages GROUP BY 1) a""",
    "v_results": """
SELECT doc_id AS seq,
       'https://www.h' || CAST(doc_id % 7 AS VARCHAR(10)) || '.example.com/' || lang ||
         CASE WHEN doc_id % 3 = 0 THEN '/auktion/' ELSE '/' END || source ||
         CASE WHEN doc_id % 2 = 0 THEN '/' || CAST(doc_id AS VARCHAR(10)) ELSE '/about' END ||
         CASE WHEN doc_id % 4 = 0 THEN '?page=2' ELSE '' END AS url,
       CASE doc_id % 11 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'Title ' || CAST(doc_id AS VARCHAR(10)) END AS title,
       CASE WHEN doc_id % 13 = 0 THEN NULL ELSE text END AS text,
       @ts '2024-01-01 00:00:00' + doc_id * interval '7' minute AS fetched_at
FROM @documents""",
    # A second version of every result, for a third of them under the same address.
    "v_enriched_versions": """
SELECT seq, url, title, text, fetched_at,
       CASE WHEN seq % 17 = 0 THEN NULL WHEN seq % 2 = 0 THEN 'product' ELSE 'page' END AS detected_type
FROM v_results
UNION ALL
SELECT seq + 1000000000, CASE WHEN seq % 3 = 0 THEN url ELSE 'https://second.example.com/da/' || CAST(seq AS VARCHAR(10)) END,
       'Second ' || CAST(seq AS VARCHAR(10)), text, fetched_at + interval '1' day, 'page'
FROM v_results""",
    "v_enriched": """
SELECT seq, url, title, text, fetched_at, detected_type
FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq DESC) AS rn FROM v_enriched_versions) x
WHERE rn = 1""",
    "v_graph_pages": """
SELECT p_partkey AS k, p_size,
       'https://h' || CAST(p_partkey % 7 AS VARCHAR(10)) || '.example.com/p/' || CAST(p_partkey AS VARCHAR(10)) AS url,
       '<html><head><title>' || p_name || '</title></head><body><p>' || p_name || ' ' ||
         CASE WHEN p_partkey % 50 = 49 THEN 'same text' ELSE CAST(p_partkey AS VARCHAR(10)) END || '</p>' ||
         '<a href="/p/' || CAST(p_partkey + 7 AS VARCHAR(10)) || '">a</a>' ||
         '<a href="/p/' || CAST(p_partkey + 14 AS VARCHAR(10)) || '#x">b</a>' ||
         '<a href="/p/' || CAST(p_partkey * 8 AS VARCHAR(10)) || '">c</a>' ||
         '<a href="https://h' || CAST((p_partkey + 1) % 7 AS VARCHAR(10)) || '.example.com/p/' || CAST(p_partkey + 1 AS VARCHAR(10)) || '">off</a>' ||
         '</body></html>' AS html
FROM @part""",
    # A task for every page of the graph; those of large parts are too deep, so links alone can reach them.
    "v_graph_tasks": """
SELECT k AS seq, url, CASE WHEN p_size <= 2 THEN 0 ELSE 9 END AS depth FROM v_graph_pages""",
    "v_results_raw": """
SELECT doc_id AS seq,
       '{"sitesUrl":' || CASE doc_id % 20 WHEN 3 THEN '5' WHEN 4 THEN '"not a uri"' ELSE '"https://h.example.com/' || CAST(doc_id AS VARCHAR(10)) || '"' END ||
       CASE doc_id % 20 WHEN 5 THEN ',"title":7' WHEN 6 THEN ',"title":null' WHEN 7 THEN '' ELSE ',"title":"T"' END ||
       CASE doc_id % 20 WHEN 8 THEN ',"body":null' WHEN 9 THEN ',"body":{"children":[]}' WHEN 10 THEN ',"body":{"children":{}}'
         WHEN 11 THEN ',"body":"x"' ELSE ',"body":{"children":[{"text":"t' || CAST(doc_id AS VARCHAR(10)) || '"}]}' END ||
       CASE doc_id % 20 WHEN 12 THEN ',"html":null' ELSE ',"html":""' END ||
       CASE doc_id % 20 WHEN 13 THEN '' WHEN 14 THEN ',"meta":null'
         ELSE ',"meta":{"fetchedAt":"' || CASE doc_id % 20 WHEN 15 THEN 'yesterday' ELSE '2024-01-01T00:00:00.000Z' END ||
              '","domain":"h.example.com","selector_mode":"ai"' ||
              CASE doc_id % 20 WHEN 16 THEN '' ELSE ',"contentHash":"c"' END ||
              CASE doc_id % 20 WHEN 17 THEN ',"aiConfidence":null' WHEN 18 THEN ',"aiConfidence":"high"' ELSE '' END || '}' END ||
       CASE doc_id % 20 WHEN 19 THEN ',"other":1}' ELSE '}' END AS value
FROM @documents""",
    "v_enriched_raw": """
SELECT seq, substr(value, 1, length(value) - 1) ||
       CASE seq % 7 WHEN 1 THEN ',"detectedType":"product"}' WHEN 2 THEN ',"detectedType":"page"}'
         WHEN 3 THEN ',"detectedType":"auction"}' WHEN 4 THEN ',"detectedType":null}' ELSE '}' END AS value
FROM v_results_raw""",
}


def _needed(sql: str) -> list[str]:
    """Views a text uses, each after the views it uses itself."""
    order: list[str] = []
    for name in re.findall(r"\bv_[a-z_]+\b", sql):
        if name in VIEWS and name not in order:
            order += [n for n in _needed(VIEWS[name]) if n not in order]
            order.append(name)
    return order


def _with(sql: str) -> str:
    """Put the views a query uses in front of it, before its own WITH parts if it has any."""
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in _needed(sql)]
    body = sql.strip()
    if not parts:
        return body
    if body.startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


def duckdb_text(sql: str) -> str:
    """A check query with its views, for the given tables' own names."""
    return re.sub(r"@(\w+)", r"\1", _with(sql).replace("@ts", "timestamp"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A derived view over the Parquet tables of a folder."""
    sql = _with(f"SELECT * FROM {name}").replace("@ts", "timestamp_ntz")
    for source in TABLES:
        if f"@{source}" in sql:
            table(spark, folder, source).createOrReplaceTempView(f"src_{source}")
            sql = sql.replace(f"@{source}", f"src_{source}")
    return spark.sql(sql)
