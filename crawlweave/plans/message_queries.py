"""Queries over tasks and messages: topics, validation, gates, retries."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlweave.operators import gates, routing, validate
from crawlweave.operators.dedupe import new_urls
from crawlweave.operators.extract import extract_pages, fingerprints, page_results
from crawlweave.operators.links import same_origin_links
from crawlweave.options import MAX_DEPTH, TASK_TOPICS
from crawlweave.plans.derived import table, view
from crawlweave.plans.registry import query
from crawlweave.session import scratch_path
from crawlweave.sources import snapshot, topics

_TASK_TOPICS = "('crawl.priority', 'crawl.revisit', 'crawl.initial', 'crawl.initial.retry.30s', 'crawl.initial.retry.5m')"


def queue_log(spark, folder):
    """The derived queue with the columns of a topic log; ``seq`` is the offset."""
    attempts = F.when(F.col("attempts").isNotNull(), F.create_map(F.lit("attempts"), F.col("attempts")))
    return view(spark, folder, "v_queue").select(
        "topic", F.lit(0).alias("partition"), F.col("seq").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"), "key", "value", attempts.alias("headers"))


@query("topic_scan", f"""
SELECT topic, seq, key, attempts, value FROM v_queue WHERE value IS NOT NULL AND topic IN {_TASK_TOPICS}""")
def topic_scan(spark, folder):
    path = scratch_path(spark, "topic-log")
    topics.write_topics(queue_log(spark, folder), path, "all")
    rows = topics.read_topics(spark, path, TASK_TOPICS)
    return rows.select("topic", F.col("offset").alias("seq"), "key",
                       F.try_element_at("headers", F.lit("attempts")).alias("attempts"), "value")


@query("enqueue_tasks", """
SELECT 'crawl.initial' AS topic, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS key,
       '{"url":"' || url || '","depth":' || CAST(page_id % 5 AS VARCHAR) ||
       CASE WHEN page_id % 3 = 0 THEN ',"priority":"high"}' ELSE '}' END AS value
FROM @pages""")
def enqueue_tasks(spark, folder):
    tasks = table(spark, folder, "pages").select(
        "url", (F.col("page_id") % 5).cast("int").alias("depth"),
        F.when(F.col("page_id") % 3 == 0, "high").alias("priority"))
    return topics.to_task_messages(tasks, "crawl.initial")


@query("publish_results", """
SELECT t.topic, seq, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS key,
       '{"sitesUrl":"' || url || '","title":' || coalesce('"' || title || '"', 'null') || '}' AS value
FROM v_results, (VALUES ('results.db'), ('results.raw')) t(topic)""")
def publish_results(spark, folder):
    rows = view(spark, folder, "v_results").withColumnRenamed("url", "sitesUrl")
    value = F.to_json(F.struct("sitesUrl", "title"), {"ignoreNullFields": "false"})
    return topics.to_result_messages(rows, value)


@query("seed_tasks", """
SELECT 'crawl.initial' AS topic, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS key,
       '{"url":"' || url || '","depth":0,"priority":"normal"}' AS value
FROM @pages""")
def seed_tasks(spark, folder):
    return topics.seed_tasks(table(spark, folder, "pages").select("url"))


@query("snapshot_fetch", """
SELECT t.seq, t.url, t.depth, CASE WHEN p.html IS NULL THEN 'retry' ELSE 'ok' END AS outcome,
       CASE WHEN p.html IS NULL THEN 'extract' END AS reason, CAST(length(p.html) AS BIGINT) AS html_length
FROM v_tasks t LEFT JOIN @pages p ON p.url = t.url""")
def snapshot_fetch(spark, folder):
    fetched = snapshot.snapshot_fetch(view(spark, folder, "v_tasks"), table(spark, folder, "pages").select("url", "html"))
    return fetched.select("seq", "url", "depth", "outcome", "reason",
                          F.length("html").cast("bigint").alias("html_length"))


_JUDGED_TASKS = r"""
judged AS (
  SELECT seq, topic, ts, key, attempts, value, concat_ws(',', v1, v2, v3, v4, v5, v6, v7, v8, v9, v10) AS violations
  FROM (SELECT *,
    CASE WHEN kind <> 'OBJECT' THEN CASE WHEN kind = 'BAD' THEN 'document:json' ELSE 'document:type' END END AS v1,
    CASE WHEN kind = 'OBJECT' AND u IS NULL THEN 'url:required' END AS v2,
    CASE WHEN u <> 'VARCHAR' THEN 'url:type' END AS v3,
    CASE WHEN u = 'VARCHAR' AND NOT regexp_matches(json_extract_string(value, '$.url'), '^[a-z]+://[!-~]+$') THEN 'url:format' END AS v4,
    CASE WHEN kind = 'OBJECT' AND d IS NULL THEN 'depth:required' END AS v5,
    CASE WHEN d NOT IN ('UBIGINT', 'BIGINT') AND NOT (d = 'DOUBLE' AND dn = floor(dn)) THEN 'depth:type' END AS v6,
    CASE WHEN dn < 0 THEN 'depth:minimum' END AS v7,
    CASE WHEN p <> 'VARCHAR' THEN 'priority:type' END AS v8,
    CASE WHEN p IS NOT NULL AND coalesce(json_extract_string(value, '$.priority'), '') NOT IN ('normal', 'high') THEN 'priority:enum' END AS v9,
    CASE WHEN kind = 'OBJECT' THEN array_to_string(list_transform(list_filter(json_keys(value),
      lambda k: k NOT IN ('url', 'depth', 'priority')), lambda k: k || ':unknown'), ',') END AS v10x,
    nullif(v10x, '') AS v10
    FROM (SELECT *, CASE WHEN json_valid(value) THEN json_type(value) ELSE 'BAD' END AS kind,
      CASE WHEN json_valid(value) THEN json_type(value, '$.url') END AS u,
      CASE WHEN json_valid(value) THEN json_type(value, '$.depth') END AS d,
      CASE WHEN json_valid(value) AND json_type(value, '$.depth') IN ('UBIGINT', 'BIGINT', 'DOUBLE')
        THEN CAST(json_extract(value, '$.depth') AS DOUBLE) END AS dn,
      CASE WHEN json_valid(value) THEN json_type(value, '$.priority') END AS p
      FROM v_queue WHERE value IS NOT NULL) a) b),
outcomes AS (
  SELECT *, CASE WHEN violations = '' THEN 'ok' ELSE 'dlq' END AS outcome,
    CASE WHEN violations = 'document:json' THEN 'json' WHEN violations <> '' THEN 'schema' END AS reason
  FROM judged)"""


def judged_queue(spark, folder):
    return validate.validate_tasks(topics.scan_topics(queue_log(spark, folder), TASK_TOPICS))


@query("validate_tasks", f"""WITH {_JUDGED_TASKS.strip()}
SELECT seq, outcome, reason, violations,
  CASE WHEN outcome = 'ok' THEN json_extract_string(value, '$.url') END AS url,
  CASE WHEN outcome = 'ok' THEN CAST(CAST(json_extract(value, '$.depth') AS DOUBLE) AS BIGINT) END AS depth
FROM outcomes""")
def validate_tasks(spark, folder):
    return judged_queue(spark, folder).select(
        F.col("offset").alias("seq"), "outcome", "reason", F.array_join("violations", ",").alias("violations"),
        "url", "depth")


_JUDGED_RESULTS = r"""
judged AS (
  SELECT seq, value, concat_ws(',',
    CASE WHEN u IS NULL THEN 'sitesUrl:required' END, CASE WHEN u <> 'VARCHAR' THEN 'sitesUrl:type' END,
    CASE WHEN u = 'VARCHAR' AND NOT regexp_matches(json_extract_string(value, '$.sitesUrl'), '^[a-z]+://[!-~]+$') THEN 'sitesUrl:format' END,
    CASE WHEN t NOT IN ('VARCHAR', 'NULL') THEN 'title:type' END,
    CASE WHEN b NOT IN ('OBJECT', 'NULL') THEN 'body:type' END,
    CASE WHEN json_type(value, '$.body.children') <> 'ARRAY' THEN 'body.children:type' END,
    CASE WHEN json_type(value, '$.html') <> 'VARCHAR' THEN 'html:type' END,
    CASE WHEN m IS NULL THEN 'meta:required' END, CASE WHEN m <> 'OBJECT' THEN 'meta:type' END,
    CASE WHEN m = 'OBJECT' AND json_type(value, '$.meta.fetchedAt') IS NULL THEN 'meta.fetchedAt:required' END,
    CASE WHEN json_type(value, '$.meta.fetchedAt') = 'VARCHAR'
      AND TRY_CAST(json_extract_string(value, '$.meta.fetchedAt') AS TIMESTAMPTZ) IS NULL THEN 'meta.fetchedAt:format' END,
    CASE WHEN m = 'OBJECT' AND json_type(value, '$.meta.domain') IS NULL THEN 'meta.domain:required' END,
    CASE WHEN m = 'OBJECT' AND json_type(value, '$.meta.selector_mode') IS NULL THEN 'meta.selector_mode:required' END,
    CASE WHEN m = 'OBJECT' AND json_type(value, '$.meta.contentHash') IS NULL THEN 'meta.contentHash:required' END,
    CASE WHEN json_type(value, '$.meta.aiConfidence') NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'NULL') THEN 'meta.aiConfidence:type' END@more
  ) AS violations
  FROM (SELECT *, json_type(value, '$.sitesUrl') AS u, json_type(value, '$.title') AS t, json_type(value, '$.body') AS b,
          json_type(value, '$.meta') AS m FROM @from) x)
SELECT seq, CASE WHEN violations = '' THEN 'ok' ELSE 'dlq' END AS outcome,
  CASE WHEN violations <> '' THEN 'result_schema' END AS reason, violations FROM judged"""


def _judged_columns(rows):
    return rows.select("seq", "outcome", "reason", F.array_join("violations", ",").alias("violations"))


@query("validate_results", "WITH " + _JUDGED_RESULTS.replace("@more", "").replace("@from", "v_results_raw").strip())
def validate_results(spark, folder):
    return _judged_columns(validate.validate_results(view(spark, folder, "v_results_raw")))


@query("validate_enriched", "WITH " + _JUDGED_RESULTS.replace("@more", """,
    CASE WHEN json_type(value, '$.detectedType') <> 'VARCHAR' THEN 'detectedType:type' END,
    CASE WHEN json_type(value, '$.detectedType') IS NOT NULL AND coalesce(json_extract_string(value, '$.detectedType'), '')
      NOT IN ('product', 'page') THEN 'detectedType:enum' END""").replace("@from", "v_enriched_raw").strip())
def validate_enriched(spark, folder):
    return _judged_columns(validate.validate_enriched(view(spark, folder, "v_enriched_raw")))


@query("page_results", r"""
SELECT seq, url AS "sitesUrl", title, nullif(text, '') AS text, '' AS html,
  strftime(fetched_at, '%Y-%m-%dT%H:%M:%S.000Z') AS fetched_at, regexp_extract(url, '^https?://([^/]+)', 1) AS domain,
  'ai' AS selector_mode, sha256(coalesce(text, '')) AS content_hash, substr(sha1(substr(coalesce(text, ''), 1, 5000)), 1, 16) AS simhash
FROM v_results""")
def results_of_pages(spark, folder):
    found = page_results(fingerprints(view(spark, folder, "v_results")))
    return found.select("seq", "sitesUrl", "title", F.get("body.children", F.lit(0))["text"].alias("text"), "html",
                        F.col("meta.fetchedAt").alias("fetched_at"), F.col("meta.domain").alias("domain"),
                        F.col("meta.selector_mode").alias("selector_mode"),
                        F.col("meta.contentHash").alias("content_hash"), F.col("meta.simhash").alias("simhash"))


@query("depth_gate", """
SELECT seq, url, depth, CASE WHEN depth + 1 <= 3 THEN depth + 1 END AS link_depth FROM v_tasks WHERE depth <= 3""")
def depth_gate(spark, folder):
    kept = gates.depth_gate(view(spark, folder, "v_tasks"))
    deeper = F.col("depth") + 1
    return kept.select("seq", "url", "depth", F.when(deeper <= MAX_DEPTH, deeper).alias("link_depth"))


@query("robots_gate", r"""
SELECT p.page_id, p.url
FROM (SELECT *, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS origin,
        regexp_extract(url, '^https?://[^/?#]+([^#]*)', 1) AS path FROM @pages) p
LEFT JOIN v_robots r ON r.origin = p.origin
WHERE CASE
  WHEN r.body LIKE '%Disallow: /en/%' THEN NOT starts_with(path, '/en/') OR starts_with(path, '/en/1')
  WHEN r.body LIKE '%files%' THEN NOT regexp_matches(path, '^/.*\.html$')
  WHEN r.body LIKE 'User-agent: *%' THEN false
  ELSE true END""")
def robots_gate(spark, folder):
    rules = gates.robots_rules(view(spark, folder, "v_robots"))
    return gates.robots_gate(table(spark, folder, "pages").select("page_id", "url"), rules)


@query("same_origin_links", r"""
SELECT DISTINCT page_id, url, regexp_replace(regexp_extract(url, '^(https?://[^/?#]+)', 1), '^(https?://)www\.', '\1') ||
  replace(replace(url_encode(href), '%2F', '/'), '%2C', ',') AS link
FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM @pages) x""")
def links_on_site(spark, folder):
    pages = extract_pages(table(spark, folder, "pages")).select("page_id", "url", "links")
    return same_origin_links(pages)


@query("status_triage", """
SELECT event_id, status, attempt, CASE WHEN status BETWEEN 200 AND 399 THEN 'ok'
    WHEN (status = 429 OR status >= 500) AND attempt < 2 THEN 'retry' ELSE 'fail' END AS outcome,
  CASE WHEN (status = 429 OR status >= 500) AND attempt < 2 THEN CAST(1000 * pow(2, attempt) AS BIGINT) END AS wait_ms
FROM v_fetch_log""")
def status_triage(spark, folder):
    return gates.status_triage(view(spark, folder, "v_fetch_log")).select(
        "event_id", "status", "attempt", "outcome", "wait_ms")


@query("new_urls", """
SELECT seq, url, depth, priority FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS rn FROM v_tasks) t
WHERE rn = 1 AND url NOT IN (SELECT url FROM @pages WHERE url LIKE '%.html')""")
def unseen_urls(spark, folder):
    visited = table(spark, folder, "pages").filter(F.col("url").endswith(".html")).select("url")
    return new_urls(view(spark, folder, "v_tasks"), visited).select("seq", "url", "depth", "priority")


@query("origin_cap", """
SELECT seq, origin, priority, CASE WHEN row_number() OVER (PARTITION BY origin
  ORDER BY CASE WHEN priority = 'high' THEN 0 ELSE 1 END, seq) <= 4 THEN 'ok' ELSE 'retry' END AS outcome
FROM v_tasks""")
def origin_cap(spark, folder):
    return gates.origin_cap(view(spark, folder, "v_tasks")).select("seq", "origin", "priority", "outcome")


_ROUTED = """
SELECT seq, CASE WHEN outcome = 'dlq' THEN 'crawl.initial.dlq' WHEN tries >= 3 THEN 'crawl.initial.retry.5m'
    ELSE 'crawl.initial.retry.30s' END AS topic, key, value, CAST(tries AS VARCHAR) AS attempts, outcome
FROM @judged WHERE outcome <> 'ok'"""


@query("route_outcomes", f"""WITH {_JUDGED_TASKS.strip()},
capped AS (
  SELECT *, coalesce(CAST(attempts AS INT), 0) + 1 AS tries, CASE WHEN outcome = 'ok' AND row_number() OVER (
    PARTITION BY key, outcome ORDER BY seq) > 4 THEN 'retry' ELSE outcome END AS decided FROM outcomes)
{_ROUTED.replace('@judged', '(SELECT * EXCLUDE (outcome), decided AS outcome FROM capped) c')}""")
def routed(spark, folder):
    judged = judged_queue(spark, folder)
    good = judged.filter(F.col("outcome") == "ok").withColumn("origin", F.col("key")).drop("outcome")
    capped = gates.origin_cap(good.withColumn("priority", F.lit("normal")), order=("offset",))
    columns = ["topic", "offset", "key", "value", "headers", "outcome"]
    every = judged.filter(F.col("outcome") != "ok").select(*columns).unionByName(capped.select(*columns))
    return routing.route_outcomes(every).select(
        F.col("offset").alias("seq"), "topic", "key", "value", F.col("headers")["attempts"].alias("attempts"), "outcome")


@query("due_retries", """
SELECT seq, topic, ts + CASE WHEN topic LIKE '%30s' THEN interval 30 second ELSE interval 5 minute END AS not_before
FROM v_queue WHERE topic LIKE '%.retry.%'
  AND ts + CASE WHEN topic LIKE '%30s' THEN interval 30 second ELSE interval 5 minute END <= TIMESTAMP '2024-01-01 02:05:00'""")
def due(spark, folder):
    now = F.lit("2024-01-01 02:05:00").cast("timestamp")
    return routing.due_retries(queue_log(spark, folder), now).select(
        F.col("offset").alias("seq"), "topic", F.col("not_before").cast("timestamp_ntz").alias("not_before"))


@query("dlq_report", f"""WITH {_JUDGED_TASKS.strip()}
SELECT reason, coalesce(CAST(attempts AS INT), 0) AS attempts, count(*) AS n FROM outcomes WHERE outcome = 'dlq' GROUP BY 1, 2""")
def dead_letters(spark, folder):
    return routing.dlq_report(judged_queue(spark, folder))


@query("step_outcomes", f"""WITH {_JUDGED_TASKS.strip()}
SELECT outcome, reason, count(*) AS n FROM outcomes GROUP BY 1, 2""")
def step_outcomes(spark, folder):
    messages = topics.scan_topics(queue_log(spark, folder), TASK_TOPICS)
    return routing.run_step(messages, validate.validate_tasks).groupBy("outcome", "reason").agg(F.count("*").alias("n"))
