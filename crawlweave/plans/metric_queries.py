"""Queries over outcome logs and events: crawl metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlweave.operators import metrics
from crawlweave.plans.derived import table, view
from crawlweave.plans.message_queries import queue_log
from crawlweave.plans.registry import query


def events(spark, folder):
    return table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def outcomes(spark, folder):
    return view(spark, folder, "v_outcomes").withColumn("ts", F.col("ts").cast("timestamp"))


def _plain(rows):
    """Window starts without a zone, as the check's engine has them."""
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("pages_processed", "SELECT mode, queue, count(*) AS n FROM v_outcomes WHERE outcome = 'ok' GROUP BY 1, 2")
def pages_processed(spark, folder):
    return metrics.pages_processed(outcomes(spark, folder))


@query("pages_failed", "SELECT reason, count(*) AS n FROM v_outcomes WHERE reason IS NOT NULL GROUP BY 1")
def pages_failed(spark, folder):
    return metrics.pages_failed(outcomes(spark, folder))


@query("links_enqueued", "SELECT CAST(sum(n_links) AS BIGINT) AS n_links FROM v_outcomes WHERE outcome = 'ok'")
def links_enqueued(spark, folder):
    return metrics.links_enqueued(outcomes(spark, folder))


@query("stage_totals", "SELECT stage, count(*) AS n FROM v_outcomes WHERE outcome = 'ok' GROUP BY 1")
def stage_totals(spark, folder):
    return metrics.stage_totals(outcomes(spark, folder))


_LEVELS = """
SELECT origin, ts, CAST(sum(step) OVER (PARTITION BY origin ORDER BY ts) AS BIGINT) AS inflight FROM (
  SELECT origin, ts, sum(step) AS step FROM (
    SELECT origin, started_at AS ts, 1 AS step FROM v_fetch_log UNION ALL SELECT origin, ended_at, -1 FROM v_fetch_log) s
  GROUP BY 1, 2) x"""


@query("inflight_by_origin", _LEVELS)
def inflight_by_origin(spark, folder):
    return metrics.inflight_by_origin(view(spark, folder, "v_fetch_log"))


@query("peak_inflight", f"SELECT origin, max(inflight) AS peak FROM ({_LEVELS}) l GROUP BY 1")
def peak_inflight(spark, folder):
    return metrics.peak_inflight(view(spark, folder, "v_fetch_log"))


@query("processed_5m", "SELECT time_bucket(interval 5 minute, ts) AS window_start, count(*) AS n FROM @events GROUP BY 1")
def processed_5m(spark, folder):
    return _plain(metrics.windowed_counts(events(spark, folder)))


@query("processed_5m_sliding", """
SELECT time_bucket(interval 1 minute, ts) - m * interval 1 minute AS window_start, count(*) AS n
FROM @events, range(5) r(m) GROUP BY 1""")
def processed_5m_sliding(spark, folder):
    return _plain(metrics.windowed_counts(events(spark, folder), "5 minutes", "1 minute"))


@query("failed_5m", """
SELECT time_bucket(interval 5 minute, ts) AS window_start, reason, count(*) AS n FROM v_outcomes
WHERE reason IS NOT NULL GROUP BY 1, 2""")
def failed_5m(spark, folder):
    failed = outcomes(spark, folder).filter(F.col("reason").isNotNull())
    return _plain(metrics.windowed_counts(failed, by=("reason",)))


@query("links_rate_1m", """
SELECT time_bucket(interval 1 minute, ts) AS window_start, round(sum(n_links) / 60.0, 6) AS links_per_s FROM v_outcomes GROUP BY 1""")
def links_rate_1m(spark, folder):
    return _plain(metrics.links_rate(outcomes(spark, folder))).withColumn("links_per_s", F.round("links_per_s", 6))


@query("queue_depth", """
SELECT topic, CAST(count(*) FILTER (WHERE seq > committed) AS BIGINT) AS depth
FROM v_queue JOIN (SELECT topic, max(CASE WHEN seq % 3 = 0 THEN seq END) AS committed FROM v_queue GROUP BY 1) c USING (topic)
GROUP BY 1""")
def queue_depth(spark, folder):
    log = queue_log(spark, folder)
    read = F.when(F.col("offset") % 3 == 0, F.col("offset"))
    return metrics.queue_depth(log, log.groupBy("topic").agg(F.max(read).alias("committed")))


@query("latency_histogram", """
SELECT event_type, le, CAST(CASE WHEN le = '+Inf' THEN count(value) ELSE count(*) FILTER (WHERE value <= b) END AS BIGINT) AS n,
  round(sum(value), 4) AS "sum", count(value) AS "count"
FROM @events, (VALUES ('0.05', 0.05), ('0.5', 0.5), ('5', 5.0), ('50', 50.0), ('100', 100.0), ('250', 250.0), ('+Inf', NULL)) v(le, b)
GROUP BY event_type, le, b""")
def latency_histogram(spark, folder):
    found = metrics.latency_histogram(events(spark, folder), by=("event_type",), buckets=(0.05, 0.5, 5, 50, 100, 250))
    return found.withColumn("sum", F.round("sum", 4))


@query("gauge_last", """
SELECT event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM @events) e WHERE rn = 1""")
def gauge_last(spark, folder):
    return metrics.gauge_last(events(spark, folder), ("event_type",))
