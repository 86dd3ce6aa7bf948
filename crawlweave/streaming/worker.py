"""The crawl worker over topics: tasks in, results out, links and retries back to the task topics."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from crawlweave.functions.urls import origin_of
from crawlweave.operators.dedupe import new_urls, unseen
from crawlweave.operators.extract import extract_pages, page_results, result_json
from crawlweave.operators.gates import depth_gate, origin_cap, origin_slots, robots_gate
from crawlweave.operators.links import site_links
from crawlweave.operators.routing import route_outcomes, with_not_before
from crawlweave.operators.validate import result_is_valid, validate_tasks
from crawlweave.options import (GROUP_WORKER, RETRY_DELAY_SECONDS, TASK_TOPICS, TASKS_PER_FILE, TOPIC_DLQ, TOPIC_INITIAL,
                                CrawlOptions)
from crawlweave.sources.folder import Folder
from crawlweave.sources.snapshot import snapshot_fetch
from crawlweave.sources.topics import read_topics, to_result_messages, to_task_messages, write_topics

VISITED = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("content_hash", T.StringType()),
    T.StructField("batch", T.LongType()),
])
OUTCOME = ("url", "timestamp", "outcome", "reason")
CARRIED = ("topic", "offset", "timestamp", "key", "value", "headers")


class CrawlWorker:
    """State and steps of one worker group. ``home`` holds the visited table and the batches' working tables."""

    def __init__(self, spark: SparkSession, log: str, home: str, snapshot: DataFrame,
                 options: CrawlOptions = CrawlOptions(), rules: DataFrame | None = None,
                 clock: Callable[[], datetime] | None = None, pause: Callable[[float], None] = time.sleep):
        self.spark, self.log, self.home = spark, log, home
        self.snapshot, self.options, self.rules = snapshot, options, rules
        self.clock, self.pause = clock or (lambda: datetime.now(timezone.utc)), pause
        self.waiting_until: datetime | None = None

    def visited(self, before: int | None = None) -> DataFrame:
        """Addresses with a final outcome and the content hashes published, of the batches before one."""
        if not Folder(self.spark, self.home).exists("visited"):
            return self.spark.createDataFrame([], VISITED)
        rows = self.spark.read.schema(VISITED).parquet(f"{self.home}/visited")
        return rows if before is None else rows.filter(F.col("batch") < before)

    def _stage(self, rows: DataFrame, name: str, batch: int) -> DataFrame:
        """Write a batch's intermediate table once; a repeated batch replaces it."""
        path = f"{self.home}/work/{name}/batch={batch}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def run_batch(self, messages: DataFrame, batch: int) -> None:
        """Gates in cost order, then fetch, extract, content dedupe and publishing.

        A task row is identified by ``(topic, offset, key)`` until the first arrival of each url is known, and by
        its url from then on.
        """
        options, label = self.options, f"{GROUP_WORKER}-{batch}"
        # A retry runs once its topic's delay has passed since it was published; until then it is published again
        # unchanged, with its first time, so it runs exactly once, after its time.
        timed = with_not_before(messages.select(*CARRIED))
        early = F.col("topic").isin(*RETRY_DELAY_SECONDS) & (F.col("not_before") > F.lit(self.clock()))
        timed = timed.withColumn("_early", early)
        waiting = timed.filter("_early")
        first_due = waiting.agg(F.min("not_before")).first()[0]
        self.waiting_until = first_due.astimezone(timezone.utc) if first_due else None
        messages = timed.filter(~F.col("_early")).select(*CARRIED)
        judged = validate_tasks(messages.select(*CARRIED))
        bad = judged.filter(F.col("outcome") == "dlq")
        tasks = depth_gate(judged.filter(F.col("outcome") == "ok"), options.max_depth)
        tasks = robots_gate(tasks, self.rules) if self.rules is not None else tasks
        tasks = new_urls(tasks, order=("timestamp", "offset", "topic"))
        tasks = tasks.withColumn("origin", origin_of(F.col("url")))
        arrived = self._stage(bad.unionByName(tasks, allowMissingColumns=True), "arrived", batch)
        bad, tasks = arrived.filter(F.col("outcome") == "dlq"), arrived.filter(F.col("outcome") == "ok")
        seen = self.visited(before=batch)
        if not options.recrawl:
            tasks = self._stage(unseen(tasks, seen, "url"), "unseen", batch)
        slots = options.max_per_origin if options.queue_in_batch else None
        if options.max_per_origin is not None and slots is None:
            tasks = origin_cap(tasks.drop("outcome"), options.max_per_origin, order=("timestamp", "offset", "url"))

        due = tasks.filter(F.col("outcome") == "ok").select(*CARRIED, "url", "depth", "origin", "priority")
        pages = snapshot_fetch(due, self.snapshot)
        if slots is not None:
            pages = origin_slots(pages, slots, order=("timestamp", "offset", "url"))
        fetched = extract_pages(pages.drop("origin", "priority"), options.include_selectors,
                                keep_html=bool(options.include_selectors))
        fetched = self._stage(fetched, "fetched", batch)
        failed = route_outcomes(fetched.filter(F.col("outcome") == "retry").select(*CARRIED, "outcome", "reason", "url"),
                                options.max_attempts)

        found = fetched.filter(F.col("outcome") == "ok")
        first = found.groupBy("content_hash").agg(F.min("url").alias("url"))
        first = unseen(first, seen.filter(F.col("content_hash").isNotNull()), "content_hash")
        follow = F.col("depth") + 1 <= options.max_depth
        fresh = self._stage(found.join(first.select("url"), "url", "left_semi").withColumn(
            "site_links", F.when(follow, site_links("url", "links"))).drop("links"), "fresh", batch)

        # A full origin only waits: its tasks go back to their own topic unchanged (tries, time); tries are limited for
        # pages that cannot be fetched.
        full = tasks.filter(F.col("outcome") == "retry")
        results = page_results(fresh.withColumn("fetched_at", F.col("timestamp")), selectors=options.include_selectors)
        results = results.withColumn("outcome", F.when(result_is_valid(), "ok").otherwise("dlq"))
        unfit = results.filter(F.col("outcome") == "dlq")
        again = route_outcomes(reduce(DataFrame.unionByName, [
            rows.select(*CARRIED, "outcome") for rows in (bad, unfit)])).drop("timestamp")
        links = fresh.select(F.explode("site_links").alias("url"), (F.col("depth") + 1).alias("depth"))
        good = results.filter(F.col("outcome") == "ok").select("sitesUrl", result_json(results).alias("_json"))
        held = waiting.select("topic", "key", "value", "headers", F.col("timestamp").alias("_since")).unionByName(
            full.select("topic", "key", "value", "headers", F.col("timestamp").alias("_since")))
        out = [again, failed, to_task_messages(links, TOPIC_INITIAL), to_result_messages(good, F.col("_json")), held]
        names = ["topic", "key", "value", "headers", "_since"]
        gathered = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                          [rows.select(*[c for c in names if c in rows.columns]) for rows in out])
        write_topics(gathered.withColumn("timestamp", F.coalesce("_since", F.lit(self.clock()))).drop("_since"),
                     self.log, label, TASKS_PER_FILE)
        self._log_outcomes([
            bad.select(*OUTCOME), full.select(*OUTCOME), failed.select(*OUTCOME),
            results.select("url", "timestamp", "outcome",
                           F.when(F.col("outcome") == "dlq", "result_schema").alias("reason"),
                           F.coalesce(F.size("site_links"), F.lit(0)).alias("n_links"))], batch)

        published = fresh.select("url", F.lit(True).alias("_new"))
        final = (found.select("url", "content_hash").join(published, "url", "left")
                 .select("url", F.when(F.col("_new"), F.col("content_hash")).alias("content_hash")))
        given_up = failed.filter(F.col("topic") == TOPIC_DLQ).select("url", F.lit(None).cast("string").alias("content_hash"))
        (final.unionByName(given_up).withColumn("batch", F.lit(batch)).hint("rebalance")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch")
         .parquet(f"{self.home}/visited"))
        # The batch before this one is committed, its working tables are not needed again.
        work = Folder(self.spark, f"{self.home}/work")
        for name in work.names(""):
            work.delete(f"{name}/batch={batch - 1}")

    def outcomes(self) -> DataFrame:
        """The log the crawl metrics are computed from, one row per message that got an outcome."""
        return self.spark.read.parquet(f"{self.home}/outcomes")

    def _log_outcomes(self, parts: list[DataFrame], batch: int) -> None:
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        (rows.select(F.col("timestamp").alias("ts"), F.lit("worker").alias("stage"), "url", "outcome", "reason",
                     F.lit("css" if self.options.include_selectors else "ai").alias("mode"), F.lit("kafka").alias("queue"),
                     F.coalesce("n_links", F.lit(0)).alias("n_links"), F.lit(batch).alias("batch"))
         .withColumn("origin", origin_of(F.col("url"))).hint("rebalance")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch")
         .parquet(f"{self.home}/outcomes"))

    def start(self, files_per_trigger: int | None = None, **trigger) -> StreamingQuery:
        """One consumer group over the five task topics."""
        tasks = read_topics(self.spark, self.log, TASK_TOPICS, streaming=True, files_per_trigger=files_per_trigger)
        return (tasks.writeStream.queryName(GROUP_WORKER).option("checkpointLocation", f"{self.home}/checkpoint")
                .foreachBatch(self.run_batch).trigger(**(trigger or {"availableNow": True})).start())

    def drain(self) -> int:
        """Run until a round reads nothing: links and retries written by one round are the next round's input.

        Returns the number of rounds that read something. There is no cap on rounds: a full origin only waits, and
        every round that finishes an address (visited rows grow) is progress. Only rounds that finish nothing can
        loop for ever (retries without ``max_attempts``): after ``max_attempts + 1`` of them in a row (2 without a
        limit) the crawl stops with an error naming them.
        """
        patience = (self.options.max_attempts or 1) + 1
        done, idle, finished = 0, 0, self._finished()
        while True:
            self.waiting_until = None
            query = self.start()
            query.awaitTermination()
            if not any(p["numInputRows"] for p in query.recentProgress):
                return done
            done += 1
            now = self._finished()
            if now > finished:
                idle = 0
            elif self.waiting_until is not None:
                # only retries whose time has not come: wait for the first of them (at most the longest delay)
                self.pause(max(0.0, (self.waiting_until - self.clock()).total_seconds()))
            else:
                idle += 1
            finished = now
            if idle >= patience:
                raise RuntimeError(f"{idle} rounds in a row finished no address; set max_attempts to end retries")

    def _finished(self) -> int:
        return self.visited().count()
