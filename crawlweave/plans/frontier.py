"""A whole crawl as breadth-first waves over a snapshot table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlweave.operators.dedupe import first_per_key
from crawlweave.operators.extract import extract_pages
from crawlweave.operators.gates import child_tasks, depth_gate, robots_gate
from crawlweave.operators.links import site_links
from crawlweave.options import MAX_DEPTH

FETCHED = "url string, depth bigint, outcome string, reason string, content_hash string"


def read_snapshot_once(snapshot: DataFrame, path: str) -> DataFrame:
    """Every page of a snapshot read once, as a table: html is parsed once and never shuffled.

    Waves then work on addresses, hashes and links only. Hand in a filtered snapshot when a crawl is known to
    reach a small part of it.
    """
    pages = extract_pages(snapshot).withColumn("site_links", site_links("url", "links"))
    pages.write.mode("overwrite").parquet(path)
    return snapshot.sparkSession.read.parquet(path)


def crawl_frontier(spark: SparkSession, tasks: DataFrame, snapshot: DataFrame, path: str, max_depth: int = MAX_DEPTH,
                   rules: DataFrame | None = None, dedupe_content: bool = True) -> DataFrame:
    """Follow same-origin links from ``tasks(url, depth)``; one row per visited url.

    Every wave is written below ``path``, which ends its lineage: a lost executor repeats one wave at most. A wave
    is anti-joined with the waves before it and joined with the pages; the links of new content are the next wave.
    Only "is the wave empty" reaches the driver. First arrival is the lowest ``(wave, url)``. Columns: ``url,
    depth, outcome, reason, content_hash, wave, fresh`` (``fresh``: the content was new); join
    ``read_snapshot_once``'s table for title and text.
    """
    pages = read_snapshot_once(snapshot, f"{path}/pages")
    todo = tasks.select("url", F.col("depth").cast("bigint").alias("depth"))
    done: list[str] = []
    for wave in range(max_depth + 1):
        due = depth_gate(todo, max_depth)
        due = robots_gate(due, rules) if rules is not None else due
        due = first_per_key(due, "url", ("depth",))
        before = spark.read.schema(FETCHED).parquet(*done) if done else None
        if before is not None:
            due = due.join(before.select("url"), "url", "left_anti")
        found = F.col("content_hash").isNotNull()
        (due.join(pages.select("url", "content_hash"), "url", "left")
         .select("url", "depth", F.when(found, "ok").otherwise("retry").alias("outcome"),
                 F.when(~found, "extract").alias("reason"), "content_hash")
         .write.mode("overwrite").parquet(f"{path}/fetched/wave={wave}"))
        fetched = spark.read.schema(FETCHED).parquet(f"{path}/fetched/wave={wave}")
        if wave and fetched.isEmpty():
            break
        done.append(f"{path}/fetched/wave={wave}")
        fresh = fetched.filter(F.col("outcome") == "ok").select("url", "content_hash")
        if dedupe_content:
            fresh = fresh.groupBy("content_hash").agg(F.min("url").alias("url"))
            if before is not None:
                fresh = fresh.join(before.select("content_hash").distinct(), "content_hash", "left_anti")
        todo = (child_tasks(fetched.join(fresh.select("url"), "url", "left_semi").select("url", "depth"), max_depth)
                .join(pages.select("url", "site_links"), "url")
                .select(F.explode("site_links").alias("url"), "depth"))
    # exactly the waves of this call: the path may hold deeper ones of an earlier crawl
    fetched = spark.read.schema(FETCHED + ", wave int").option("basePath", f"{path}/fetched").parquet(*done)
    fresh = fetched.filter(F.col("outcome") == "ok").select("url", "content_hash", "wave")
    if dedupe_content:
        fresh = first_per_key(fresh, "content_hash", ("wave", "url"))
    fresh = fresh.select("url", F.lit(True).alias("_fresh"))
    return fetched.join(fresh, "url", "left").withColumn("fresh", F.coalesce("_fresh", F.lit(False))).drop("_fresh")
