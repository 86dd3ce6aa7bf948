"""Crawl metrics as aggregates of the outcome log. Counts combine on the map side, so hot labels are no problem."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from crawlweave.functions.text import order_key
from crawlweave.options import LATENCY_BUCKETS

# The reasons counted as failures.
FAILURE_REASONS = ("json", "schema", "extract", "result_schema")


def pages_processed(outcomes: DataFrame) -> DataFrame:
    """Finished pages by mode and queue."""
    return outcomes.filter(F.col("outcome") == "ok").groupBy("mode", "queue").agg(F.count("*").alias("n"))


def pages_failed(outcomes: DataFrame) -> DataFrame:
    """Failures by reason."""
    return (outcomes.filter(F.col("reason").isin(*FAILURE_REASONS)).groupBy("reason").agg(F.count("*").alias("n")))


def links_enqueued(outcomes: DataFrame) -> DataFrame:
    """Kept links of finished pages."""
    return outcomes.filter(F.col("outcome") == "ok").agg(F.coalesce(F.sum("n_links"), F.lit(0)).alias("n_links"))


def observed(rows: DataFrame, name: str | Observation) -> DataFrame:
    """Count outcomes while a job runs; read them from an ``Observation`` or the query's progress."""
    outcome = F.col("outcome")
    return rows.observe(name, F.count("*").alias("rows"), *[F.count_if(outcome == o).alias(o) for o in ("ok", "retry", "dlq")])


def stage_totals(outcomes: DataFrame) -> DataFrame:
    """Rows each stage finished."""
    return outcomes.filter(F.col("outcome") == "ok").groupBy("stage").agg(F.count("*").alias("n"))


def _level(steps: DataFrame, slice_seconds: int) -> DataFrame:
    """Running level per origin and instant, never below zero, from ``(origin, ts, step)``.

    Two-level running sum: inside time slices, then over slice totals, so no task ever sorts a whole origin.
    A level held at zero is the sum minus the lowest point it reached below zero so far.
    """
    slice_no = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / (slice_seconds * 1_000_000))
    known = steps.withColumn("slice", slice_no).filter(F.col("origin").isNotNull() & F.col("slice").isNotNull())
    # Steps of an instant are summed before the exchange, so a busy origin sends instants, not fetches.
    moments = known.groupBy("origin", "slice", "ts").agg(F.sum("step").alias("step"))
    inside = Window.partitionBy("origin", "slice").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    runs = moments.withColumn("run", F.sum("step").over(inside)).withColumn("low", F.min("run").over(inside))
    slices = runs.groupBy("origin", "slice").agg(F.sum("step").alias("total"), F.min("run").alias("lowest"))
    before = Window.partitionBy("origin").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (slices.withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0)))
              .withColumn("floor", F.least(F.lit(0), F.min(F.col("base") + F.col("lowest")).over(before)))
              .select("origin", "slice", "base", "floor"))
    lowest = F.least("floor", F.col("base") + F.col("low"))
    return runs.join(starts, ["origin", "slice"]).select(
        "origin", "ts", (F.col("base") + F.col("run") - lowest).alias("inflight"))


def inflight_by_origin(fetches: DataFrame, slice_seconds: int = 600) -> DataFrame:
    """Open fetches per origin at every start or end."""
    steps = fetches.select("origin", F.explode(F.array(
        F.struct(F.col("started_at").alias("ts"), F.lit(1).alias("step")),
        F.struct(F.col("ended_at").alias("ts"), F.lit(-1).alias("step")))).alias("e")).select("origin", "e.ts", "e.step")
    return _level(steps, slice_seconds)


def peak_inflight(fetches: DataFrame, slice_seconds: int = 600) -> DataFrame:
    return inflight_by_origin(fetches, slice_seconds).groupBy("origin").agg(F.max("inflight").alias("peak"))


def windowed_counts(events: DataFrame, length: str = "5 minutes", slide: str | None = None,
                    by: Sequence[str] = ()) -> DataFrame:
    """Exact event counts per time window."""
    return (events.groupBy(F.window("ts", length, slide).alias("w"), *by).agg(F.count("*").alias("n"))
            .select(F.col("w.start").alias("window_start"), *by, "n"))


def links_rate(outcomes: DataFrame, seconds: int = 60) -> DataFrame:
    """Links per second in each window."""
    return (outcomes.groupBy(F.window("ts", f"{seconds} seconds").alias("w")).agg(F.sum("n_links").alias("n"))
            .select(F.col("w.start").alias("window_start"), (F.col("n") / seconds).alias("links_per_s")))


def queue_depth(log: DataFrame, committed: DataFrame, offset: str = "offset") -> DataFrame:
    """Messages past the committed offset, per topic; a topic nobody read is all backlog."""
    backlog = log.join(committed.select("topic", "committed"), "topic", "left")
    waiting = F.col(offset) > F.coalesce("committed", F.lit(-1))
    return backlog.groupBy("topic").agg(F.count_if(waiting).alias("depth"))


def latency_histogram(events: DataFrame, value: str = "value", by: Sequence[str] = (),
                      buckets: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """Cumulative buckets with ``+Inf``, ``sum`` and ``count`` per label set, in one pass."""
    x = F.col(value)
    counts = [F.count_if(x <= b).alias(f"_b{i}") for i, b in enumerate(buckets)]
    total = events.groupBy(*by).agg(*counts, F.count(x).alias("count"), F.sum(x).alias("sum"))
    pairs = [F.struct(F.lit(f"{b:g}").alias("le"), F.col(f"_b{i}").alias("n")) for i, b in enumerate(buckets)]
    pairs.append(F.struct(F.lit("+Inf").alias("le"), F.col("count").alias("n")))
    return total.select(*by, F.explode(F.array(*pairs)).alias("p"), "sum", "count").select(
        *by, "p.le", "p.n", "sum", "count")


def gauge_last(events: DataFrame, by: Sequence[str], value: str = "value", ts: str = "ts",
               tie: str = "event_id") -> DataFrame:
    """Last value per label set; equal times are settled by ``tie``."""
    return events.groupBy(*by).agg(F.max_by(F.col(value), order_key(F.col(ts), F.col(tie))).alias("value"))
