"""Where a message goes after its step: done, retry topics or dead letters."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweave.options import RETRY_DELAY_SECONDS, TOPIC_DLQ, TOPIC_RETRY_30S, TOPIC_RETRY_5M

Step = Callable[[DataFrame], DataFrame]


def attempts_of(headers: Column) -> Column:
    """Tries so far; a missing header is zero."""
    return F.coalesce(F.try_element_at(headers, F.lit("attempts")).try_cast("int"), F.lit(0))


def run_step(messages: DataFrame, step: Step) -> DataFrame:
    """Run a step that adds ``outcome`` in ok/retry/dlq; any other outcome fails the job."""
    done = step(messages)
    outcome = F.col("outcome")
    return done.withColumn("outcome", F.when(outcome.isin("ok", "retry", "dlq"), outcome).otherwise(
        F.raise_error(F.concat(F.lit("unknown outcome "), F.coalesce(outcome, F.lit("null")))).cast("string")))


def route_outcomes(messages: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """Rows to publish again: topic chosen by outcome and tries, key and value unchanged, header counted up.

    With ``max_attempts`` a retry that reaches it becomes a dead letter; by default retries never end.
    """
    attempts = attempts_of(F.col("headers")) + 1
    retry = F.when(attempts >= 3, TOPIC_RETRY_5M).otherwise(TOPIC_RETRY_30S)
    if max_attempts is not None:
        retry = F.when(attempts >= max_attempts, TOPIC_DLQ).otherwise(retry)
    target = F.when(F.col("outcome") == "retry", retry).otherwise(TOPIC_DLQ)
    return (messages.filter(F.col("outcome") != "ok")
            .withColumn("topic", target)
            .withColumn("headers", F.create_map(F.lit("attempts"), attempts.cast("string"))))


def with_not_before(messages: DataFrame) -> DataFrame:
    """Earliest time each retry message may run: its time plus the delay its topic names."""
    delay = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in RETRY_DELAY_SECONDS.items() for x in kv]),
                                        F.col("topic")), F.lit(0))
    return messages.withColumn("not_before", F.col("timestamp") + F.make_dt_interval(secs=delay))


def due_retries(messages: DataFrame, now: Column) -> DataFrame:
    """Messages of the retry topics whose delay has passed."""
    retries = messages.filter(F.col("topic").isin(*RETRY_DELAY_SECONDS))
    return with_not_before(retries).filter(F.col("not_before") <= now)


def dlq_report(messages: DataFrame) -> DataFrame:
    """Dead letters by reason and tries."""
    return (messages.filter(F.col("outcome") == "dlq")
            .groupBy("reason", attempts_of(F.col("headers")).alias("attempts"))
            .agg(F.count("*").alias("n")))
