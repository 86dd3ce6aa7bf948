"""Results -> enriched results and priority tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crawlweave.operators.enrich import Classifier, default_rule, enrich_and_requeue
from crawlweave.operators.validate import is_readable
from crawlweave.options import GROUP_ENRICH, TOPIC_DLQ, TOPIC_RESULTS_DB
from crawlweave.sources.topics import read_topics, write_topics


def enrich_batch(messages: DataFrame, log: str, batch: str, fn: Classifier = default_rule) -> None:
    """Publish one batch to the enriched and priority topics; unreadable messages go to the dead letters."""
    unreadable = messages.filter(~is_readable(F.col("value"))).withColumn("topic", F.lit(TOPIC_DLQ))
    write_topics(enrich_and_requeue(messages, fn).unionByName(unreadable, allowMissingColumns=True), log, batch)


def stream_enrich(spark: SparkSession, log: str, checkpoint: str, fn: Classifier = default_rule,
                  files_per_trigger: int | None = None, **trigger) -> StreamingQuery:
    """Read ``results.db`` from a topic folder and write the enriched and priority topics to it."""
    results = read_topics(spark, log, [TOPIC_RESULTS_DB], streaming=True, files_per_trigger=files_per_trigger)
    return (results.writeStream.queryName(GROUP_ENRICH).option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, n: enrich_batch(batch, log, f"{GROUP_ENRICH}-{n}", fn))
            .trigger(**(trigger or {"availableNow": True})).start())
