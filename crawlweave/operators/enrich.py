"""Classification of pages and what follows from it."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweave.functions.text import first_text
from crawlweave.functions.urls import message_key
from crawlweave.operators.validate import is_readable
from crawlweave.sources.topics import to_task_messages
from crawlweave.options import TOPIC_ENRICHED, TOPIC_PRIORITY

Classifier = Callable[[Column, Column], Column]


def default_rule(url: Column, text: Column) -> Column:
    """Fixed rule: auction addresses and addresses ending in digits are products (0.85), others pages (0.6)."""
    low = F.lower(F.coalesce(url, F.lit("")))
    product = low.contains("/auktion/") | low.rlike(r"/[0-9]+(\?.*)?$")
    return F.struct(F.when(product, "product").otherwise("page").alias("label"),
                    F.when(product, 0.85).otherwise(0.6).alias("confidence"))


def _labelled(url: Column, text: Column, fn: Classifier) -> Column:
    """Label and confidence; a missing label fails the job, as a bad reply does in the reference."""
    found = fn(url, text)
    label = found["label"]
    return F.struct(
        F.when(label.isNull() | (label == ""), F.raise_error(F.lit("classifier reply without label")).cast("string"))
        .otherwise(label).alias("label"),
        found["confidence"].cast("double").alias("confidence"))


def classify(rows: DataFrame, fn: Classifier = default_rule, url: str = "url", text: str = "text") -> DataFrame:
    """Add ``label, confidence``; ``fn`` gets url and text Columns and may be a pandas function."""
    words = F.coalesce(F.col(text), F.lit("")) if text in rows.columns else F.lit("")
    return rows.withColumn("_label", _labelled(F.col(url), words, fn)).select(*rows.columns, "_label.*")


def enrich_results(results: DataFrame, fn: Classifier = default_rule) -> DataFrame:
    """Result documents with ``detectedType`` and ``meta.aiConfidence``; the rest is kept."""
    text = F.coalesce(first_text(F.col("body")), F.lit(""))
    return (results.withColumn("_label", _labelled(F.col("sitesUrl"), text, fn))
            .withColumn("detectedType", F.col("_label.label"))
            .withColumn("meta", F.col("meta").withField("aiConfidence", F.col("_label.confidence")))
            .drop("_label"))


def enrich_messages(messages: DataFrame, fn: Classifier = default_rule) -> DataFrame:
    """Result messages -> enriched messages, working on the JSON so that unknown keys survive at every level.

    Messages that are no JSON objects have no result.
    """
    messages = messages.filter(is_readable(F.col("value")))
    doc = F.try_parse_json("value")
    url = F.variant_get(doc, "$.sitesUrl", "string")
    text = F.coalesce(F.try_variant_get(doc, "$.body.children[0].text", "string"), F.lit(""))

    def without(column: Column, name: str) -> Column:
        return F.map_filter(F.coalesce(column, F.create_map().cast("map<string,variant>")), lambda key, _: key != name)

    def entry(name: str, value: Column) -> Column:
        return F.create_map(F.lit(name), value)

    keys = F.from_json("value", "map<string,variant>")
    meta = F.from_json(F.to_json(F.variant_get(doc, "$.meta", "variant")), "map<string,variant>")
    new_meta = F.map_concat(without(meta, "aiConfidence"),
                            entry("aiConfidence", F.col("_label.confidence").cast("variant")))
    rest = F.map_filter(without(keys, "meta"), lambda key, _: key != "detectedType")
    return (messages.withColumn("_label", _labelled(url, text, fn))
            .withColumn("_value", F.to_json(F.map_concat(
                rest, entry("detectedType", F.col("_label.label").cast("variant")),
                entry("meta", F.parse_json(F.to_json(new_meta))))))
            .select(F.lit(TOPIC_ENRICHED).alias("topic"),
                    *[c for c in messages.columns if c not in ("topic", "value")],
                    F.col("_value").alias("value"), url.alias("url"),
                    F.col("_label.label").alias("label"), F.col("_label.confidence").alias("confidence")))


def priority_tasks(labelled: DataFrame, url: str = "url", label: str = "label") -> DataFrame:
    """Products go back to the priority topic as tasks of depth 0."""
    tasks = labelled.filter(F.col(label) == "product").select(
        F.col(url).alias("url"), F.lit(0).alias("depth"), F.lit("high").alias("priority"))
    return to_task_messages(tasks, TOPIC_PRIORITY)


def enrich_and_requeue(messages: DataFrame, fn: Classifier = default_rule) -> DataFrame:
    """Result messages -> enriched messages and, for products, priority tasks: one pass, one classifier call a row."""
    enriched = enrich_messages(messages, fn)
    kept = [c for c in enriched.columns if c not in ("topic", "key", "value", "url", "label", "confidence")]
    key = message_key(F.col("url"))
    task = F.to_json(F.struct(F.col("url"), F.lit(0).alias("depth"), F.lit("high").alias("priority")))
    outputs = F.array(
        F.struct(F.lit(TOPIC_ENRICHED).alias("topic"), F.col("value").alias("value")),
        F.when(F.col("label") == "product", F.struct(F.lit(TOPIC_PRIORITY).alias("topic"), task.alias("value"))))
    return (enriched.select(*kept, key.alias("key"), F.explode(outputs).alias("_out"))
            .filter(F.col("_out").isNotNull()).select("_out.topic", "key", "_out.value", *kept))
