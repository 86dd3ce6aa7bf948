"""Seen-once rules on unbounded streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_dedupe(rows: DataFrame, key: str, spread: tuple[str, ...], salts: int = 16) -> DataFrame:
    """Every key once, for ever; state lives in the state store.

    Two levels: the first splits a hot key over ``salts`` tasks by the ``spread`` columns and lets it through once
    per salt, the second sees at most ``salts`` rows of it. ``salts=1`` keeps one level.
    """
    if salts > 1:
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
        rows = salted.dropDuplicates([key, "_salt"]).drop("_salt")
    return rows.dropDuplicates([key])


def stream_dedupe_urls(tasks: DataFrame, spread: tuple[str, ...] = ("seq",), salts: int = 16) -> DataFrame:
    return stream_dedupe(tasks, "url", spread, salts)


def stream_dedupe_content(pages: DataFrame, spread: tuple[str, ...] = ("seq",), salts: int = 16) -> DataFrame:
    return stream_dedupe(pages, "content_hash", spread, salts)


def stream_dedupe_within(rows: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """Bounded variant: a key may come again once the watermark has passed it by ``delay``."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
