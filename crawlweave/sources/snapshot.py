"""The fetch, as a join with a table of page snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def snapshot_fetch(tasks: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Tasks with their page's ``html``; no page -> outcome ``retry``, reason ``extract``.

    ``snapshot`` has one row per url. A url with very many tasks is split by the skew join.
    """
    found = F.col("html").isNotNull()
    return (tasks.join(snapshot, "url", "left")
            .withColumn("outcome", F.when(found, "ok").otherwise("retry"))
            .withColumn("reason", F.when(~found, "extract")))
