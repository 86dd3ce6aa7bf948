"""Written working tables, distributed ranks and running sums, components: what several operators need."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crawlweave.session import scratch_path


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a table below ``spark.checkpoint.dir`` and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _ranged(frame: DataFrame, groups: Sequence[str], order: Sequence[str], label: str) -> DataFrame:
    """Rows dealt by ranges of (groups, order), so that a large group spreads over many tasks."""
    keys = [*groups, *order]
    return stored(frame.repartitionByRange(*keys).sortWithinPartitions(*keys)
                  .withColumn("_part", F.spark_partition_id())
                  .withColumn("_at", F.monotonically_increasing_id()), label)


def _with_base(rows: DataFrame, parts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Adds ``_base``, the sum of ``_n`` in a group's earlier partitions, and what else a partition's row holds."""
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    based = parts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    renamed = based.withColumnsRenamed({c: f"_of_{c}" for c in [*groups, "_part"]})
    same = F.col("_part") == F.col("_of__part")
    for name in groups:
        same = same & F.col(name).eqNullSafe(F.col(f"_of_{name}"))
    return rows.join(renamed, same)


def ranked(frame: DataFrame, groups: Sequence[str], order: Sequence[str], name: str = "rank") -> DataFrame:
    """Position of each row in its group, gapless from 0, by ``order`` (which should be total for stable reruns).

    No group meets in one task: only counts per group and range partition do. Null groups are groups.
    """
    rows = _ranged(frame, groups, order, name)
    parts = rows.groupBy(*groups, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    return _with_base(rows, parts, groups).select(
        *frame.columns, (F.col("_at") - F.col("_first") + F.col("_base")).alias(name))


def running_sum(frame: DataFrame, groups: Sequence[str], order: Sequence[str], value: str,
                name: str = "before") -> DataFrame:
    """Sum of ``value`` over the earlier rows of the group (the row itself excluded), as a distributed prefix sum."""
    rows = _ranged(frame, groups, order, name)
    parts = rows.groupBy(*groups, "_part").agg(F.sum(value).alias("_n"))
    inside = Window.partitionBy(*groups, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return _with_base(local, parts, groups).select(*frame.columns, (F.col("_local") + F.col("_base")).alias(name))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b), component being the smallest node reachable.

    Rounds of neighbour minimum and pointer jumping, each a written table, until no label changes. A node with very
    many links is pre-aggregated before the shuffle, its side of a join is split by the adaptive skew join.
    """
    both = stored(links.select(F.col("a").alias("x"), F.col("b").alias("y"))
                  .union(links.select(F.col("b").alias("x"), F.col("a").alias("y"))).where("x != y").distinct(), "links")
    labels = stored(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("x").alias("y"), F.col("label").alias("theirs")), "y")
                .groupBy("x").agg(F.min("theirs").alias("theirs")))
        lower = labels.join(near, "x").select("x", "label", F.least("label", "theirs").alias("next"))
        roots = labels.select(F.col("x").alias("next"), F.col("label").alias("root"))
        moved = stored(lower.join(roots, "next", "left").select(
            "x", "label", F.least("next", F.coalesce("root", "next")).alias("next")), "labels")
        done = moved.where("label != next").isEmpty()
        labels = moved.select("x", F.col("next").alias("label"))
        if done:
            return labels.select(F.col("x").alias("node"), F.col("label").alias("component"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Fixed value: the words of the contracts are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
