"""What the two vector searches share: valid vectors, and equal vectors drawn together."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.functions.arrow import matrix

Batches = Iterator[pa.RecordBatch]


def valid_vectors(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector as doubles) of the rows whose id and vector are not null, not empty and finite throughout."""
    values = F.col(vector).cast("array<double>")
    sound = ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return rows.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & sound).select(
        F.col(id_column).alias("vec_id"), values.alias("vector"))


def vector_classes(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: vector, vec_id (the smallest) and ids, the k + 1 smallest different ids, ascending.

    No search needs more: equal vectors score the same, ties go to smaller ids, and a query leaves out itself. The
    ranked window drops the rest before the shuffle, so a vector that a third of all rows share meets nowhere.
    """
    least = Window.partitionBy("vector").orderBy("vec_id")
    kept = rows.withColumn("r", F.dense_rank().over(least)).where(F.col("r") <= k + 1)
    return kept.groupBy("vector").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")).select(
        F.element_at("ids", 1).alias("vec_id"), "ids", "vector")


def asked_queries(rows: DataFrame, every: int) -> DataFrame:
    """(query_id, vector) of the rows whose id is divisible by ``every``, rows that are equal once."""
    return rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vector").distinct()


def by_dimension(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each vector length of a batch."""
    lengths = np.asarray(batch.column(column).value_lengths())
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield rows, matrix(batch.column(column).take(pa.array(rows)))


def best(found: DataFrame, k: int, score: str = "score") -> DataFrame:
    """query_id, rank from 1, vec_id, score: the k best of (query_id, vec_id, score), ties to smaller ids."""
    order = Window.partitionBy("query_id").orderBy(F.desc(score), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", score)


def arrow(fn: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """Skip batches without rows, which Spark may hand over for empty partitions."""
    def run(batches: Batches) -> Batches:
        return fn(b for b in batches if b.num_rows)
    return run


def regroup(batches: Batches, rows: int) -> Batches:
    """Batches of ``rows`` rows each, the last one shorter."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        while sum(b.num_rows for b in held) >= rows:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield whole.slice(0, rows)
            held = [whole.slice(rows)] if whole.num_rows > rows else []
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
