"""Exact top-k by inner product: vectors by descending length, rotated partial sums, Cauchy-Schwarz bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweave.llm.common import stored
from crawlweave.llm.vectors import (Batches, arrow, asked_queries, best, by_dimension, regroup, valid_vectors,
                                    vector_classes)

BLOCK = "dim int, block long, top double, ids binary, counts binary, data binary"
BLOCK_NAMES = ["dim", "block", "top", "ids", "counts", "data"]
BLOCK_TYPES = [pa.int32(), pa.int64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]


def integer_vectors(rows: DataFrame, scale: float = 256.0) -> DataFrame:
    """Each component x becomes floor(scale * x), as a double."""
    return rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * F.lit(scale)).cast("double")))


def _gram(batches: Batches) -> Batches:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for _, x in by_dimension(batch, "vector"):
            sums[x.shape[1]] = sums.get(x.shape[1], 0) + x.T @ x
    if sums:
        yield pa.RecordBatch.from_pydict({"dim": pa.array(list(sums), pa.int32()), "gram": [
            g.astype(np.float64).tobytes() for g in sums.values()]})


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """The right singular vectors of all vectors, per length: from dim x dim sums, the only thing that is gathered."""
    found: dict[int, np.ndarray] = {}
    for row in vectors.select("vector").mapInArrow(arrow(_gram), "dim int, gram binary").toLocalIterator():
        d = row["dim"]
        found[d] = found.get(d, 0) + np.frombuffer(row["gram"]).reshape(d, d)
    return {d: np.linalg.eigh(g)[1][:, ::-1] for d, g in found.items()}


def _packed(frame: DataFrame, rows: int, order: list) -> DataFrame:
    """Blocks of up to ``rows`` (ids, vector) rows, in the given order, as binary columns; ``top`` is the largest norm."""
    def pack(batches: Batches) -> Batches:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        for part in regroup(batches, rows):
            for own, x in by_dimension(part, "vector"):
                listed = part.column("ids").take(pa.array(own))
                values = (x.shape[1], number, float(np.sqrt((x * x).sum(1).max())),
                          listed.flatten().to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
                          np.asarray(listed.value_lengths(), np.int32).tobytes(), x.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, BLOCK_TYPES)], BLOCK_NAMES)
                number += 1

    return frame.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(arrow(pack), BLOCK)


def _matrices(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    q, v = (np.frombuffer(row[c]).reshape(-1, row["dim"]) for c in ("q_data", "data"))
    return q, v, np.sqrt((q * q).sum(1)), np.sqrt((v * v).sum(1))


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact: no partial sum passes the product of the norms, so below 2^53 doubles hold every integer."""
    if np.sqrt((q * q).sum(1).max()) * np.sqrt((v * v).sum(1).max()) < 2.0 ** 53:
        return q @ v.T
    return q.astype(np.int64).astype(object) @ v.astype(np.int64).astype(object).T


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th highest of each row."""
    if scores.dtype == object:
        return np.sort(scores, axis=1)[:, -k]
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]


def _first_floors(k: int):
    """Meet a query block with the block of the longest vectors: a floor per query, -inf where that has too few."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                q, v, _, _ = _matrices(row)
                # one of k + 1 classes may be the query's own
                enough = len(v) > k
                floor = _kth(_products(q, v), k + 1).astype(float) if enough else np.full(len(q), -np.inf)
                yield pa.RecordBatch.from_arrays([pa.array([row["q_block"]], pa.int64()), pa.array(
                    [floor.tobytes()], pa.binary()), pa.array([float(floor.min())])], ["q_block", "floors", "least"])
    return run


def _scan(rotation: dict[int, np.ndarray], k: int, head: int):
    """Score a query block against a vector block; gives what can still be among a query's k best."""
    def one(row: dict) -> pa.RecordBatch | None:
        q, v, q_norm, v_norm = _matrices(row)
        floor = np.frombuffer(row["floors"])
        ask = np.flatnonzero(q_norm * v_norm.max() * (1 + 1e-9) >= floor)
        if not len(ask):
            return None
        turn = rotation[row["dim"]][:, :head]
        q_head, v_head = q[ask] @ turn, v @ turn
        q_rest = np.sqrt(np.maximum(0, q_norm[ask] ** 2 - (q_head ** 2).sum(1)))
        v_rest = np.sqrt(np.maximum(0, v_norm ** 2 - (v_head ** 2).sum(1)))
        bound = q_head @ v_head.T + np.outer(q_rest, v_rest) + 1e-6 * np.outer(q_norm[ask], v_norm)
        live = np.flatnonzero((bound >= floor[ask][:, None]).any(0))
        if not len(live):
            return None
        score = _products(q[ask], v[live])
        # the k + 1 best classes and all that tie with the last of them: ties are settled by id
        edge = np.maximum(_kth(score, min(len(live), k + 1)), floor[ask])
        at, column = np.nonzero(score >= edge[:, None])
        counts = np.frombuffer(row["counts"], np.int32)
        first = np.concatenate([[0], np.cumsum(counts)])
        own = live[column]
        times = counts[own]
        spread = np.repeat(first[own] - np.cumsum(times) + times, times) + np.arange(times.sum())
        vec_id = np.frombuffer(row["ids"], np.int64)[spread]
        query_id = np.repeat(np.frombuffer(row["q_ids"], np.int64)[ask[at]], times)
        value = np.repeat(score[at, column], times)
        other = query_id != vec_id
        return pa.RecordBatch.from_arrays([pa.array(query_id[other]), pa.array(vec_id[other]), pa.array(
            [int(x) for x in value[other]], pa.int64())], ["query_id", "vec_id", "score"])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                if (found := one(row)) is not None:
                    yield found
    return run


def top_inner_products(rows: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, block_rows: int = 4096,
                       query_rows: int = 512, head: int = 16) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products of floor(scale * x) vectors.

    Queries are the rows of (vec_id, embedding) with an id divisible by ``every``, against all rows of the same
    vector length. Vectors lie in blocks by descending norm. The first block sets each query's floor, a score that k
    others reach. Then a query block meets every block whose largest norm can reach its least floor: first ``head``
    rotated dimensions are multiplied and the rest is bounded by Cauchy-Schwarz, and only columns that can reach a
    floor are scored in full. Results are exact: integers below 2^53 in doubles, larger ones as Python integers (a
    score outside 64 bits fails).

    Vectors that are null, empty or hold null, NaN or infinity, and null ids take no part. Equal vectors are scored
    once and expanded to as many ids as can matter. Rows equal in id and vector count once; a row is the query's own
    if it has its id. Empty tables give no rows; other columns are ignored.
    """
    conf = rows.sparkSession.conf
    vectors = integer_vectors(valid_vectors(rows), scale)
    classes = stored(vector_classes(vectors, k).withColumn("norm", F.sqrt(F.aggregate(
        "vector", F.lit(0.0), lambda a, x: a + x * x))), "topk-classes")
    rotation = rotations(classes)
    blocks = stored(_packed(classes, block_rows, [F.desc("norm"), F.col("vec_id")]), "topk-blocks")
    asked = asked_queries(vectors, every).select(F.array("query_id").alias("ids"), "query_id", "vector")
    queries = stored(_packed(asked, query_rows, [F.col("query_id")]).select(
        "dim", F.col("block").alias("q_block"), F.col("top").alias("q_top"), F.col("ids").alias("q_ids"),
        F.col("data").alias("q_data")), "topk-queries")
    before = conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        # a row of the scan holds two blocks: a few at a time
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
        longest = blocks.groupBy("dim").agg(F.max_by("block", "top").alias("block"))
        first = blocks.join(longest, ["dim", "block"], "left_semi").select("dim", "data")
        floors = stored(queries.join(first, "dim").mapInArrow(
            arrow(_first_floors(k)), "q_block long, floors binary, least double"), "topk-floors")
        ready = queries.join(floors, "q_block")
        met = ready.select("dim", "q_block", "q_top", "least").join(blocks.select("dim", "block", "top"), "dim").where(
            F.col("q_top") * F.col("top") * (1 + 1e-9) >= F.col("least")).select("q_block", "block")
        # the queries travel to the blocks, which move once
        pairs = met.join(ready.select("q_block", "q_ids", "q_data", "floors"), "q_block").join(blocks, "block")
        found = stored(pairs.mapInArrow(arrow(_scan(rotation, k, head)), "query_id long, vec_id long, score long"),
                       "topk-found")
    finally:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    return best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
