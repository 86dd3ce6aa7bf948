"""Approximate nearest neighbours: random-projection trees, one priority queue over all of them, exact reranking."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.functions.arrow import matrix
from crawlweave.llm.common import stored
from crawlweave.llm.vectors import Batches, arrow, asked_queries, best, by_dimension, valid_vectors, vector_classes


class Tree:
    """Inner nodes with a direction, a threshold and two children; a child below 0 is leaf ``-1 - child``."""

    def __init__(self, sample: np.ndarray, leaf_share: float, rng: np.random.Generator):
        self.directions: list[np.ndarray] = []
        self.thresholds: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        least = max(2.0, leaf_share * len(sample))
        open_nodes = [(np.arange(len(sample)), None)]
        self.root = 0
        while open_nodes:
            rows, place = open_nodes.pop()
            node = self._split(sample, rows, least, rng, open_nodes)
            if place is None:
                self.root = node
            else:
                self.children[place[0]][place[1]] = node
        self.plane = np.array(self.directions) if self.directions else np.zeros((0, sample.shape[1]))
        self.threshold = np.array(self.thresholds)
        self.child = np.array(self.children, np.int64).reshape(-1, 2)

    def _split(self, sample, rows, least, rng, open_nodes) -> int:
        if len(rows) >= 2 * least:
            a, b = sample[rng.choice(rows, 2, replace=False)]
            direction = a - b
            length = np.sqrt(direction @ direction)
            if length > 0:
                direction = direction / length
                value = sample[rows] @ direction
                middle = float(np.median(value))
                left = value < middle
                if left.any():
                    node = len(self.directions)
                    self.directions.append(direction)
                    self.thresholds.append(middle)
                    self.children.append([0, 0])
                    open_nodes += [(rows[left], (node, 0)), (rows[~left], (node, 1))]
                    return node
        self.leaves += 1
        return -self.leaves

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: whole matrices go down the tree level by level."""
        at = np.full(len(x), self.root)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            side = np.einsum("ij,ij->i", x[inner], self.plane[node]) >= self.threshold[node]
            at[inner] = self.child[node, side.astype(int)]
        return -1 - at


def grow_forest(sample: np.ndarray, trees: int, leaf_share: float, seed: int) -> list[Tree]:
    """Trees over unit vectors; a leaf keeps about ``leaf_share`` of them. Equal samples give equal trees."""
    return [Tree(sample, leaf_share, np.random.default_rng((seed, t))) for t in range(trees)]


def search_leaves(forest: list[Tree], q: np.ndarray, visits: int) -> Iterator[tuple[int, int]]:
    """The ``visits`` most promising (tree, leaf) pairs (below 0: all), by one queue for all trees.

    A branch is as promising as the worst margin by which the query missed it on the way down.
    """
    margins = [t.plane @ q - t.threshold for t in forest]
    queue = [(0.0, i, t.root) for i, t in enumerate(forest)]
    heapq.heapify(queue)
    while queue and visits:
        missed, i, node = heapq.heappop(queue)
        while node >= 0:
            margin = margins[i][node]
            side = int(margin >= 0)
            heapq.heappush(queue, (max(missed, abs(margin)), i, int(forest[i].child[node, 1 - side])))
            node = int(forest[i].child[node, side])
        yield i, -1 - node
        visits -= 1


def needed_visits(forest: list[Tree], queries: np.ndarray, wanted: list[np.ndarray], recall: float) -> int:
    """The least visits with which the share ``recall`` of the wanted vectors is met; ``wanted`` has, for each query, a row
    of leaves (one of each tree) for each vector."""
    ranks = []
    for q, leaves in zip(queries, wanted):
        for n, (tree, leaf) in enumerate(search_leaves(forest, q, -1), 1):
            if not len(leaves):
                break
            met = leaves[:, tree] == leaf
            ranks += [n] * int(met.sum())
            leaves = leaves[~met]
    ranks.sort()
    return ranks[math.ceil(recall * len(ranks)) - 1] if ranks else 0


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def _index(forests):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for rows, x in by_dimension(batch, "vector"):
                x = _unit(x)
                for i, tree in enumerate(forests[x.shape[1]]):
                    part = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(rows), x.shape[1], np.int32)), pa.array(np.full(len(rows), i, np.int32)),
                        pa.array(tree.leaf_of(x).astype(np.int32)), part.column("ids"), part.column("vector")],
                        ["dim", "tree", "leaf", "ids", "vector"])
    return run


def _exact(forests, trials, k: int):
    """The k + 1 best classes of each trial query among a task's vectors, with their leaves in all trees."""
    def run(batches: Batches) -> Batches:
        held: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for rows, x in by_dimension(batch, "vector"):
                ids, asked = trials[x.shape[1]]
                if not len(ids):
                    continue
                x = _unit(x)
                members = np.empty(len(rows), object)
                members[:] = batch.column("ids").take(pa.array(rows)).to_pylist()
                score, vector = asked @ x.T, np.broadcast_to(x, (len(ids), *x.shape))
                members = np.broadcast_to(members, (len(ids), len(rows)))
                if x.shape[1] in held:
                    score, members, vector = (np.concatenate([a, b], axis=1) for a, b in zip(
                        held[x.shape[1]], (score, members, vector)))
                top = np.argsort(-score, axis=1, kind="stable")[:, :k + 1]
                held[x.shape[1]] = (np.take_along_axis(score, top, 1), np.take_along_axis(members, top, 1),
                                    np.take_along_axis(vector, top[:, :, None], 1))
        for d, (score, members, vector) in held.items():
            leaves = np.stack([t.leaf_of(vector.reshape(-1, d)) for t in forests[d]], axis=1).reshape(*score.shape, -1)
            out = [(d, t, i, score[t, c], leaves[t, c].tolist()) for t, own in enumerate(trials[d][0])
                   for c in range(score.shape[1]) for i in members[t, c] if i != own]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), (
                    pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.int32())))],
                    ["dim", "trial", "vec_id", "score", "leaves"])
    return run


def _visit(forests, visits: dict[int, int]):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for rows, x in by_dimension(batch, "vector"):
                at, found = [], []
                for n, q in zip(rows, _unit(x)):
                    leaves = list(search_leaves(forests[x.shape[1]], q, visits[x.shape[1]]))
                    at += [n] * len(leaves)
                    found += leaves
                part = batch.take(pa.array(at))
                tree, leaf = np.array(found, np.int32).reshape(-1, 2).T
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at), x.shape[1], np.int32)), pa.array(tree), pa.array(leaf),
                    part.column("query_id"), part.column("vector")], ["dim", "tree", "leaf", "query_id", "vector"])
    return run


def _rerank(k: int):
    """Cosines of the queries that visit a leaf with all its vectors; a query's k best classes per leaf go on."""
    def run(key, queries: pa.Table, members: pa.Table) -> pa.Table:
        query_ids, out = queries.column("query_id").to_numpy(), []
        if len(query_ids) and members.num_rows:
            q, v = matrix(queries.column("vector")), matrix(members.column("member"))
            ids = members.column("ids").to_pylist()
            lengths = np.sqrt((v * v).sum(1))
            for n, x in enumerate(q):
                # one query at a time and row by row: equal pairs give equal bits in every leaf
                score = np.einsum("ij,j->i", v, x) / (lengths * np.sqrt(x @ x))
                keep = min(len(score), k + 1)
                for j in np.flatnonzero(score >= np.partition(score, len(score) - keep)[-keep]):
                    out += [(query_ids[n], i, score[j]) for i in ids[j] if i != query_ids[n]]
        columns = list(zip(*out)) if out else [[], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})
    return run


def nearest_neighbours(rows: DataFrame, k: int = 5, every: int = 50, trees: int = 12, leaf_rows: int = 128,
                       visits: int = 160, sample_rows: int = 20_000, query_chunk: int = 512,
                       seed: int = 42, trials: int = 200, recall: float = 0.95) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest by cosine among the candidates that the forest gives.

    ``trees`` trees split by the median along the difference of two random vectors. They are fitted on the
    ``sample_rows`` distinct vectors with the least hashes (a bound on what the driver holds; with fewer, on all), for leaves of about
    ``leaf_rows`` vectors. Every vector is indexed in one leaf of each tree. A query takes the best leaves over all trees;
    all vectors in them are reranked exactly, in double precision, on the original vectors. How many leaves is found anew
    for each table and vector length: ``trials`` queries (those with the least hashes) are scored against all vectors, and
    as many leaves are taken as meet the share ``recall`` of their true neighbours, ``visits`` at least.
    Leaves beyond what the sample can split grow with the table.

    Vectors that are null, empty, zero or hold null, NaN or infinity, and null ids take no part; vectors of different
    lengths never meet. Equal vectors are indexed once with the ids that can matter, so they cannot swell a leaf.
    Rows equal in id and vector count once; a row is the query's own if it has its id. Empty tables give no rows.
    """
    spark = rows.sparkSession
    vectors = valid_vectors(rows).where(F.exists("vector", lambda x: x != 0))
    classes = stored(vector_classes(vectors, k), "forest-classes")
    forests: dict[int, list[Tree]] = {}
    for size in classes.groupBy(F.size("vector").alias("d")).count().collect():
        key = F.xxhash64("vec_id", F.lit(seed))
        # a share of the hashes that gives half more than wanted, so that few rows are sorted
        near = F.pmod(key, F.lit(1 << 30)) <= (1 << 30) * min(1.0, 1.5 * sample_rows / size["count"])
        picked = classes.where((F.size("vector") == size["d"]) & near).orderBy(
            F.pmod(key, F.lit(1 << 30)), "vec_id").limit(sample_rows).select("vector").toArrow()
        forests[size["d"]] = grow_forest(_unit(matrix(picked.column("vector"))), trees,
                                         leaf_rows / max(1, size["count"]), seed)
    shared = spark.sparkContext.broadcast(forests)  # at most 2 * trees * sample_rows / 2 nodes
    queries = stored(asked_queries(vectors, every), "forest-queries")
    tried: dict[int, tuple[list[int], np.ndarray]] = {}
    for d in forests:
        picked = queries.where(F.size("vector") == d).orderBy(
            F.xxhash64("query_id", F.lit(seed)), "query_id", "vector").limit(trials).toArrow()
        tried[d] = picked.column("query_id").to_pylist(), _unit(matrix(picked.column("vector"))) if len(picked) else np.zeros((0, d))
    asked_exactly = spark.sparkContext.broadcast(tried)
    exact = classes.mapInArrow(arrow(lambda b: _exact(shared.value, asked_exactly.value, k)(b)),
                               "dim int, trial int, vec_id long, score double, leaves array<int>")
    order = Window.partitionBy("dim", "trial").orderBy(F.desc("score"), "vec_id")
    true = exact.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).collect()  # trials * k rows a length
    needed: dict[int, int] = {}
    for d, (ids, asked) in tried.items():
        wanted = [[] for _ in ids]
        for row in true:
            if row["dim"] == d:
                wanted[row["trial"]].append(row["leaves"])
        needed[d] = max(visits, needed_visits(forests[d], asked, [np.array(w).reshape(-1, trees) for w in wanted], recall))
    index = classes.mapInArrow(arrow(lambda b: _index(shared.value)(b)),
                               "dim int, tree int, leaf int, ids array<bigint>, vector array<double>")
    visited = stored(queries.mapInArrow(
        arrow(lambda b: _visit(shared.value, needed)(b)),
        "dim int, tree int, leaf int, query_id long, vector array<double>"), "forest-visits")
    # queries of a busy leaf are dealt in chunks; its vectors go to each chunk
    leaf = ["dim", "tree", "leaf"]
    chunks = visited.groupBy(*leaf).agg(F.ceil(F.count("*") / query_chunk).cast("int").alias("chunks"))
    members = index.join(chunks, leaf).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    parts = chunks.select(*leaf, F.col("chunks").alias("parts"))
    asked = visited.join(parts, leaf).withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int"))
    cell = [*leaf, "chunk"]
    found = asked.select(*cell, "query_id", "vector").groupBy(*cell).cogroup(
        members.select(*cell, "ids", F.col("vector").alias("member")).groupBy(*cell)).applyInArrow(
        _rerank(k), "query_id long, vec_id long, score double")
    once = stored(found, "forest-found").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best(once, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
