"""Vector search: exact cosine top-k for one page, and an inverted-file index for batches of queries.

Index rows and queries meet in blocks of bounded size (a slice of one list against a slice of the queries that
probe it). A block is one matrix product and leaves k rows per query, so pairs never become rows and a list that
holds a third of all vectors is spread over many blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweave.functions.arrow import matrix, vectors
from crawlweave.options import IVF_LISTS

BLOCK_ROWS = 20_000
BLOCK_QUERIES = 2_000
BLOCK_SCORES = 1 << 20


def _cosine_to(reference: list[float]):
    """Cosine of each vector to one reference; null for a null or zero vector, as the cosine is undefined."""
    ref = np.asarray(reference, dtype=np.float64)
    size = np.sqrt(ref @ ref)

    @F.arrow_udf(T.DoubleType())
    def cosine(found: pa.Array) -> pa.Array:
        given = found.is_valid().to_numpy(zero_copy_only=False)
        rows = matrix(found.drop_null())
        result = np.full(len(found), np.nan)
        if len(rows):
            norms = np.sqrt(np.einsum("ij,ij->i", rows, rows)) * size
            result[given] = np.divide(rows @ ref, norms, out=np.full(len(rows), np.nan), where=norms > 0)
        return pa.array(result, from_pandas=True)

    return cosine


def similar_pages(table: DataFrame, ref_url: str, k: int = 10) -> DataFrame:
    """The ``k`` rows most similar to one page's vector, the page itself left out; no such page, no rows.

    One row is looked up first; the search is one scan with a top-k per task.
    """
    ref = table.filter(F.col("url") == ref_url).select("embedding").first()
    if ref is None or ref["embedding"] is None:
        return table.filter(F.lit(False)).select("url", "title", "detected_type", F.lit(0.0).alias("cosine_sim"))
    return (table.filter(F.col("url") != ref_url)
            .select("url", "title", "detected_type", _cosine_to(ref["embedding"])("embedding").alias("cosine_sim"))
            .orderBy(F.col("cosine_sim").desc_nulls_last(), "url").limit(k))


def ivf_train(table: DataFrame, lists: int = IVF_LISTS, seed: int = 17) -> KMeansModel:
    """Centroids of the index, learned on all rows that have a vector."""
    rows = table.filter(F.col("embedding").isNotNull()).select(array_to_vector("embedding").alias("features"))
    return KMeans(k=lists, seed=seed, maxIter=10).fit(rows)


def ivf_assign(table: DataFrame, model: KMeansModel) -> DataFrame:
    """Every row that has a vector with the list of its nearest centroid."""
    table = table.filter(F.col("embedding").isNotNull())
    return (model.transform(table.withColumn("features", array_to_vector("embedding")))
            .withColumnRenamed("prediction", "list_id").drop("features"))


def ivf_build(table: DataFrame, path: str, lists: int = IVF_LISTS, seed: int = 17) -> KMeansModel:
    """Write the index below ``path``: rows partitioned by list, centroids apart."""
    model = ivf_train(table, lists, seed=seed)
    spark = table.sparkSession
    (ivf_assign(table, model).hint("rebalance", "list_id").write.mode("overwrite").partitionBy("list_id")
     .parquet(f"{path}/rows"))
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    spark.createDataFrame(centers, "list_id int, centroid array<double>").write.mode("overwrite").parquet(f"{path}/centroids")
    return model


def _probes(queries: DataFrame, centers: np.ndarray, ids: np.ndarray, nprobe: int) -> DataFrame:
    """The nearest ``nprobe`` lists of every query. The centroids (lists x dim) travel with the function."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def nearest(found: pa.Array) -> pa.Array:
        distance = (centers ** 2).sum(1) - 2 * matrix(found) @ centers.T
        order = np.argsort(distance, axis=1, kind="stable")[:, :nprobe]
        return vectors(ids[order].astype(np.int32))

    return queries.withColumn("list_id", F.explode(nearest("embedding")))


def _slices(rows: DataFrame, key: str, size: int, name: str) -> DataFrame:
    """Number of slices per list, so that a slice holds about ``size`` rows: one row per list."""
    return rows.groupBy(key).agg(F.ceil(F.count("*") / size).cast("bigint").alias(name))


def ivf_search(spark, path: str, queries: DataFrame, k: int = 10, nprobe: int = 1,
               block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """L2 top-k for a batch of queries ``(query_id, embedding)``; ``nprobe`` = all lists gives the exact result.

    Returns ``query_id, rank, url, distance``.
    """
    centroids = spark.read.parquet(f"{path}/centroids").orderBy("list_id").collect()
    ids = np.array([r["list_id"] for r in centroids])
    centers = np.array([r["centroid"] for r in centroids])
    rows = spark.read.parquet(f"{path}/rows").select("url", "embedding", "list_id")
    probes = _probes(queries.select("query_id", "embedding"), centers, ids, min(nprobe, len(ids)))

    # One row per list on each side: broadcasting them is bounded by the number of lists.
    row_slices = F.broadcast(_slices(rows, "list_id", block_rows, "n_rows"))
    query_slices = F.broadcast(_slices(probes, "list_id", block_queries, "n_queries"))
    left = (rows.join(query_slices, "list_id").join(row_slices, "list_id")
            .withColumn("row_slice", F.pmod(F.xxhash64("url"), F.col("n_rows")))
            .withColumn("query_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_queries") - 1))))
    right = (probes.join(row_slices, "list_id").join(query_slices, "list_id")
             .withColumn("query_slice", F.pmod(F.xxhash64("query_id"), F.col("n_queries")))
             .withColumn("row_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_rows") - 1))))

    def block(_, found: pa.Table, asked: pa.Table) -> pa.Table:
        queries_out, urls_out, distances_out = [], [], []
        if found.num_rows and asked.num_rows:
            urls = np.array(found["url"].to_pylist(), dtype=object)
            order = np.argsort(urls, kind="stable")
            urls, rows = urls[order], matrix(found["embedding"])[order]
            squares = np.einsum("ij,ij->i", rows, rows)
            take = min(k, len(urls))
            names, probes_in = asked["query_id"].to_pylist(), matrix(asked["embedding"])
            step = max(1, BLOCK_SCORES // len(urls))
            for at in range(0, len(names), step):
                batch = probes_in[at:at + step]
                near = squares - 2 * batch @ rows.T
                edge = np.partition(near, take - 1, axis=1)[:, take - 1]
                for name, scores, limit, vector in zip(names[at:at + step], near, edge, batch):
                    # Everything up to the k-th score, ties included; exact distances settle the order.
                    hits = np.flatnonzero(scores <= limit + 1e-9 * (1 + abs(limit)))
                    exact = np.sqrt(((rows[hits] - vector) ** 2).sum(1))
                    best = np.lexsort((hits, exact))[:k]
                    queries_out += [name] * len(best)
                    urls_out += urls[hits[best]].tolist()
                    distances_out += exact[best].tolist()
        return pa.table([pa.array(queries_out, asked.schema.field("query_id").type), pa.array(urls_out, pa.string()),
                         pa.array(distances_out, pa.float64())], names=["query_id", "url", "distance"])

    id_type = queries.schema["query_id"].dataType.simpleString()
    keys = ["list_id", "row_slice", "query_slice"]
    best = (left.select(*keys, "url", "embedding").groupBy(*keys)
            .cogroup(right.select(*keys, "query_id", "embedding").groupBy(*keys))
            .applyInArrow(block, f"query_id {id_type}, url string, distance double"))
    rank = Window.partitionBy("query_id").orderBy("distance", "url")
    return best.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "url", "distance")
