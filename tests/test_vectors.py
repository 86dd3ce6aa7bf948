import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweave.operators.embed import code_point_embedder, embed
from crawlweave.operators.vectors import ivf_assign, ivf_build, ivf_search, similar_pages


def table_of(spark, vectors):
    rows = [(str(i), f"t{i}", "page", v and [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "url string, title string, detected_type string, embedding array<float>")


def test_embedding_by_hand(spark):
    rows = spark.createDataFrame([("",), ("abc",), ("é😀",), (None,)], "text string")
    got = {r["text"]: r["embedding"] for r in embed(rows, dim=2).collect()}
    assert got[""] == [0, 0] and got[None] is None
    assert got["abc"] == pytest.approx([(97 + 99) / 255, 98 / 255])
    assert got["é😀"] == pytest.approx([0xE9 / 255, 0x1F600 / 255])


def test_embedding_sum_is_the_sum_of_code_points(spark):
    texts: list[str] = []

    @settings(max_examples=60, deadline=None)
    @given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=300))
    def gather(text):
        texts.append(text)

    gather()
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for row in embed(rows, dim=7).collect():
        assert round(sum(row["embedding"]) * 255) == sum(map(ord, texts[row["i"]]))


def test_default_dimension(spark):
    assert len(embed(spark.createDataFrame([("x",)], "text string")).first()["embedding"]) == 384


def test_wrong_length_fails(spark):
    rows = spark.createDataFrame([("x",)], "text string")
    with pytest.raises(Exception, match="embedding length"):
        embed(rows, code_point_embedder(3), dim=4).collect()


def test_similar_pages(spark):
    table = table_of(spark, [[1, 0], [0, 1], [1, 1], [0, 0], None, [-1, 0]])
    got = similar_pages(table, "0").collect()
    assert [(r["url"], None if r["cosine_sim"] is None else round(r["cosine_sim"], 6)) for r in got] == [
        ("2", round(1 / math.sqrt(2), 6)), ("1", 0.0), ("5", -1.0), ("3", None), ("4", None)]
    assert similar_pages(table, "none").count() == 0
    assert similar_pages(table, "0", k=2).count() == 2


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 8)) * 5
    # A third of all vectors lie in one place.
    which = np.where(np.arange(900) % 3 == 0, 0, rng.integers(0, 6, 900))
    vectors = (centers[which] + rng.normal(size=(900, 8))).astype(np.float32)
    table = table_of(spark, vectors.tolist())
    path = str(tmp_path_factory.mktemp("ivf"))
    model = ivf_build(table, path, lists=6)
    return table, path, vectors, model


def test_index_loses_no_row_and_uses_the_nearest_list(spark, indexed):
    table, path, vectors, model = indexed
    rows = spark.read.parquet(f"{path}/rows").collect()
    assert sorted(int(r["url"]) for r in rows) == list(range(900))
    centers = np.array(model.clusterCenters())
    for row in rows:
        distance = np.linalg.norm(centers - vectors[int(row["url"])], axis=1)
        assert distance[row["list_id"]] <= distance.min() + 1e-6
    assert ivf_assign(table, model).count() == 900


def brute(vectors, query, k):
    distance = np.sqrt(((vectors.astype(float) - vectors[query].astype(float)) ** 2).sum(1))
    return sorted(zip(distance, map(str, range(len(vectors)))))[:k]


@pytest.mark.parametrize("block_rows, block_queries", [(50_000, 2_000), (40, 7)])
def test_all_lists_equal_exact_search(spark, indexed, block_rows, block_queries):
    table, path, vectors, _ = indexed
    queries = table.filter(F.col("url").cast("int") % 30 == 0).select(F.col("url").cast("int").alias("query_id"), "embedding")
    got = ivf_search(spark, path, queries, k=5, nprobe=6, block_rows=block_rows, block_queries=block_queries).collect()
    assert len(got) == 30 * 5
    for query in range(0, 900, 30):
        mine = sorted((r for r in got if r["query_id"] == query), key=lambda r: r["rank"])
        want = brute(vectors, query, 5)
        assert [r["url"] for r in mine] == [u for _, u in want]
        assert [r["distance"] for r in mine] == pytest.approx([d for d, _ in want])


def test_recall_with_few_lists(spark, indexed):
    table, path, vectors, _ = indexed
    queries = table.select(F.col("url").cast("int").alias("query_id"), "embedding")
    got = ivf_search(spark, path, queries, k=5, nprobe=2).collect()
    found = {(r["query_id"], r["url"]) for r in got}
    hits = sum((q, u) in found for q in range(0, 900, 9) for _, u in brute(vectors, q, 5))
    assert hits >= 0.9 * 100 * 5


def test_embedder_may_be_replaced(spark):
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def length(texts):
        return texts.map(lambda t: [float(len(t))])

    assert embed(spark.createDataFrame([("abc",)], "text string"), length, dim=1).first()["embedding"] == [3.0]
