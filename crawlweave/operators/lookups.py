"""Read paths of the keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_type(pages: DataFrame, detected_type: str, n: int) -> DataFrame:
    """Newest ``n`` pages of a type; each task keeps n rows, only those are merged."""
    return (pages.filter(F.col("detectedType") == detected_type)
            .orderBy(F.col("meta.fetchedAt").desc(), "url").limit(n))


def same_content(pages: DataFrame) -> DataFrame:
    """``(content_hash, url)`` pairs of content found under more than one url, with the number of urls.

    Pairs are made distinct and counted with map-side combine; no list per hash is built, and the join back only
    carries hash and url, so a hash with a third of the rows is split by the skew join.
    """
    pairs = pages.select("content_hash", "url").distinct()
    shared = pairs.groupBy("content_hash").agg(F.count("*").alias("n_urls")).filter(F.col("n_urls") > 1)
    return pairs.join(shared, "content_hash").select("content_hash", "url", "n_urls")


def products_lookup(products: DataFrame, keys: DataFrame) -> DataFrame:
    """Products whose ``productId`` or ``slug`` is wanted; rows without the field are not indexed.

    ``keys`` has ``productId`` and ``slug``, either may be null. Two equi semi joins instead of one OR join.
    """
    wanted_ids = keys.select("productId").filter(F.col("productId").isNotNull()).distinct()
    wanted_slugs = keys.select("slug").filter(F.col("slug").isNotNull()).distinct()
    by_id = products.join(wanted_ids, "productId", "left_semi").select(*products.columns)
    by_slug = products.join(wanted_slugs, "slug", "left_semi").select(*products.columns)
    return by_id.unionByName(by_slug).dropDuplicates(["url"])
