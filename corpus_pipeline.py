"""A corpus made ready for training: language ID, near copies, mixing of sources, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crawlweave.llm import jaccard, language, mixing, packing
from crawlweave.llm.common import stored, table
from crawlweave.session import apply_defaults


def keep_recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or letters go; a null lang takes the predicted one."""
    apply_defaults(spark)
    return language.recognised(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five words, similarity 0.8) stays, that with the smallest doc_id."""
    apply_defaults(spark)
    return jaccard.without_near_copies(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; the one at a source's cut up to the cut."""
    apply_defaults(spark)
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 ids."""
    apply_defaults(spark)
    return packing.pack_documents(docs).drop("piece")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_recognised), ("near_copies", drop_near_copies), ("mixing", mix), ("packing", pack)]

#: Suffix automata and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
