"""Mixing sources to target weights: hash-random order within each source, prefix sums, exact cuts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.llm.common import WORD, running_sum, stored, word_count


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """Target per source from a table (source, size) of documents: (source, source_size, target).

    Sources in code-point order, null last, take the weights in turn. They share ``share`` times all sizes by weight;
    a target stops at ``most`` times its source's size, and what is above is reshared by weight among the others.
    The result is a water level L with target = min(cap, L * weight): sources sorted by cap / weight fill up first, so
    L follows from prefix sums. Works on one row per source. Sources without words get target 0.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = totals.withColumn("_turn", (F.row_number().over(by_name) - 1) % len(weights))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("_turn").cast("int") + 1)
    weighted = weighted.withColumn("_w", weight).withColumn("_cap", most * F.col("source_size"))
    level = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    after = level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tried = (weighted.withColumn("_all", share * F.sum("source_size").over(whole))
             .withColumn("_full", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
             .withColumn("_rest", F.sum("_w").over(after))
             .withColumn("_level", (F.col("_all") - F.col("_full")) / F.col("_rest")))
    open_level = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level"))
    found = tried.withColumn("_found", F.first(open_level, ignorenulls=True).over(whole))
    target = F.least(F.col("_cap"), F.coalesce(F.col("_found") * F.col("_w"), F.col("_cap")))
    return found.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
                seed: int = 42) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (all columns of ``docs`` but ``text``).

    Each source's documents stand in the order of a hash of doc_id, text and seed; a distributed prefix sum of their
    words is cut at the source's budget (the whole part of its target). A budget beyond the source's size takes whole
    epochs first, then the cut one: ``taken`` is words, repeats counted, at most ``most`` times the size rounded up
    to epochs. The document at the cut gives only the words before it, so a source's taken words are exact.

    Null text has size 0 and takes nothing; a null source is a source, sorted last; null doc_ids and repeated rows
    are documents of their own; equal hashes fall back to doc_id, and rows that are equal may swap freely. An empty
    table gives an empty result. Other columns ride along; clashing names (size, target...) are replaced.
    """
    made = ("size", "source_size", "target", "taken", "_key", "_before", "_digest", "text")
    extra = [c for c in docs.columns if c not in made and c not in ("doc_id", "source")]
    sized = docs.select("doc_id", "source", *extra, word_count(F.col("text")).alias("size"), *_order(seed)[::2])
    joined = _budgeted(sized, weights, share, most)
    last = F.least(F.col("size"), F.greatest(F.lit(0), F.col("_rest") - F.col("_before")))
    return joined.select("doc_id", "source", *extra, "size", "source_size", "target",
                         (F.col("_epochs") * F.col("size") + last).cast("long").alias("taken"))


def _order(seed: int) -> list[Column]:
    """The order of documents within a source, for rows with doc_id and text."""
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    return [F.xxhash64(F.lit(seed), "doc_id", digest).alias("_key"), F.col("doc_id"), digest.alias("_digest")]


def _budgeted(sized: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Adds the words before a row in its source, the source's whole epochs and the words of its cut epoch."""
    placed = running_sum(sized, ["source"], ["_key", "doc_id", "_digest"], "size", "_before")
    targets = source_targets(placed.select("source", "size"), weights, share, most).withColumnRenamed("source", "_s")
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("_s")))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    return joined.withColumn("_epochs", epochs).withColumn("_rest", budget - F.col("_epochs") * F.col("source_size"))


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
                    seed: int = 42) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document stands once per epoch it is taken in.

    The one document at a source's cut keeps its words up to the cut. ``n_chars``, where it is a column, follows.
    Documents that are not taken, those without words among them, are absent.

    Only sizes and hashes are sorted: a source's cut is one place in the order, and a scan of the texts tells of each row
    on which side of it the row lies. Rows that are equal at the cut, nearly always one, are counted apart.
    """
    columns = docs.columns
    order = _order(seed)
    sized = docs.select("source", word_count(F.col("text")).alias("size"), *order)
    place = F.struct("_key", "doc_id", "_digest", (-F.col("_before")).alias("_back"))  # of equal rows the first
    cuts = stored(_budgeted(sized, weights, share, most).groupBy(F.col("source").alias("_s")).agg(
        F.first("_epochs").alias("_epochs"), F.first("_rest").alias("_rest"),
        F.max(F.when((F.col("size") > 0) & (F.col("_rest") > F.col("_before")), place)).alias("_cut")), "mix-cuts")

    row, cut = F.struct(*order), F.struct(*[F.col("_cut")[c].alias(c) for c in ("_key", "doc_id", "_digest")])
    has_cut = F.col("_cut").isNotNull()
    sided = docs.select("source", "text", row.alias("_at"), F.struct(*columns).alias("_row")).join(
        cuts, F.col("source").eqNullSafe(F.col("_s"))).where(F.regexp_like("text", F.lit(WORD)))
    tied = has_cut & (F.col("_at") == cut)
    times = F.col("_epochs") + F.when(has_cut & (F.col("_at") < cut), 1).otherwise(0)
    whole = sided.where(~tied).withColumn("_times", times).where("_times > 0").select(
        "_row", F.col("text").alias("_text"), F.explode(F.sequence(F.lit(1), "_times")))

    # equal rows at the cut share the words that are left there, one after the other
    turn = F.row_number().over(Window.partitionBy("source").orderBy("_at")) - 1
    at_cut = sided.where(tied).withColumn("size", word_count(F.col("text"))).withColumn("_turn", turn)
    left = F.col("_rest") + F.col("_cut")["_back"] - F.col("_turn") * F.col("size")
    last = F.least(F.col("size"), F.greatest(F.lit(0), left))
    taken = at_cut.withColumn("taken", F.col("_epochs") * F.col("size") + last).where("taken > 0")
    epoch = F.explode(F.sequence(F.lit(0), F.floor((F.col("taken") - 1) / F.col("size")).cast("long")))
    words = F.least(F.col("size"), F.col("taken") - F.col("_epoch") * F.col("size"))
    parts = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    head = F.array_join(F.slice(parts, F.lit(1), words.cast("int")), "")
    part = taken.withColumn("_epoch", epoch).select(
        "_row", F.when(words < F.col("size"), head).otherwise(F.col("text")).alias("_text"))

    out = whole.select("_row", "_text").unionByName(part)
    value = {"text": F.col("_text"), "n_chars": F.length("_text").cast(docs.schema["n_chars"].dataType)
             if "n_chars" in columns else None}
    return out.select(*[(value[c] if c in value else F.col("_row")[c]).alias(c) for c in columns])
