"""Balanced label propagation: linked documents gather in shards, counts of which stay at most one apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.llm.common import ranked, stored

BINS = 4096


def _accepted(wishes: DataFrame, room: DataFrame, salt: int) -> DataFrame:
    """The wishes (doc, to, unit) that fit into the room (shard, room) of their target.

    Wishes fall into bins by a hash of ``unit``; bins are taken in order while their running sum fits. The sums need
    one row per target and bin, however many wishes there are.
    """
    binned = wishes.withColumn("bin", F.pmod(F.xxhash64("unit", F.lit(salt)), F.lit(BINS)))
    sums = binned.groupBy("to", "bin").agg(F.count("*").alias("n")).withColumn(
        "upto", F.sum("n").over(Window.partitionBy("to").orderBy("bin")))
    fits = sums.join(room, F.col("to") == F.col("shard")).where("upto <= room").select("to", "bin")
    return binned.join(fits, ["to", "bin"], "left_semi")


def balanced_shards(docs: DataFrame, n_shards: int = 16, rounds: int = 6, seed: int = 42) -> DataFrame:
    """Shards for (key, link): adds shard (0 to n_shards - 1) and slot (gapless from 0 in the shard).

    Documents with equal ``link`` (null: none) are neighbours; the shards' counts differ by one at most. Linked
    documents start in the shard of a hash. In each round they ask for the shard that holds most of their
    neighbours (ties: least hash) among those with room; as many as its quota allows move, the rest stays and tries again. A group too large
    for one shard so fills one after the other. A last pass moves whoever is still above a quota, then documents without
    neighbours fill what is left. Neighbours are counted per (link, shard), at most ``n_shards`` rows a link, so edges
    are never listed and no group meets in one task.

    Null keys and repeated rows are documents of their own. An empty table gives no rows. Other columns ride along.
    """
    spark = docs.sparkSession
    own = F.struct(*docs.columns)
    # ranks make every row distinct, repeated ones too
    base = ranked(docs.select(own.alias("row"), F.col("link"), F.xxhash64(F.lit(seed), "key").alias("h"), F.col("key")),
                  [], ["h", "key", "link"], "id")
    counts = base.groupBy("link").agg(F.count("*").alias("members"))
    total = base.count()
    base = stored(base.join(counts, "link", "left").select("id", "row", "link", F.when(
        F.col("link").isNotNull() & (F.col("members") > 1), F.col("members")).alias("members")), "shard-docs")
    quotas = spark.range(n_shards).select(F.col("id").cast("int").alias("shard"), (
        F.lit(total // n_shards) + (F.col("id") < total % n_shards).cast("long")).alias("quota"))

    linked = base.where("members is not null").select("id", "link", "members")
    # small groups move as one, members of large ones one by one
    unit = F.when(F.col("members") * 64 * n_shards > total, F.xxhash64("id")).otherwise(F.xxhash64("link"))
    at = stored(linked.select("id", "link", unit.alias("unit"), F.pmod(
        F.xxhash64("id", F.lit(seed)), F.lit(n_shards)).cast("int").alias("shard")), "shard-at")
    for step in range(rounds):
        used = at.groupBy("shard").agg(F.count("*").alias("used"))
        room = stored(quotas.join(used, "shard", "left").select(
            "shard", (F.col("quota") - F.coalesce("used", F.lit(0))).alias("room")), "shard-room")
        held = at.groupBy("link", "shard").agg(F.count("*").alias("n")).join(room, "shard")
        best = Window.partitionBy("link").orderBy(F.desc("n"), F.xxhash64("link", "shard"), "shard")
        # a shard is worth asking for while it has room; one that is full or above keeps what it has
        goal = held.where("room > 0").withColumn("r", F.row_number().over(best)).where("r = 1").select(
            F.col("link").alias("l"), F.col("shard").alias("to"), F.col("n").alias("there"))
        here = held.select(F.col("link").alias("l2"), F.col("shard").alias("s2"), F.col("n").alias("here"))
        wish = goal.join(here, F.col("l") == F.col("l2")).where(
            (F.col("s2") != F.col("to")) & ((F.col("here") < F.col("there")) | (
                (F.col("here") == F.col("there")) & (F.xxhash64("l", "s2") > F.xxhash64("l", "to"))))).select(
            "l", "s2", "to")
        movers = at.join(wish, (at["link"] == wish["l"]) & (at["shard"] == wish["s2"])).select(
            "id", "unit", "to")
        moved = _accepted(movers, room, step).select(F.col("id").alias("mid"), "to")
        at = stored(at.join(moved, F.col("id") == F.col("mid"), "left").select(
            "id", "link", "unit", F.coalesce("to", "shard").alias("shard")), "shard-at")

    # exact counts: linked rows up to the quota stay (whole groups first by hash), all others fill the gaps by rank
    standing = ranked(at.withColumn("g", F.xxhash64("link")), ["shard"], ["g", "link", "id"], "place").join(quotas, "shard")
    stay = stored(standing.where("place < quota").select("id", "shard"), "shard-stay")
    gaps = quotas.join(stay.groupBy("shard").agg(F.count("*").alias("used")), "shard", "left").withColumn(
        "gap", F.col("quota") - F.coalesce("used", F.lit(0)))
    # n_shards rows at most come to the driver
    edges, reached = [], 0
    for shard, gap in sorted((r["shard"], r["gap"]) for r in gaps.where("gap > 0").collect()):
        reached += gap
        edges.append((shard, reached))
    free = ranked(base.select("id", "link").join(stay, "id", "left_anti").withColumn("g", F.coalesce(
        F.xxhash64("link"), F.xxhash64("id"))), [], ["g", "id"], "place")
    if edges:
        full = F.size(F.filter(F.array(*[F.lit(high) for _, high in edges]), lambda high: high <= F.col("place")))
        shard = F.element_at(F.array(*[F.lit(shard) for shard, _ in edges]), full + 1)
        stay = stay.union(free.select("id", shard.alias("shard")))
    placed = base.join(stay, "id")
    slots = ranked(placed.select("row", "shard", "id"), ["shard"], ["id"], "slot")
    keep = [c for c in docs.columns if c not in ("shard", "slot")]
    return slots.select(*[F.col("row")[c].alias(c) for c in keep], "shard", "slot")


def shard_documents(docs: DataFrame, n_shards: int = 16, rounds: int = 6) -> DataFrame:
    """Shards of documents linked by equal texts: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 bytes of the text plus 1. Null texts have no bytes, crc32 0 and no links; empty texts are
    equal to each other. The law is ``rows``: counts of shards are at most one apart, so ``grown_shard`` is null.
    """
    text = F.coalesce("text", F.lit(""))
    slim = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.col("doc_id").alias("key"), F.when(F.col("text").isNotNull(), F.sha2("text", 256)).alias("link"))
    placed = balanced_shards(slim, n_shards, rounds)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "link")


def cut_links(placed: DataFrame) -> DataFrame:
    """Edges between neighbours (pairs with equal ``link``) in all and those cut by shards: n_links, n_cut; one row."""
    pairs = (F.col("n") * (F.col("n") - 1) / 2).cast("long")
    inside = placed.where("link is not null").groupBy("link", "shard").agg(F.count("*").alias("n"))
    by_link = inside.groupBy("link").agg(F.sum("n").alias("n"), F.sum(pairs).alias("kept"))
    return by_link.agg(F.coalesce(F.sum(pairs), F.lit(0)).alias("n_links"),
                       F.coalesce(F.sum(pairs - F.col("kept")), F.lit(0)).alias("n_cut"))
