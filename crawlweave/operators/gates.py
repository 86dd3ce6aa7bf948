"""Filters before the fetch: depth, robots rules, origin cap, fetch status, empty text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlweave.functions.text import first_text
from crawlweave.functions.urls import escape_pattern, origin_of, request_path
from crawlweave.options import MAX_DEPTH, MAX_PER_ORIGIN

_ROBOTS_STATE = ("struct<agents: array<string>, open: boolean, "
                 "rules: array<struct<agent: string, allow: boolean, pattern: string, rule_no: int>>>")


def depth_gate(tasks: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Tasks not deeper than the limit."""
    return tasks.filter(F.col("depth") <= max_depth)


def child_tasks(tasks: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Tasks whose links may be followed, with the depth of those links."""
    return tasks.filter(F.col("depth") + 1 <= max_depth).withColumn("depth", F.col("depth") + 1)


def robots_rules(robots: DataFrame) -> DataFrame:
    """Robots texts ``(origin, body)`` -> ``(origin, agent, allow, pattern, rule_no)``.

    Lines are folded inside the row that holds the text: no shuffle, however large an origin is.
    """
    lines = F.split(F.coalesce("body", F.lit("")), r"\r\n|\r|\n")
    pairs = F.transform(lines, lambda line, i: F.struct(
        F.lower(F.trim(F.substring_index(F.substring_index(line, "#", 1), ":", 1))).alias("name"),
        F.trim(F.regexp_extract(F.substring_index(line, "#", 1), r"^[^:]*:(.*)$", 1)).alias("value"),
        F.substring_index(line, "#", 1).contains(":").alias("ok"),
        i.alias("no")))

    def step(state: Column, line: Column) -> Column:
        is_agent = line["name"] == "user-agent"
        agents = F.when(is_agent, F.concat(F.when(state["open"], state["agents"]).otherwise(
            F.array().cast("array<string>")), F.array(F.lower(F.trim(F.substring_index(line["value"], "/", 1)))))
                        ).otherwise(state["agents"])
        added = F.transform(state["agents"], lambda agent: F.struct(
            agent.alias("agent"), (line["name"] == "allow").alias("allow"), line["value"].alias("pattern"),
            line["no"].cast("int").alias("rule_no")))
        is_rule = line["name"].isin("allow", "disallow") & (line["value"] != "")
        return F.struct(
            agents.alias("agents"),
            is_agent.alias("open"),
            F.when(is_rule, F.concat(state["rules"], added)).otherwise(state["rules"]).alias("rules"),
        ).cast(_ROBOTS_STATE)

    start = F.struct(F.array().cast("array<string>").alias("agents"), F.lit(False).alias("open"), F.array().cast(
        "array<struct<agent: string, allow: boolean, pattern: string, rule_no: int>>").alias("rules")).cast(_ROBOTS_STATE)
    usable = F.filter(pairs, lambda line: line["ok"] & (line["name"] != ""))
    return (robots.select("origin", F.explode(F.aggregate(usable, start, step)["rules"]).alias("rule"))
            .select("origin", "rule.*"))


def _rule_regex(pattern: Column) -> Column:
    """A robots pattern as an anchored regular expression: ``*`` is any run, a last ``$`` the end."""
    quoted = F.regexp_replace(pattern, r"[-\[\]{}()+?.\\^$|]", r"\\$0")
    return F.concat(F.lit("(?s)^"), F.regexp_replace(F.regexp_replace(quoted, r"\*+", ".*"), r"\\\$\z", r"\\z"))


def robots_gate(tasks: DataFrame, rules: DataFrame, agent: str = "*") -> DataFrame:
    """Tasks the agent may fetch: the longest matching pattern decides, allow wins ties, no rule allows.

    One row of rules per origin meets the tasks, so nothing is multiplied. Spark broadcasts the rules only while
    they are small; beyond that a hot origin is split by the skew join.
    """
    by_origin = (rules.filter(F.col("agent") == agent)
                 .withColumn("pattern", escape_pattern("pattern"))
                 .groupBy(F.col("origin").alias("_origin"))
                 .agg(F.collect_list(F.struct(F.length("pattern").alias("size"), "allow",
                                              _rule_regex(F.col("pattern")).alias("regex"))).alias("_rules")))
    verdict = F.array_max(F.transform(
        F.filter("_rules", lambda rule: F.rlike(F.col("_path"), rule["regex"])),
        lambda rule: F.struct(rule["size"], rule["allow"].alias("allow"))))["allow"]
    return (tasks.withColumn("_origin", origin_of(F.col("url"))).withColumn("_path", request_path(F.col("url")))
            .join(by_origin, "_origin", "left")
            .filter(F.coalesce(verdict, F.lit(True)))
            .select(*tasks.columns))


def nonempty_text(docs: DataFrame) -> DataFrame:
    """Documents whose first body child has text, which is added as ``text``."""
    return docs.withColumn("text", first_text(F.col("body"))).filter(F.length("text") > 0)


def status_triage(log: DataFrame, retries: int = 2) -> DataFrame:
    """Classify fetch attempts by status and give the wait before the next try."""
    status, attempt = F.col("status"), F.col("attempt")
    again = ((status == 429) | (status >= 500)) & (attempt < retries)
    return (log.withColumn("outcome", F.when(status.between(200, 399), "ok").when(again, "retry").otherwise("fail"))
            .withColumn("wait_ms", F.when(again, (1000 * F.pow(F.lit(2), attempt)).cast("bigint"))))


def origin_slots(tasks: DataFrame, limit: int = MAX_PER_ORIGIN, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """All tasks, dealt so that at most ``limit`` of an origin are in work at once: each has ``limit`` slots.

    A slot's tasks lie in one partition and so run one after the other, high priority first; nothing waits for another
    round. The slot is a hash of the url, so no task has to see a whole origin.
    """
    return (tasks.withColumn("_slot", F.pmod(F.xxhash64("url"), F.lit(limit)))
            .withColumn("_turn", F.when(F.col("priority") == "high", 0).otherwise(1))
            .repartition("origin", "_slot").sortWithinPartitions("origin", "_slot", "_turn", *order)
            .select(*tasks.columns))


def origin_cap(tasks: DataFrame, limit: int = MAX_PER_ORIGIN, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """At most ``limit`` tasks per origin are ``ok``, the others ``retry``; high priority goes first.

    ``order`` names a unique key. Spark cuts each map task to ``limit`` rows per origin before the shuffle; the
    verdict is joined back on the unique key, so a hot origin never gathers in one task.
    """
    rank = Window.partitionBy("origin").orderBy(F.when(F.col("priority") == "high", 0).otherwise(1), *order)
    admitted = (tasks.select("origin", "priority", *order)
                .withColumn("_rank", F.row_number().over(rank)).filter(F.col("_rank") <= limit)
                .select(*order, F.lit("ok").alias("_admitted")))
    return (tasks.join(admitted, list(order), "left")
            .select(*tasks.columns, F.coalesce("_admitted", F.lit("retry")).alias("outcome")))
