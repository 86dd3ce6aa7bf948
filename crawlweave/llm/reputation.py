"""URL filters: prefix rules on (host, path), and empirical-Bayes host reputation for urls no rule fits.

Everything here is Columns and DataFrame operations; no Python runs on a row.

Parsing. Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased (nothing else); path: from
there up to ``?``, ``#`` or the end. A null url, or one without ``://``, has empty host and path.

Rules. A rule (host, path, verdict) fits a url whose host is the rule's host or one of its subdomains (ends with ``.`` and
the rule's host) and whose path starts with the rule's path. Of the rules that fit, the longest ``host + path`` wins; a
tie of equal lengths goes to ``block``, then to the smaller rule string. Rules are a driver-side parameter (a Python list,
bounded by the caller); they reach each row as one literal map from rule host to rules, and each url looks up its own
host suffixes in it: no join, no shuffle for the rule part, whatever the number of pages.

Reputation. Labelled outcomes are ``labels`` rows whose doc_id equals a page's page_id: bad when ``toxic = 1`` or
``quality = 0``, good when ``toxic = 0`` or ``quality = 1``, no outcome when both are null. Outcomes are counted per host,
then summed to the registered domain (the host's last two dot labels) and the suffix (its last label). Each level's prior
is a beta distribution centred on the posterior mean of the level above (the suffixes' on the global rate) with a
concentration fitted by the method of moments from the spread of that level's counts (beta-binomial intra-class
correlation, clipped to [``min_rho``, 1]): few outcomes shrink a host to its domain, a domain to its suffix. A url whose
host's posterior lower bound ``mean - z * sd`` is above ``max_bad`` is blocked, every other one allowed. Hosts without any
outcome take their domain's prior, and so on up.

Defined cases: null or repeated page_id and url rows each get their own row (a repeated page counts its labels again);
labels with a repeated doc_id count each row; null quality and toxic together count nothing; an empty table gives no rows;
columns beside ``page_id`` and ``url`` are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweave.llm.common import stored

# Fixed values of the contract: the rules (host, path, verdict) in the order given.
RULES: tuple[tuple[str, str, str], ...] = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url by the rules of the module docstring; empty strings where there is none."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.translate(F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit("")), UPPER, LOWER)
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def _rule_map(rules: Sequence[tuple[str, str, str]]) -> Column:
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for host, path, verdict in rules:
        by_host.setdefault(host, []).append((host, path, verdict))
    if not by_host:
        return F.create_map().cast("map<string,array<struct<host:string,path:string,verdict:string>>>")
    pairs = []
    for host, entries in by_host.items():
        pairs += [F.lit(host), F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"),
                                                   F.lit(v).alias("verdict")) for h, p, v in entries])]
    return F.create_map(*pairs)


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The winning rule as struct(rule, verdict), or null: host suffixes looked up in a literal map of the rules."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    table = _rule_map(rules)
    found = F.flatten(F.transform(suffixes, lambda s: F.coalesce(F.element_at(table, s), F.array().cast(
        "array<struct<host:string,path:string,verdict:string>>"))))
    fitting = F.filter(found, lambda r: F.startswith(path, r["path"]))
    ranked = F.transform(fitting, lambda r: F.struct(
        F.length(F.concat(r["host"], r["path"])).alias("n"), (r["verdict"] == "block").alias("blocks"),
        F.concat(r["host"], r["path"]).alias("rule"), r["verdict"].alias("verdict")))
    # longest first; among equal lengths block, then the smaller rule string
    top = F.array_sort(ranked, lambda a, b: F.when(a["n"] != b["n"], F.when(a["n"] > b["n"], -1).otherwise(1))
                       .when(a["blocks"] != b["blocks"], F.when(a["blocks"], -1).otherwise(1))
                       .when(a["rule"] < b["rule"], -1).when(a["rule"] > b["rule"], 1).otherwise(0))
    first = F.get(top, 0)
    return F.when(F.size(fitting) > 0, F.struct(first["rule"].alias("rule"), first["verdict"].alias("verdict")))


def outcomes(labels: DataFrame) -> DataFrame:
    """(doc_id, n, k): labelled outcomes and bad ones per doc_id, summed over repeated rows."""
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).when(
        (F.col("toxic") == 0) | (F.col("quality") == 1), 0)
    return (labels.select("doc_id", bad.alias("bad")).where("bad is not null and doc_id is not null")
            .groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("bad").alias("k")))


def _parent_keys(host: Column) -> tuple[Column, Column]:
    labels = F.split(host, r"\.")
    domain = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    return domain, F.element_at(labels, -1)


def _concentration(level: DataFrame, mean: str, min_rho: float) -> float:
    """Method-of-moments beta concentration of a level whose rows hold n, k and their prior mean ``mean``."""
    spread = level.where("n > 0").agg(
        F.sum((F.col("k") - F.col("n") * F.col(mean)) ** 2).alias("d"),
        F.sum(F.col("n") * F.col(mean) * (1 - F.col(mean))).alias("e"),
        F.sum(F.col("n") * (F.col("n") - 1) * F.col(mean) * (1 - F.col(mean))).alias("w")).first()
    d, e, w = (float(spread[c] or 0.0) for c in ("d", "e", "w"))
    rho = (d - e) / w if w > 0 else min_rho
    rho = min(max(rho, min_rho), 1.0)
    return 1.0 / rho - 1.0


def host_reputation(pages: DataFrame, labels: DataFrame, max_bad: float = 0.5, z: float = 1.645,
                    min_rho: float = 1e-4) -> DataFrame:
    """One row per distinct host of ``pages``: host, n, k, mean, lower (posterior lower bound of the bad rate).

    Four aggregates of one row each travel to the driver (global rate and three concentrations); everything else is
    grouped and joined on host, domain or suffix keys, partial sums before every exchange. The host counts and the
    result are written tables (one row per host), so the driver's aggregates do not re-read the pages.
    """
    host, _ = host_and_path(F.col("_url"))
    counted = (pages.select(F.col("page_id"), F.col("url").alias("_url"))
               .join(outcomes(labels), F.col("page_id") == F.col("doc_id"), "left")
               .groupBy(host.alias("host"))
               .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")))
    domain, suffix = _parent_keys(F.col("host"))
    hosts = stored(counted.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "k"), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    rate = (float(total["k"]) / float(total["n"])) if total and total["n"] else 0.0

    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")) \
        .withColumn("prior", F.lit(rate))
    m = _concentration(suffixes, "prior", min_rho)
    suffixes = suffixes.select("suffix", ((F.col("k") + m * F.col("prior")) / (F.col("n") + m)).alias("suffix_mean"))

    domains = (hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
               .join(suffixes, "suffix").withColumnRenamed("suffix_mean", "prior"))
    m = _concentration(domains, "prior", min_rho)
    domains = domains.select("domain", "suffix",
                             ((F.col("k") + m * F.col("prior")) / (F.col("n") + m)).alias("domain_mean"))

    scored = hosts.join(domains, ["domain", "suffix"]).withColumnRenamed("domain_mean", "prior")
    m = _concentration(scored, "prior", min_rho)
    a = F.col("k") + m * F.col("prior")
    b = F.col("n") - F.col("k") + m * (1 - F.col("prior"))
    mean = a / (a + b)
    sd = F.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
    return stored(scored.select("host", "n", "k", mean.alias("mean"), (mean - z * sd).alias("lower"),
                                (mean - z * sd > max_bad).alias("bad_host")), "reputation")


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
               max_bad: float = 0.5, z: float = 1.645) -> DataFrame:
    """page_id, host, path, rule (``host + path`` of the winning rule, else null), verdict (allow or block)."""
    reputation = host_reputation(pages, labels, max_bad=max_bad, z=z).select("host", "bad_host")
    host, path = host_and_path(F.col("_url"))
    parsed = pages.select("page_id", F.col("url").alias("_url")).select("page_id", host.alias("host"),
                                                                         path.alias("path"))
    ruled = parsed.withColumn("_rule", best_rule(F.col("host"), F.col("path"), rules))
    method = F.when(F.coalesce(F.col("bad_host"), F.lit(False)), "block").otherwise("allow")
    return (ruled.join(reputation, "host", "left")
            .select("page_id", "host", "path", F.col("_rule.rule").alias("rule"),
                    F.coalesce(F.col("_rule.verdict"), method).alias("verdict")))
