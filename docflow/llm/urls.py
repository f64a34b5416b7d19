"""URL verdicts by rules and by trust over the host graph (dealt operator 8).

Rules decide where they fit. For all other urls the host decides: trust spreads
from hosts with allowed urls along their links (personalised PageRank), distrust
from hosts with blocked urls against the links, and a host is blocked if its
distrust outweighs its trust. Links are those of the pages' markup, and between
a host and its parent domain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import ascii_lower, fresh, written

DAMPING = 0.85
ROUNDS, ROUNDS_A_JOB = 20, 5
TOLERANCE = 1e-4
# Distrust must be this many times the trust to block a host without a rule.
BLOCK_RATIO = 2.0
LINK = r"""href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""
RULES = "rule_host string, rule_path string, rule string, verdict string"


def url_host(url: Column | str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column | str) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def parse_rule(rule: str, verdict: str) -> tuple[str, str, str, str]:
    host, slash, path = rule.partition("/")
    return host.lower(), slash + path, rule, verdict


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules) with the rules of each host itself and of the domains above it."""
    labels = F.split("host", r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    near = hosts.select("host", F.explode(above).alias("rule_host")).join(rules, "rule_host")
    rule = F.struct("rule_path", "rule", "verdict")
    return near.groupBy("host").agg(F.collect_list(rule).alias("rules"))


def best_rule(path: str, rules: str = "rules") -> Column:
    """The longest rule whose path starts the url's; equal ones: block before allow."""
    fits = F.filter(rules, lambda r: F.startswith(F.col(path), r["rule_path"]))
    return F.array_max(
        F.transform(fits, lambda r: F.struct(F.length(r["rule"]).alias("n"), r["verdict"], r["rule"]))
    )


def host_edges(pages: DataFrame, html_col: str) -> DataFrame:
    """(src, dst, weight): links between hosts, and steps between a host and its parent domain."""
    linked = F.explode(F.array_distinct(F.regexp_extract_all(html_col, F.lit(LINK), 1)))
    links = pages.select(F.col("host").alias("src"), linked.alias("dst")).select("src", ascii_lower("dst").alias("dst"))
    links = links.where("src != '' AND src != dst").groupBy("src", "dst").agg(F.count("*").alias("weight"))
    hosts = pages.select("host").where("host != ''").distinct()
    parent = F.regexp_replace("host", r"^[^.]*\.", "")
    steps = hosts.select(F.col("host").alias("src"), parent.alias("dst")).where("src != dst")
    steps = steps.join(hosts.withColumnRenamed("host", "dst"), "dst", "left_semi").select("src", "dst")
    steps = steps.unionAll(steps.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    every = links.unionAll(steps.withColumn("weight", F.lit(1).cast("long")))
    return every.groupBy("src", "dst").agg(F.sum("weight").cast("double").alias("weight"))


def _shares(edges: DataFrame, by: str) -> DataFrame:
    totals = edges.groupBy(by).agg(F.sum("weight").alias("total"))
    return edges.join(totals, by).select("src", "dst", (F.col("weight") / F.col("total")).alias("share"))


def propagate(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(host, trust, distrust) from ``nodes`` (host, allowed, blocked) over ``edges``.

    Both start from, and return to, the hosts with allowed or blocked urls, in
    proportion; an allowed url weighs as much as a blocked one. Without such
    hosts they are 0 everywhere.
    """
    total = float(nodes.agg(F.sum(F.col("allowed") + F.col("blocked"))).first()[0] or 1)
    seeds = nodes.select(
        "host", (F.col("allowed") / total).alias("good"), (F.col("blocked") / total).alias("bad")
    )
    seeds = written(seeds, "seeds")
    ranks = seeds.select("*", F.col("good").alias("trust"), F.col("bad").alias("distrust"))
    if edges.isEmpty():
        return ranks.select("host", "trust", "distrust")
    forward = written(_shares(edges, "src"), "forward")
    backward = written(_shares(edges, "dst"), "backward")
    for _ in range(ROUNDS // ROUNDS_A_JOB):
        old = ranks
        for _ in range(ROUNDS_A_JOB):
            given = ranks.select(F.col("host").alias("src"), "trust").join(forward, "src")
            given = given.groupBy(F.col("dst").alias("host")).agg(F.sum(F.col("trust") * F.col("share")).alias("t"))
            taken = ranks.select(F.col("host").alias("dst"), "distrust").join(backward, "dst")
            taken = taken.groupBy(F.col("src").alias("host")).agg(
                F.sum(F.col("distrust") * F.col("share")).alias("d")
            )
            both = seeds.join(given, "host", "left").join(taken, "host", "left")
            ranks = both.select(
                "host",
                "good",
                "bad",
                ((1 - DAMPING) * F.col("good") + DAMPING * F.coalesce("t", F.lit(0.0))).alias("trust"),
                ((1 - DAMPING) * F.col("bad") + DAMPING * F.coalesce("d", F.lit(0.0))).alias("distrust"),
            )
        ranks = written(ranks, "ranks")
        was = old.select("host", F.col("trust").alias("t"), F.col("distrust").alias("d"))
        moved = F.sum(F.abs(F.col("trust") - F.col("t")) + F.abs(F.col("distrust") - F.col("d")))
        if (ranks.join(was, "host").agg(moved).first()[0] or 0.0) < TOLERANCE:
            break
    return ranks.select("host", "trust", "distrust")


def judge_urls(df: DataFrame, rules: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule``, ``verdict``, ``trust`` and ``distrust``.

    ``rules`` has the columns of ``RULES``; a rule fits its host and all
    subdomains if the path starts with its path, and the longest wins. A null
    url, or one without ``://``, has an empty host and path, fits no rule and is
    allowed. Null markup has no links. Hosts that neither trust nor distrust
    reaches are allowed. Every row is judged by itself; an empty table gives no
    rows. Columns of ``df`` with these names keep them, ours get underscores.
    """
    host, path, rule, verdict, trust, distrust = fresh(
        df, "host", "path", "rule", "verdict", "trust", "distrust"
    )
    urls = df.select(url_host(url_col).alias("host"), url_path(url_col).alias("path"), html_col)
    edges = written(host_edges(urls, html_col), "links")
    linked = edges.select(F.col("src").alias("host")).unionAll(edges.select(F.col("dst").alias("host")))
    hosts = written(urls.select("host").where("host != ''").unionAll(linked).distinct(), "hosts")
    fitting = written(host_rules(hosts, rules), "rules")
    # Urls of one host and path are judged once, however often they occur.
    paths = urls.groupBy("host", "path").agg(F.count("*").alias("n")).join(fitting, "host")
    ruled = paths.select("host", "n", best_rule("path").alias("best"))
    seeds = ruled.groupBy("host").agg(
        F.sum(F.when(F.col("best.verdict") == "allow", F.col("n")).otherwise(0)).alias("allowed"),
        F.sum(F.when(F.col("best.verdict") == "block", F.col("n")).otherwise(0)).alias("blocked"),
    )
    nodes = hosts.join(seeds, "host", "left").na.fill(0, ["allowed", "blocked"])
    ranks = propagate(nodes, edges)
    known = hosts.join(ranks, "host").join(fitting, "host", "left")
    h, rs, best = fresh(df.select("*", *(F.lit(0).alias(c) for c in (host, path, rule, verdict, trust, distrust))),
                        "of_host", "rules", "best")
    known = written(
        known.select(F.col("host").alias(h), F.col("trust").alias(trust), F.col("distrust").alias(distrust),
                     F.col("rules").alias(rs)),
        "known",
    )
    judged = df.withColumns({host: url_host(url_col), path: url_path(url_col)})
    judged = judged.join(known, F.col(host) == F.col(h), "left").withColumn(best, best_rule(path, rs))
    by_host = F.when(F.col(distrust) > BLOCK_RATIO * F.col(trust), "block").otherwise("allow")
    return judged.select(
        *df.columns,
        host,
        path,
        F.col(f"{best}.rule").alias(rule),
        F.coalesce(F.col(f"{best}.verdict"), by_host).alias(verdict),
        F.coalesce(trust, F.lit(0.0)).alias(trust),
        F.coalesce(distrust, F.lit(0.0)).alias(distrust),
    )
