"""URL rules, and a verdict for all other pages from trust and distrust along the links of hosts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbitlake.llm.tables import drop_path, staged
from orbitlake.session import literal_table, scratch_path

#: (host, start of the path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
DAMPING = 0.85
#: Rounds of the SQL counterpart, which has no loop; the operator goes on until ranks settle.
ROUNDS = 10
#: Ranks have settled when a round adds no more than this share to any of them.
TOLERANCE = 1e-12
#: A host is blocked when its distrust is above so many times its trust.
RATIO = 2.0

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"(?is)\bhref\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s<>]+)"


def url_part(url: Column, group: int) -> Column:
    """The host (1, lower-cased) or the path (2) of a URL; empty without ``://``."""
    part = F.coalesce(F.regexp_extract(url, URL, group), F.lit(""))
    return F.translate(part, UPPER, LOWER) if group == 1 else part


def host_rules(hosts: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(host, rules): the rules of a host and of the domains above it, for hosts that have any."""
    listed = literal_table(hosts.sparkSession, list(rules), "rule_host string, path string, verdict string")
    listed = listed.groupBy("rule_host").agg(
        F.collect_list(F.struct("rule_host", "path", "verdict")).alias("own")
    )
    labels = F.split("host", r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )
    named = hosts.select("host", F.explode(above).alias("rule_host"))
    return (
        named.join(listed, "rule_host")
        .groupBy("host")
        .agg(F.flatten(F.collect_list("own")).alias("rules"))
    )


def judged_pages(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, ruled): the longest rule that fits a page, null without one."""
    parts = pages.select(
        "page_id", url_part(F.col("url"), 1).alias("host"), url_part(F.col("url"), 2).alias("path")
    )
    # A table of its own, so that the join can split the pages of a host that has most of them.
    hosts = staged(host_rules(parts.select("host").distinct(), rules), "hostrules")
    joined = parts.join(hosts, "host", "left")
    fits = F.filter("rules", lambda r: F.col("path").startswith(r["path"]))
    ranked = F.transform(
        fits,
        lambda r: F.struct(
            (F.length(r["rule_host"]) + F.length(r["path"])).alias("size"),
            F.concat(r["rule_host"], r["path"]).alias("rule"),
            r["verdict"].alias("verdict"),
        ),
    )
    best = joined.withColumn("best", F.array_max(ranked))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("ruled"))


def host_links(pages: DataFrame) -> DataFrame:
    """(source, target, n): links between different hosts, counted."""
    found = pages.select(
        url_part(F.col("url"), 1).alias("source"),
        F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("target"),
    )
    found = found.select("source", F.translate("target", UPPER, LOWER).alias("target"))
    found = found.where((F.col("source") != "") & (F.col("source") != F.col("target")))
    return found.groupBy("source", "target").agg(F.count("*").alias("n"))


def propagate(
    seeds: DataFrame, links: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE
) -> DataFrame:
    """(host, kind, rank): personalised PageRank of each kind of seed over its own links.

    ``seeds`` holds (host, kind, seed), ``links`` (kind, source, target, share). Each round moves on
    what the round before added, by a join and a sum over hosts, and is written to the shared
    folder. Rounds end when none adds more than ``tolerance`` times a rank: a host that is reached
    for the first time always asks for another, so a chain of links is followed to its end, and
    cycles take about 170 rounds at 1e-12.
    """
    spark = seeds.sparkSession
    given = (F.col("seed") * (1 - damping)).alias("rank")
    ranks, path = staged(seeds.select("host", "kind", given).withColumn("added", F.col("rank")), "ranks"), None
    while True:
        front = ranks.where("added > 0").select("host", F.col("kind").alias("_kind"), "added")
        moved = front.join(links, (front["host"] == links["source"]) & (front["_kind"] == links["kind"])).select(
            links["target"].alias("host"), links["kind"], (F.col("added") * F.col("share") * damping).alias("rank")
        )
        after = ranks.select("host", "kind", "rank", F.lit(0.0).alias("added"))
        after = after.union(moved.withColumn("added", F.col("rank")))
        after = after.groupBy("host", "kind").agg(F.sum("rank").alias("rank"), F.sum("added").alias("added"))
        written = scratch_path(spark, "ranks")
        after.write.parquet(written)
        ranks = spark.read.schema(ranks.schema).parquet(written)
        if path:
            drop_path(spark, path)
        path = written
        if ranks.where(F.col("added") > F.col("rank") * tolerance).isEmpty():
            return ranks.select("host", "kind", "rank")


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page.

    A page without a rule gets its host's verdict. Pages that a rule allows make their host a seed
    of trust, pages that one blocks a seed of distrust, by their number. Trust follows the links,
    distrust goes back along them: who links to a blocked host shares its distrust. A host is
    blocked when its distrust is above twice its trust; hosts that neither reaches are allowed.
    Null urls, and urls without ``://``, have an empty host. Repeated rows are judged alike.
    """
    judged = staged(judged_pages(pages, rules), "judged")
    kinds = F.when(F.col("ruled") == "allow", "trust").otherwise("distrust")
    marks = judged.where("ruled is not null").groupBy("host", kinds.alias("kind")).agg(F.count("*").alias("n"))
    marks = staged(marks, "marks")
    total = marks.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = marks.join(total, "kind").select("host", "kind", (F.col("n") / F.col("total")).alias("seed"))
    seeds = staged(seeds, "seeds")

    edges = staged(host_links(pages), "links")
    forth = edges.select(F.lit("trust").alias("kind"), "source", "target", "n")
    back = edges.select(
        F.lit("distrust").alias("kind"), F.col("target").alias("source"), F.col("source").alias("target"), "n"
    )
    both = forth.union(back)
    out = both.groupBy("kind", "source").agg(F.sum("n").alias("total"))
    links = both.join(out, ["kind", "source"]).select(
        "kind", "source", "target", (F.col("n") / F.col("total")).alias("share")
    )
    ranks = propagate(seeds, staged(links, "shares"))

    def rank(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(0.0))

    hosts = ranks.groupBy("host").agg((rank("distrust") > rank("trust") * RATIO).alias("bad"))
    hosts = staged(hosts, "hosts")
    verdict = F.when(F.col("ruled").isNotNull(), F.col("ruled")).when(F.col("bad"), "block").otherwise("allow")
    return judged.join(hosts, "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
