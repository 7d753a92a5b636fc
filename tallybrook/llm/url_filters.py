"""URL filters: rules on hosts and paths, and trust that spreads over links between hosts (operator 8).

A rule (host, path) fits its host and all subdomains where the url's path starts with the rule's; the longest rule
wins. Other pages get their host's verdict. A host is a seed of trust by the share of its pages that a rule allows, and
one of distrust by the share that a rule blocks. Personalised PageRank spreads trust along links and distrust against
them, over as many links as there are; a host is blocked where distrust outweighs trust by `ratio`, however small both
are (ranks below the smallest double are 0, some 4,000 links from a seed). Both are sums over walks that start with a
host's share, not scaled by how many seeds there are, so pages that no walk joins to a host don't change its verdict.
Links are those of href and src attributes with a host of their own, counted per pair of hosts before anything is
shuffled.

Defined results: a null url or one without `://` has an empty host and path, no rule and the verdict allow; null html
has no links; very long html is searched whole; of equally long rules that fit, the one that sorts first wins; where
trust equals distrust, a host is allowed; repeated rows each give a row and count as pages; an empty table gives an
empty result; further columns don't matter, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import drop_table, write_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<>\s]+)"""

Rule = tuple[str, str, str]  # host, path, verdict


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    fits = lambda h, p: ((host == h) | host.endswith("." + h)) & path.startswith(p)
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    return reduce(lambda rest, r: F.when(fits(r[0], r[1]), F.struct(F.lit(r[0] + r[1]).alias("rule"), F.lit(r[2]).alias("verdict"))).otherwise(rest), reversed(ordered), F.lit(None).cast("struct<rule:string,verdict:string>"))


def links(pages: DataFrame) -> DataFrame:
    """src, dst, share of src's links; links within a host don't count. pages: host, html."""
    found = pages.where("host != '' and html is not null").select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("dst"))
    pairs = found.select("src", F.translate("dst", UPPER, LOWER).alias("dst")).where("src != dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    return pairs


def walks(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """seeds(host, seed), edges(src, dst, n) -> host, rank: the sum over all walks from the seeds of what arrives, where
    each link passes on its share of `damping`. Each round adds the walks that are a link longer, until they add less than
    `tolerance` of its rank to every host."""
    edges = edges.join(edges.groupBy("src").agg(F.sum("n").alias("total")), "src").select("src", "dst", (F.col("n") / F.col("total")).alias("share"))
    edges = write_table(edges, "links")
    ranks = write_table(seeds.select("host", F.col("seed").alias("rank"), F.col("seed").alias("added")), "ranks")
    while not edges.isEmpty() and not ranks.where(F.col("added") > tolerance * F.col("rank")).isEmpty():
        moved = edges.join(ranks.where("added > 0"), edges.src == ranks.host).select(F.col("dst").alias("host"), (damping * F.col("share") * F.col("added")).alias("added"))
        both = ranks.select("host", "rank", F.lit(0.0).alias("added")).unionByName(moved.select("host", F.col("added").alias("rank"), "added"))
        longer = write_table(both.groupBy("host").agg(F.sum("rank").alias("rank"), F.sum("added").alias("added")), "ranks")
        drop_table(ranks)
        ranks = longer
    drop_table(edges)
    return ranks.select("host", "rank")


def spread(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """Personalised PageRank: seeds(host, seed) summing to 1, edges(src, dst, n) -> host, rank. What hosts without
    links hold goes back to the seeds: the ranks are the sum over all walks from the seeds, scaled to 1."""
    ranks = walks(seeds, edges, damping, tolerance)
    total = ranks.agg(F.sum("rank")).first()[0] or 1.0
    return ranks.select("host", (F.col("rank") / F.lit(total)).alias("rank"))


def judge(pages: DataFrame, rules: list[Rule], ratio: float = 1.0, url_col: str = "url", html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """page_id, host, path, rule, verdict."""
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"), F.col(html_col).alias("html"))
    judged = rows.withColumn("match", matched_rule(F.col("host"), F.col("path"), rules))
    per_host = judged.groupBy("host").agg(F.count("*").alias("pages"), F.count(F.when(F.col("match.verdict") == "allow", 1)).alias("allow"), F.count(F.when(F.col("match.verdict") == "block", 1)).alias("block")).where("host != ''")
    per_host = write_table(per_host.where("allow > 0 or block > 0"), "seeds")
    seeds = lambda kind: per_host.where(F.col(kind) > 0).select("host", (F.col(kind) / F.col("pages")).alias("seed"))
    edges = write_table(links(rows), "pairs")
    trust = walks(seeds("allow"), edges)
    distrust = walks(seeds("block"), edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    both = trust.select("host", F.col("rank").alias("trust"), F.lit(0.0).alias("distrust")).unionByName(distrust.select("host", F.lit(0.0).alias("trust"), F.col("rank").alias("distrust")))
    hosts = both.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")).where(F.col("distrust") > ratio * F.col("trust")).select("host", F.lit("block").alias("spread"))
    pages_judged = judged.select("page_id", "host", "path", "match").join(hosts, "host", "left")
    return pages_judged.select("page_id", "host", "path", F.col("match.rule").alias("rule"), F.coalesce("match.verdict", "spread", F.lit("allow")).alias("verdict"))
