"""URL verdicts: host and path rules, and link-graph propagation for the pages no rule fits.

Native DataFrame work only.  A host's *trust seed* is the share of its pages that rules allow, its *distrust
seed* the share that rules block.  Trust is personalised PageRank from the first over links from host to
host; distrust is personalised PageRank from the second over the same links reversed, since a host is
suspect for whom it links to.  Without the factor (1 - damping), which is the same for all hosts, both
start at the seed itself, so that a host without links keeps its own share.  Rounds go on until no rank
changes by more than ``TOLERANCE``; a round passes on at most ``DAMPING`` of all rank that moved before, so they end.
A host is blocked if its distrust reaches ``threshold`` and is above its trust.

Every page gives one row.  A null url, or one without ``://``, has empty host and path, fits no rule and
takes the verdict of the empty host.  Repeated pages count each.  Null html has no links; links to the
page's own host are no edges.  Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""
DAMPING, THRESHOLD = 0.85, 0.5
#: Ranks are settled once no host's rank changed by more than this between two cuts.
TOLERANCE = 1e-6
#: Rounds between two tables that cut the lineage.
CUT_EVERY = 5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased; path: from there up to ``?``, ``#`` or the end."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def link_host(link: Column) -> Column:
    """The host an absolute link leads to; null for a link inside its own host."""
    whole = F.when(F.startswith(link, F.lit("//")), F.concat(F.lit("x:"), link)).otherwise(link)
    return F.when(F.instr(whole, "://") > 0, host_and_path(whole)[0])


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, links``: how many links lead from a host to another."""
    links = F.regexp_extract_all(F.coalesce(pages["html"].cast("string"), F.lit("")), F.lit(LINK), F.lit(1))
    rows = pages.select(host_and_path(pages["url"])[0].alias("src"), links.alias("links")).where(F.size("links") > 0)
    pairs = rows.select("src", F.explode("links").alias("link")).select("src", link_host(F.col("link")).alias("dst"))
    return pairs.where("dst <> '' and src <> '' and dst <> src").groupBy("src", "dst").agg(F.count("*").alias("links"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """``host, trust, distrust`` from seeds (host, trust, distrust) and edges (src, dst, links)."""
    names = F.col("host")
    start = seeds.select(names, F.explode(F.create_map(F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust"))).alias("kind", "seed")).where("seed > 0")
    start = materialise(start, "url-seeds")
    steps = edges.select(F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "links"),
        F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "links"),
    )).alias("e")).select("e.*")
    out = steps.groupBy("kind", "host").agg(F.sum("links").alias("all_links"))
    steps = materialise(steps.join(out, ["kind", "host"]).select("kind", "host", "to", (F.col("links") / F.col("all_links")).alias("share")), "url-steps")
    rank = start.withColumnRenamed("seed", "rank")
    settled = steps.isEmpty()  # without links the seeds are the ranks already
    while not settled:
        before = rank
        for _ in range(CUT_EVERY):
            moved = rank.join(steps, ["kind", "host"]).select("kind", F.col("to").alias("host"), (F.lit(damping) * F.col("rank") * F.col("share")).alias("rank"))
            rank = start.withColumnRenamed("seed", "rank").unionByName(moved).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        rank = materialise(rank, "url-rank")
        both = rank.unionByName(before.withColumn("rank", -F.col("rank"))).groupBy("kind", "host").agg(F.abs(F.sum("rank")).alias("change"))
        largest = both.agg(F.max("change").alias("m")).first()["m"]
        settled = largest is None or largest <= tolerance
    return rank.groupBy("host").agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("rank"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")])


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, host_rules``: the rules that fit a host or a domain above it, longest first."""
    labels = F.split("host", "\\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = hosts.select("host", F.explode(above).alias("rule_host")).join(rules, "rule_host")
    packed = F.struct((-F.length("rule")).alias("order"), "rule", "rule_path", "action")
    return fits.groupBy("host").agg(F.sort_array(F.collect_list(packed)).alias("host_rules"))


def parse_rules(spark, allow: list[str], block: list[str]) -> DataFrame:
    """Rules like ``example.com/en/`` as rows; their number is a parameter of the caller."""
    rows = [(r.partition("/")[0].lower(), "/" + r.partition("/")[2], r, a) for a, rules in (("allow", allow), ("block", block)) for r in rules]
    return spark.createDataFrame(rows, "rule_host string, rule_path string, rule string, action string")


def judge_pages(pages: DataFrame, allow: list[str], block: list[str], threshold: float = THRESHOLD, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` of every row of ``pages`` (page_id, url, html).

    ``default`` is the verdict of a host that propagation gives no reason to block.
    """
    host, path = host_and_path(pages["url"])
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rules = host_rules(rows.select("host").distinct(), parse_rules(pages.sparkSession, allow, block))
    rules = materialise(rules, "url-rules")  # of known size: if small, pages needn't move to their host's task
    first = F.try_element_at(F.filter("host_rules", lambda r: F.startswith(F.col("path"), r["rule_path"])), F.lit(1))
    ruled = rows.join(rules, "host", "left").withColumn("hit", first).drop("host_rules")
    share = lambda action: F.avg(F.when(F.col("hit.action") == action, 1.0).otherwise(0.0))
    seeds = ruled.groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    ranks = materialise(propagate(seeds, host_edges(pages)), "url-ranks")
    rank = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    by_method = F.when((rank("distrust") >= threshold) & (rank("distrust") > rank("trust")), "block").otherwise(default)
    return ruled.join(ranks, "host", "left").select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.action", by_method).alias("verdict"),
        rank("trust").alias("trust"), rank("distrust").alias("distrust"),
    )
