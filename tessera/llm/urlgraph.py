"""URL filters: rules first, then trust and distrust spread over the link graph of hosts.

Trust is a personalised PageRank from the hosts whose pages a rule allows, along links; distrust is one from the hosts whose
pages a rule blocks, against the links' direction (who links to bad hosts is suspect). A host is blocked if its distrust exceeds
its trust by more than ``threshold``. Both walks run as one table in Spark: links are summed to host pairs before anything moves,
each round is a join and a sum, written to the shared folder. A round moves on what the last one brought, and the walks end when
all that is still to come to all hosts together is under ``TOLERANCE``, so no host is off by more.

Defined results: null url, or one without "://", has empty host and path and no rule, and is allowed; html without links,
or null, adds no edge; pages may repeat; links from a host to itself and relative links stay inside the host and are no edges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import cut, forget

#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING, TOLERANCE, THRESHOLD = 0.85, 1e-4, 0.05


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as text, its verdict) of the longest rule that fits; null if none does."""
    name = verdict = None
    for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, n: links between different hosts, summed."""
    link = F.filter(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"""(?i)href\s*=\s*["']?([^"'\s>]*)"""), F.lit(1)), lambda x: F.instr(x, "//") > 0)
    found = pages.where(F.instr("html", "//") > 0).select(F.col("host").alias("src"), F.explode(link).alias("href"))
    full = F.when(F.col("href").startswith("//"), F.concat(F.lit("http:"), "href")).otherwise(F.col("href"))
    dst = found.select("src", host_and_path(full)[0].alias("dst"))
    return dst.where("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(seeds: DataFrame, edges: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """host, trust, distrust. seeds: host, trust, distrust, each 0 to 1."""
    e = edges.select(F.lit(0).alias("kind"), "src", "dst", "n").union(edges.select(F.lit(1), F.col("dst"), F.col("src"), "n"))
    out = e.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    e = cut(e.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("total")).alias("w")))
    seed = seeds.select(F.lit(0).alias("kind"), "host", F.col("trust").alias("s")).union(seeds.select(F.lit(1), "host", F.col("distrust"))).where("s > 0")
    rank = brought = cut(seed.select("kind", "host", ((1 - damping) * F.col("s")).alias("r")))
    rounds: list[DataFrame] = []
    add = lambda: reduce(DataFrame.union, rounds, rank).groupBy("kind", "host").agg(F.sum("r").alias("r"))
    linked = not e.isEmpty()
    while linked:
        moved = brought.withColumnRenamed("host", "src").join(e, ["kind", "src"]).groupBy("kind", F.col("dst").alias("host")).agg((damping * F.sum(F.col("r") * F.col("w"))).alias("r"))
        last, brought = brought, cut(moved)
        rounds.append(brought)
        # no round brings more than damping times the one before
        if (brought.agg(F.sum("r")).first()[0] or 0.0) * damping / (1 - damping) < tolerance:
            break
        if len(rounds) == 8:
            rank, spent = cut(add()), [rank, *rounds[:-1]]
            rounds = []
            for x in spent:
                forget(x)
        elif len(rounds) == 1 and last is not rank:  # added up the round before
            forget(last)
    rank = add()
    return rank.groupBy("host").agg(F.sum(F.when(F.col("kind") == 0, F.col("r")).otherwise(0.0)).alias("trust"), F.sum(F.when(F.col("kind") == 1, F.col("r")).otherwise(0.0)).alias("distrust"))


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of each row of pages (page_id, url, html)."""
    host, path = host_and_path(F.col("url"))
    p = pages.select("page_id", "html", host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    known = p.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"))
    share = lambda v: F.avg(F.when(F.col("ruled") == v, 1.0).otherwise(0.0))
    seeds = known.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    score = propagate(seeds, host_edges(p)).withColumnRenamed("host", "_h")
    out = known.join(score, F.col("host") == F.col("_h"), "left").na.fill(0.0, ["trust", "distrust"])
    by_graph = F.when(F.col("distrust") - F.col("trust") > threshold, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_graph).alias("verdict"), "trust", "distrust")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
