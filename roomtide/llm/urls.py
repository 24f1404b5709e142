"""URL filters: host and path rules, and link-graph propagation where no rule fits.

Trust and distrust spread over host edges by personalised PageRank, wholly in DataFrame operations.
Trusted seeds are the hosts with pages that an allow rule fits, weighted by their number of pages;
trust follows links. Blocked seeds are the hosts with pages that a block rule fits; distrust runs
against the links, so that who links to blocked hosts becomes suspect. Both are ranked in the same rounds. A host is blocked where its
distrust exceeds `threshold` times its trust; a host that neither reaches is allowed. Rounds go on until every
host within reach has rank and the ranks have settled.

Edges: absolute links in the html (href and src, the scheme may be missing before //), and for every host an
edge to and from each domain above it (of two labels or more), as one owner stands behind both, with or
without pages on the domains between. An edge weighs the number of its links, a domain edge 1. Self-links are left out. Rank without out-links returns to the seeds.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path: from there up to
`?`, `#` or the end. Null urls, and urls without `://`, have an empty host and path; they fit no rule
and are allowed. Null html has no links. Repeated rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import remove, settle, shared_dir, stage
from .common import LOWER, UPPER

DAMPING, THRESHOLD = 0.85, 1.0
#: The ranks are compared every STRIDE rounds, and settled when they differ by no more than TOLERANCE in sum.
STRIDE, TOLERANCE = 8, 1e-6
#: Edges of a piece of the graph.
ROWS_EACH = 200_000
LINK = r"""(?i)(?:href|src)\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...], verdict: bool) -> Column:
    """The longest rule that fits, or its verdict; null where none does."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.lit(r.verdict if verdict else r.text)).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) of pages with host and html."""
    links = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("url"))
    full = F.when(F.startswith("url", F.lit("//")), F.concat(F.lit("http:"), "url")).otherwise(F.col("url"))
    links = links.select("src", host_of(full).alias("dst")).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))
    hosts = pages.select("host").union(links.select("dst")).distinct()
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(2), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    family = hosts.where(F.size(labels) > 2).select(F.col("host").alias("src"), F.explode(above).alias("dst"))
    family = family.where(F.col("src").rlike(r"^[^.]") & F.col("dst").rlike(r"^[^.]+\..+"))
    family = family.unionByName(family.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    every = links.unionByName(family.withColumn("weight", F.lit(1).cast("long")))
    return every.where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def _pieces(n: int) -> int:
    return max(1, math.ceil(n / ROWS_EACH))


def personalised_rank(edges: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """(host, kind, rank) for several kinds of rank at once, each summing to 1, settled to `tolerance`.

    edges (src, dst, kind, share) with shares of each src and kind summing to 1, seeds (host, kind, seed) summing to 1 in each
    kind. Rank that is not passed on (no out-links) is given back to the seeds by dividing by the total, as
    PageRank with teleport to the seeds does up to scale. A round is one join and one aggregation of all kinds;
    the tables are cut into pieces that follow their rows, so that a small graph does not make many small files in each round.
    """
    spark = edges.sparkSession
    n_edges = edges.count()
    rank = seeds.select("host", "kind", F.col("seed").alias("rank"))
    back = seeds.select("host", "kind", (F.col("seed") * (1 - damping)).alias("rank"))
    last: str | None = None
    while True:
        before = rank.select("host", "kind", F.col("rank").alias("old"))
        for _ in range(STRIDE):
            known = rank.select(F.col("host").alias("src"), "kind", "rank")
            moved = edges.join(known, ["src", "kind"]).select(F.col("dst").alias("host"), "kind", (F.col("rank") * F.col("share") * damping).alias("rank"))
            rank = moved.unionByName(back).groupBy("host", "kind").agg(F.sum("rank").alias("rank")).coalesce(_pieces(n_edges))
        path = f"{shared_dir(spark)}/rank-{uuid.uuid4().hex}"
        rank.write.parquet(path)
        rank = spark.read.schema(rank.schema).parquet(path)
        # a host once reached stays so: the seeds send rank on in every round
        change = F.sum(F.abs(F.col("rank") - F.coalesce("old", F.lit(0.0))))
        moved_by, reached = rank.join(before, ["host", "kind"], "left").agg(change, F.count_if(F.col("old").isNull())).first()
        if last:
            remove(spark, last)
        last = path
        if not reached and (moved_by or 0.0) <= tolerance:
            break
    totals = rank.groupBy("kind").agg(F.sum("rank").alias("total"))
    out = stage(rank.join(totals, "kind").select("host", "kind", (F.col("rank") / F.col("total")).alias("rank")).coalesce(_pieces(n_edges)), "ranks")
    remove(spark, last)
    return out


def _shares(edges: DataFrame) -> DataFrame:
    """Edges along the links (trust) and against them (distrust), with their share of all that leaves a host."""
    along = edges.select("src", "dst", F.lit("allow").alias("kind"), "weight")
    against = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit("block").alias("kind"), "weight")
    both = along.unionByName(against)
    out = both.groupBy("src", "kind").agg(F.sum("weight").alias("out"))
    return both.join(out, ["src", "kind"]).select("src", "dst", "kind", (F.col("weight") / F.col("out")).alias("share"))


def host_ranks(page: DataFrame, tolerance: float, damping: float) -> DataFrame:
    """(host, trust, distrust) from pages with host, html and the verdict of the rules."""
    edges = stage(host_edges(page.select("host", "html")), "host-edges")
    n_edges = edges.count()
    shares = stage(_shares(edges).coalesce(2 * _pieces(n_edges)), "shares")
    seeds = page.where("by_rule is not null").groupBy("host", F.col("by_rule").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    seeds = stage(seeds.coalesce(_pieces(n_edges)), "url-seeds")
    whole = seeds.groupBy("kind").agg(F.sum("n").alias("whole"))
    seeds = stage(seeds.join(whole, "kind").select("host", "kind", (F.col("n") / F.col("whole")).alias("seed")).coalesce(_pieces(n_edges)), "url-seeds")
    rank = personalised_rank(shares, seeds, tolerance, damping)
    of = lambda kind, name: F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)).alias(name)
    return rank.groupBy("host").agg(of("allow", "trust"), of("block", "distrust"))


def judge_urls(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, tolerance: float = TOLERANCE, damping: float = DAMPING, threshold: float = THRESHOLD
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every page."""
    url, html = F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit(""))
    page = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), html.alias("html"))
    host, path = F.col("host"), F.col("path")
    page = page.withColumn("rule", rule_of(host, path, rules, False)).withColumn("by_rule", rule_of(host, path, rules, True))
    ranks = settle(pages.sparkSession, "url-ranks", lambda: host_ranks(page, tolerance, damping))
    judged = page.drop("html").join(ranks, "host", "left").fillna(0.0, ["trust", "distrust"])
    method = F.when(F.col("distrust") > threshold * F.col("trust"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), "trust", "distrust")
