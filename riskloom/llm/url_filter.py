"""URL filters: longest matching rule, and trust and distrust carried over the link graph of hosts.

Hosts most of whose pages a rule allows are trusted seeds, hosts most of whose pages a rule blocks
are distrusted ones. Trust follows links forwards (personalised PageRank from the trusted seeds),
distrust follows them backwards (a host that links to distrusted ones earns distrust). Every seed
starts with a mass of one, so a rank counts seeds, near ones more than far ones, and doesn't depend
on how many seeds there are elsewhere. A page that no rule fits is blocked if its host's distrust is
above its trust. Mass that reaches a host without links ends there; handing it back to the seeds
would multiply all ranks of a walk by one number. All of it runs as DataFrame operations; edges are
summed to one row per pair of hosts before anything is joined.

A null url, or one without "://", has an empty host and path; no rule fits it and it is allowed.
Null html has no links. Repeated rows repeat in the result; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.storage import hot_keys, join_apart, settle, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Absolute and scheme-relative links.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^\s"'<>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules that the query is asked to apply.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """The name and verdict of the longest rule that fits, else nulls."""
    name = verdict = None
    for r in sorted(rules, key=lambda r: len(r.name), reverse=True):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, r.name) if name is None else name.when(fits, r.name)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    return name, verdict


def host_edges(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """src, dst, weight: links between different hosts, summed before and after the shuffle."""
    links = pages.where((F.col(host) != "") & F.col(html).contains("//")).select(F.col(host).alias("src"), F.explode(F.regexp_extract_all(html, F.lit(LINK), 1)).alias("link"))
    link = F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), "link")).otherwise(F.col("link"))
    ends = links.select("src", host_of(link).alias("dst")).where((F.col("dst") != "") & (F.col("dst") != F.col("src")))
    return ends.groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int = 12, settle_every: int = 4) -> DataFrame:
    """Personalised PageRank of `edges` (src, dst, weight) from `seeds` (host, seed: the mass it starts with): host, rank."""
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    shares = settle(edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("share")), "host-shares")
    rank = seeds.select("host", F.col("seed").alias("rank"))
    for i in range(rounds):
        moved = shares.join(rank, shares.src == rank.host).groupBy(F.col("dst").alias("host")).agg((damping * F.sum(F.col("share") * F.col("rank"))).alias("rank"))
        kept = seeds.select("host", ((1 - damping) * F.col("seed")).alias("rank"))
        rank = moved.unionByName(kept).groupBy("host").agg(F.sum("rank").alias("rank"))
        if (i + 1) % settle_every == 0:
            rank = settle(rank, "host-rank")
    return rank


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "page_id", url: str = "url", html: str = "html", damping: float = 0.85, rounds: int = 12) -> DataFrame:
    """key, host, path, rule, verdict for every row of `pages`."""
    given = pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), F.col(html).alias("html"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    ruled = given.withColumns({"rule": rule, "ruled": verdict})
    hosts = ruled.where(F.col("host") != "").groupBy("host").agg(F.count("*").alias("n"), F.count_if(F.col("ruled") == "allow").alias("allowed"), F.count_if(F.col("ruled") == "block").alias("blocked"))
    seeds = settle(hosts.select("host", (2 * F.col("allowed") > F.col("n")).alias("good"), (2 * F.col("blocked") > F.col("n")).alias("bad"), "n"), "host-seeds")
    edges = settle(host_edges(ruled), "host-edges")
    trust, distrust = (seeds.where(side).select("host", F.lit(1.0).alias("seed")) for side in ("good", "bad"))
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    linked = not edges.isEmpty()
    ranks = [propagate(e, s, damping, rounds) if linked else s.select("host", F.col("seed").alias("rank")) for e, s in ((edges, trust), (back, distrust))]
    judged = ranks[0].select("host", F.col("rank").alias("trust")).join(ranks[1].select("host", F.col("rank").alias("distrust")), "host", "full_outer")
    judged = settle(judged.where(F.coalesce("distrust", F.lit(0.0)) > F.coalesce("trust", F.lit(0.0))).select("host", F.lit("block").alias("judged")), "host-verdicts")
    # a host may have very many pages
    named = ruled.drop("html")
    hot = settle(hot_keys(named, "host", seeds.agg(F.sum("n")).first()[0] or 0), "hot-hosts")
    found = join_apart(named, judged, "host", hot, "left")
    return found.select(F.col("key").alias(key), "host", "path", "rule", F.coalesce("ruled", "judged", F.lit("allow")).alias("verdict"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))
