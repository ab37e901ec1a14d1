r"""URL filters: host and path rules, and link-graph propagation of trust and distrust for the pages that no rule fits.

A rule is (verdict, host, path): it fits a url on its host or any subdomain whose path starts with the rule's. The longest
rule (``host + path``) wins; of equal ones the one that sorts first, and block before allow.

The method: links of all pages make weighted host edges. Personalised PageRank spreads trust from the hosts of allowed pages
along the links, and distrust from the hosts of blocked pages against them (who links to bad hosts is suspect). Seeds are
page counts, so both masses compare; a seed without links keeps its own mass, and mass that reaches any other host without links
ends there. Rounds go on until no host's mass changes by more than ``tolerance`` of itself, looked at
every four rounds, and end at the latest when less than ``tolerance`` of each seed's mass is still moving, after
log(tolerance) / log(damping) rounds: 88 with the values here, so evidence travels up to 88 links. A host is blocked where
distrust makes up more than ``threshold`` of the two. All of it
is joins and aggregations of host tables that Spark broadcasts only where they are small; DataFrame functions only.

Defined results: a null url or one without ``://`` has an empty host and path, fits no rule and is allowed. A host without
evidence is allowed. Repeated pages count and are reported once for each row. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import cut

# The rules of the query.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
DAMPING = 0.85
ROUNDS = 8
THRESHOLD = 0.5
TOLERANCE = 1e-6
#: More rules than this are joined by host suffix instead of being written into one expression.
MAX_INLINE_RULES = 200
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _ranked(rules: list[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    return sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0] != "block"))


def with_rules(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` (null where none fits) to a table with ``host`` and ``path``."""
    if len(rules) <= MAX_INLINE_RULES:
        ranked = [(v, h + p, ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)) for v, h, p in _ranked(rules)]
        pick = lambda i: reduce(lambda e, r: F.when(r[2], F.lit(r[i])).otherwise(e), reversed(ranked), F.lit(None).cast("string"))
        return urls.withColumn("rule", pick(1)).withColumn("rule_verdict", pick(0))
    spark = urls.sparkSession
    table = spark.createDataFrame([(v, h, p, i) for i, (v, h, p) in enumerate(_ranked(rules))], "_verdict string, _host string, _path string, _rank int")
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    distinct = urls.select("host", "path").distinct()
    fits = distinct.withColumn("_host", F.explode(suffixes)).join(table, "_host").filter(F.col("path").startswith(F.col("_path")))
    best = fits.groupBy("host", "path").agg(F.min_by(F.struct(F.concat("_host", "_path").alias("rule"), F.col("_verdict").alias("rule_verdict")), "_rank").alias("_best"))
    return urls.join(best, ["host", "path"], "left").select(*urls.columns, "_best.rule", "_best.rule_verdict")


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): links between hosts, counted; a link without a host stays on its page's own."""
    own = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all("html", F.lit(r"(?i)href\s*=\s*[\"']?([^\"'\s>]+)"), 1)).alias("to"))
    to = F.when(F.col("to").startswith("//"), F.concat(F.lit("x:"), F.col("to"))).otherwise(F.col("to"))
    return own.filter("src <> ''").select("src", F.when(to.contains("://"), host_of(to)).otherwise(F.col("src")).alias("dst")).filter("dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("weight"))


def page_rank(links: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING, tolerance: float | None = None) -> DataFrame:
    """(kind, host, mass): PageRank of each kind, personalised on seeds (kind, host, seed), over links (kind, src, dst,
    weight). A seed without links keeps its mass. With a tolerance the rounds go on until the masses settle."""
    if tolerance is not None:
        rounds = 4 * math.ceil(math.log(tolerance) / math.log(damping) / 4)
    ends = seeds.join(links.select("kind", F.col("src").alias("host")).distinct(), ["kind", "host"], "left_anti")
    whole = links.unionByName(ends.select("kind", F.col("host").alias("src"), F.col("host").alias("dst"), F.lit(1).cast("long").alias("weight")))
    out = whole.groupBy("kind", "src").agg(F.sum("weight").alias("_all"))
    share = cut(whole.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (damping * F.col("weight") / F.col("_all")).alias("share")))
    kept = seeds.select("kind", "host", ((1 - damping) * F.col("seed")).alias("mass"))
    mass = before = seeds.select("kind", "host", F.col("seed").cast("double").alias("mass"))
    for i in range(rounds):
        moved = mass.join(share, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (F.col("mass") * F.col("share")).alias("mass"))
        mass = moved.unionByName(kept).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        if i % 4 == 3:
            mass = cut(mass)
            if tolerance is not None:
                both = mass.join(before.withColumnRenamed("mass", "was"), ["kind", "host"], "left")
                if both.filter(F.abs(F.col("mass") - F.coalesce("was", F.lit(0.0))) > tolerance * F.col("mass")).isEmpty():
                    break
                before = mass
    return mass


def judge_pages(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust and distrust of its host."""
    placed = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = with_rules(placed, rules)
    links = cut(host_links(pages))
    evidence = ruled.filter("host <> '' and rule_verdict is not null")
    seeds = cut(evidence.groupBy(F.when(F.col("rule_verdict") == "allow", "trust").otherwise("distrust").alias("kind"), "host").agg(F.count("*").alias("seed")))
    both = links.select(F.lit("trust").alias("kind"), "*").unionByName(links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    mass = page_rank(both, seeds, tolerance=TOLERANCE)
    scores = mass.groupBy("host").agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("mass"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")])
    bad = F.coalesce(F.col("distrust") > threshold * (F.col("trust") + F.col("distrust")), F.lit(False))
    return ruled.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")
