"""URL filters: rules first, then trust and distrust over the links between hosts.

A page that a rule fits gets the longest rule's verdict. For the others two scores run
over the graph of hosts: a personalised PageRank that starts from the hosts of allowed
pages and follows links, and one that starts from the hosts of blocked pages and follows
links backwards (who links to a bad host is itself suspect). A host whose distrust
exceeds its trust by the threshold's factor is blocked; all others are allowed.

Defined cases: a NULL url or one without ``://`` has an empty host and path, no rule and
no links, and is allowed; NULL html has no links; a link of a host to itself is no edge;
repeated pages count repeatedly; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchtide.llm.common import cut, discard

#: (host, path, verdict), as the filter's owner gives them.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
_ABSOLUTE = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(_ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rule(pages: DataFrame, rules=RULES) -> DataFrame:
    """Add rule and verdict of the longest rule that fits ``host`` and ``path`` (else NULL)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):  # the longest stands outermost
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name, verdict = F.when(fits, host + path).otherwise(name), F.when(fits, says).otherwise(verdict)
    return pages.withColumn("rule", name).withColumn("verdict", verdict)


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, n: links from pages of one host to another host."""
    links = pages.select(F.col("host").alias("src"),
                         F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_ABSOLUTE), 1)).alias("_url"))
    # a link may leave the scheme to the page
    whole = F.when(F.col("_url").startswith("//"), F.concat(F.lit("x:"), "_url")).otherwise(F.col("_url"))
    return (links.select("src", host_of(whole).alias("dst"))
            .where("src <> '' AND dst <> '' AND src <> dst")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float, tolerance: float) -> DataFrame:
    """Personalised PageRank over src -> dst (weight n) from seeds (host, mass): host, score.

    Rounds end when all scores together change by less than ``tolerance``. Each round
    changes them by at most ``damping`` times the round before, so that comes after about
    log(tolerance) / log(damping) rounds at the latest, however long the ways between hosts are.
    Mass of hosts without links out goes back to the seeds by leaving it out: only
    comparisons of scores from equally treated graphs are used.
    """
    total = seeds.agg(F.sum("mass")).first()[0] or 1.0
    start = seeds.select("host", (F.col("mass") / total).alias("start"))
    out = edges.groupBy("src").agg(F.sum("n").alias("out"))
    steps = cut(edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("out")).alias("share")), "trust-steps")
    score = start.select("host", F.col("start").alias("score"))
    kept = None
    while True:
        moved = (steps.join(score, steps["src"] == score["host"])
                 .groupBy("dst").agg((F.sum(F.col("share") * F.col("score")) * damping).alias("score"))
                 .select(F.col("dst").alias("host"), "score"))
        jump = start.select("host", (F.col("start") * (1 - damping)).alias("score"))
        new = cut(moved.unionByName(jump).groupBy("host").agg(F.sum("score").alias("score")), "trust-score")
        old = score.select(F.col("host").alias("_old"), F.col("score").alias("_was"))
        both = new.join(old, F.col("host") == F.col("_old"), "full")
        change = both.agg(F.sum(F.abs(F.coalesce("score", F.lit(0.0)) - F.coalesce("_was", F.lit(0.0))))).first()[0] or 0.0
        if kept is not None:
            discard(edges.sparkSession, kept)
        score = kept = new
        if change < tolerance:
            return score


def host_verdicts(judged: DataFrame, edges: DataFrame, damping: float = 0.85, tolerance: float = 1e-6,
                  factor: float = 1.0) -> DataFrame:
    """host, trust, distrust, host_verdict for every host of ``judged`` (host, verdict) and of the links."""
    per_host = judged.where("host <> ''").groupBy("host").agg(
        F.sum((F.col("verdict") == "allow").cast("double")).alias("good"),
        F.sum((F.col("verdict") == "block").cast("double")).alias("bad"))
    per_host = cut(per_host.na.fill(0.0, ["good", "bad"]), "trust-hosts")
    good = per_host.where("good > 0").select("host", F.col("good").alias("mass"))
    bad = per_host.where("bad > 0").select("host", F.col("bad").alias("mass"))
    trust = propagate(edges, good, damping, tolerance).withColumnRenamed("score", "trust")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = propagate(back, bad, damping, tolerance).withColumnRenamed("score", "distrust")
    both = trust.join(distrust, "host", "full").na.fill(0.0, ["trust", "distrust"])
    blocked = F.round(F.col("distrust") - F.col("trust") * factor, 12) > 0  # the order of sums must not decide
    return both.select("host", "trust", "distrust", F.when(blocked, "block").otherwise("allow").alias("host_verdict"))


def op9_filter(pages: DataFrame, rules=RULES, **options) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every page."""
    urls = pages.select("page_id", "html", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = with_rule(urls.drop("html"), rules)
    edges = cut(host_edges(urls), "trust-edges")
    hosts = cut(host_verdicts(judged.select("host", "verdict"), edges, **options), "trust-verdicts")
    # A host may have a third of all pages: adaptive execution splits its side of this join.
    hosts = hosts.withColumnRenamed("host", "_host")
    return (judged.join(hosts, F.col("host") == F.col("_host"), "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("verdict", "host_verdict", F.lit("allow")).alias("verdict"),
                    F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")))
