"""URL filters by trust and distrust on the link graph (DataFrame functions only)."""

from __future__ import annotations

import math
import string
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import Scratch, named, no_null, sheltered

#: (host, path, verdict) of the production rules.
RULES = (
    ("com", "en/", "block"),
    ("example.com", "en/7", "allow"),
    ("net", "de/", "block"),
    ("example.net", "de/8", "block"),
    ("org", "es/", "block"),
)
DAMPING = 0.85
#: Bound on the mass of all hosts together that the rounds left out could still add; far below THRESHOLD.
TOLERANCE = 1e-6
#: Rounds between two writes of the ranks.
_WRITE = 4
#: Rows of ranks that a written file has about.
_RANKS_PER_FILE = 100_000
THRESHOLD = 0.05


def host_of(url: Column) -> Column:
    """From after the first :// to /, ?, # or the end, A-Z lower-cased; empty without :// or for null."""
    return F.translate(F.regexp_extract(no_null(url), r"^(?s:.*?)://([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(no_null(url), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """pages with host, path, rule and by_rule (its verdict); the longest rule that fits wins."""
    out = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, what in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(f"/{path}")
        rule, verdict = F.when(fits, F.lit(f"{host}/{path}")).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return out.withColumn("rule", rule).withColumn("by_rule", verdict)


def parent_of(host: Column) -> Column:
    """The domain above a host; null where that would be a top-level name, and for addresses."""
    up = F.regexp_extract(host, r"^[^.]+\.(.+\..+)$", 1)
    return F.when((up != "") & ~host.rlike(r"^[0-9.]+(:[0-9]*)?$|^\["), up)


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, share: edges between hosts, as a share of those that leave src.

    A page's links to other hosts are edges, and a host and the domain above it
    are linked both ways, as if by one link: pages that link to no other host
    still belong to a domain, and what is known of one part of a domain reaches
    its other parts through it.
    """
    found = F.regexp_extract_all(no_null(F.col("html")), F.lit(r"(?i)\shref\s*=\s*[\"']?(?:https?:)?//([^/?#\"'\s>]+)"), F.lit(1))
    links = pages.select("host", F.explode(found).alias("_to")).select(F.col("host").alias("src"), F.translate("_to", string.ascii_uppercase, string.ascii_lowercase).alias("dst"))
    links = links.where("src <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    hosts = pages.select("host").where("host <> ''").distinct().select("host", parent_of(F.col("host")).alias("up")).where("up is not null")
    above = hosts.select(F.col("host").alias("src"), F.col("up").alias("dst"), F.lit(1).cast("long").alias("n"))
    links = links.unionByName(above).unionByName(above.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")).groupBy("src", "dst").agg(F.sum("n").alias("n"))
    out = links.groupBy(F.col("src").alias("_src")).agg(F.sum("n").alias("_all"))
    return links.join(out, F.col("src") == F.col("_src")).select("src", "dst", (F.col("n") / F.col("_all")).alias("share"))


def _weights(products: np.ndarray) -> np.ndarray | None:
    """Weights, of sum 1, of the gains of some rounds that make their weighted sum shortest, from the gains' scalar products; None if it is not half as long as the last gain at most."""
    step = np.eye(len(products))[:-1] - np.eye(len(products), k=1)[:-1]
    out = np.eye(len(products))[0] - step.T @ np.linalg.pinv(step @ products @ step.T, rcond=1e-13, hermitian=True) @ (step @ products)[:, 0]
    return out if 4 * (out @ products @ out) < products[-1, -1] else None


def propagate(seeds: DataFrame, edges: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank: kind, host, mass, from seeds (kind, host, seed) along edges (kind, src, dst, share); kinds do not mix.

    A round moves what the one before it gained (g0, g1, ...) along the edges,
    damped, so all that is still to come is at most damping / (1 - damping)
    times the last gain, over all hosts. Rounds end when that is within
    tolerance, so no host's mass is further than that from the limit.
    After a few rounds the masses go to the limit as foretold by these rounds
    (a minimal residual step), with a gain computed for them in the same way,
    if that gain is smaller over all hosts than the last one, and else just
    past these rounds: never more rounds than without it, few where domains
    are stars of hosts. Mass that reaches a host without edges ends there.
    Sums of contributions are made before the shuffle; ranks are written out
    every few rounds, so that a lost executor costs few rounds.
    """
    disk = Scratch(seeds.sparkSession, "ranks")
    before = disk.keep(seeds.select("kind", "host", F.lit(0.0).alias("mass"), (F.col("seed") * F.lit(1 - damping)).alias("g0")).where("g0 > 0"))
    total, hosts = before.agg(F.sum("g0"), F.count("*")).first()
    rank, left = before, (total or 0.0) * damping / (1 - damping)
    gains = [f"g{i}" for i in range(_WRITE + 1)]
    if left > tolerance:
        # an edge without share from each host to itself carries its mass and gains to the next round
        ends = edges.select("kind", F.col("src").alias("host")).unionByName(edges.select("kind", F.col("dst").alias("host"))).unionByName(before.select("kind", "host")).distinct()
        stay = ends.select(F.col("kind").alias("_kind"), F.col("host").alias("src"), F.col("host").alias("dst"), F.lit(None).cast("double").alias("_part"))
        links = disk.keep(edges.select(F.col("kind").alias("_kind"), "src", "dst", (F.col("share") * F.lit(damping)).alias("_part")).unionByName(stay))
    while left > tolerance:
        for i in range(_WRITE):
            had, none = ["mass", *gains[: i + 1]], F.col("_part").isNull()
            moved = links.join(rank, (F.col("_kind") == F.col("kind")) & (F.col("src") == F.col("host"))).select("kind", F.col("dst").alias("host"), *[F.when(none, F.col(c)).otherwise(0.0).alias(c) for c in had], F.when(none, 0.0).otherwise(F.col(gains[i]) * F.col("_part")).alias(gains[i + 1]))
            rank = moved.groupBy("kind", "host").agg(*[F.sum(c).alias(c) for c in [*had, gains[i + 1]]])
        seen = Observation()
        pairs = [(i, j) for i in range(_WRITE + 1) for j in range(i + 1)]
        rank = disk.keep(rank.observe(seen, F.sum(F.abs(gains[-1])).alias("last"), F.count("*").alias("hosts"), *[F.sum(F.col(gains[i]) * F.col(gains[j])).alias(f"p{i}_{j}") for i, j in pairs]).coalesce(1 + hosts // _RANKS_PER_FILE))
        disk.drop(before)
        before, last, hosts = rank, seen.get["last"] or 0.0, seen.get["hosts"]
        of = lambda weights: sum((F.col(g) * F.lit(float(w)) for g, w in zip(gains, weights)), F.lit(0.0))
        plain = np.eye(_WRITE + 1)[-1]
        found = _weights(np.array([[seen.get[f"p{max(i, j)}_{min(i, j)}"] or 0.0 for j in range(_WRITE + 1)] for i in range(_WRITE + 1)]))
        foretold = math.inf if found is None else rank.agg(F.sum(F.abs(of(found)))).first()[0]
        weights, last = (found, foretold) if foretold < last else (plain, last)
        rank = rank.select("kind", "host", (F.col("mass") + of(1 - np.cumsum(weights)[:-1])).alias("mass"), of(weights).alias("g0"))
        left = last * damping / (1 - damping)
    return rank.select("kind", "host", F.greatest(F.col("mass") + F.col("g0"), F.lit(0.0)).alias("mass"))


def host_verdicts(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """host, trust, distrust and host_verdict for the hosts of judged pages.

    Seeds are the shares of all of a host's pages that rules allow or block, so
    that without edges a host is blocked from a third of its pages on.
    Trust flows along edges; distrust against them, to the hosts that link to
    blocked ones. A host is blocked when its distrust reaches the threshold
    and exceeds its trust.
    """
    disk = Scratch(pages.sparkSession, "hosts")
    edges = disk.keep(host_edges(pages))
    seeds = disk.keep(pages.where("host <> ''").groupBy("host").agg(F.count_if(F.col("by_rule") == "allow").alias("a"), F.count_if(F.col("by_rule") == "block").alias("b"), F.count("*").alias("_all")))
    seeds = seeds.select("host", F.explode(F.array(F.struct(F.lit("trust").alias("kind"), (F.col("a") / F.col("_all")).alias("seed")), F.struct(F.lit("distrust").alias("kind"), (F.col("b") / F.col("_all")).alias("seed")))).alias("s")).select("s.kind", "host", "s.seed")
    out = edges.groupBy(F.col("dst").alias("_dst")).agg(F.sum("share").alias("_in"))
    back = edges.join(out, F.col("dst") == F.col("_dst")).select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), (F.col("share") / F.col("_in")).alias("share"))
    both = disk.keep(edges.select(F.lit("trust").alias("kind"), "src", "dst", "share").unionByName(back))
    ranks = propagate(seeds, both, math.inf if both.isEmpty() else TOLERANCE)
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0.0)).alias(kind)
    bad = (F.col("distrust") >= F.lit(threshold)) & (F.col("distrust") > F.col("trust"))
    return ranks.groupBy("host").agg(of("trust"), of("distrust")).withColumn("host_verdict", F.when(bad, F.lit("block")).otherwise(F.lit("allow")))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """pages with host, path, rule, trust, distrust and verdict.

    The verdict is the rule's, else the host's. Pages without a host (null or
    no ://) have empty host and path, no rule and verdict allow. Repeated rows
    stay; an empty table stays empty; columns with these names are replaced,
    others may have any names.
    """
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "trust", "distrust", "verdict")]
    return sheltered(pages.select(*named(own)), ("url", "html"), lambda p: _filtered(p, rules))


def _filtered(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    seen = judged(pages, rules)
    hosts = host_verdicts(seen).select(F.col("host").alias("_host"), "trust", "distrust", "host_verdict")
    out = seen.join(hosts, F.col("host") == F.col("_host"), "left").drop("_host").fillna(0.0, ["trust", "distrust"])
    return out.withColumn("verdict", F.coalesce("by_rule", "host_verdict", F.lit("allow"))).drop("by_rule", "host_verdict")


def op4(pages: DataFrame) -> DataFrame:
    """Every page with its verdict; null urls have empty host and path."""
    out = filter_urls(pages.select("page_id", "url", "html"))
    return out.select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")
