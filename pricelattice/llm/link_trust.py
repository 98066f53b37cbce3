"""URL verdicts: rules by host and path, and trust that flows over the links between hosts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelattice.llm.steps import written
from pricelattice.session import broadcast_if_small, cut_lineage

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str  # from its slash on

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first '://' up to '/', '?', '#' or the end, A-Z lowered; empty without '://'."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(found, _CAPITALS, _SMALL)


def path_of(url: Column) -> Column:
    """Behind the host up to '?', '#' or the end; empty without '://'."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Name of the longest rule that fits; null if none does.  Of rules of one length the first by name."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), [-ord(c) for c in r.name])):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(rule.name)).otherwise(found)
    return found


def _targets(html_col: str) -> Column:
    """The href and src values that hold '://' or begin with '//', from '://' up to '?', '#' or the end."""
    found = r"(?i)(?:href|src)\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.-]*:)?(//[^/?#\"'\s<>]+[^?#\"'\s<>]*)"
    return F.transform(F.regexp_extract_all(F.col(html_col), F.lit(found), F.lit(1)), lambda t: F.concat(F.lit(":"), t))


def linked_urls(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Distinct targets of absolute links: (host, path)."""
    found = pages.select(F.explode(F.array_distinct(_targets(html_col))).alias("_url"))
    return found.select(host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path")).distinct()


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Links between hosts with their number of pages: (src, dst, weight).

    A page's links are the hosts in its href and src values that hold '://' or begin with '//';
    relative links stay on the host and say nothing.  A page counts once per host.
    """
    src = host_of(F.col(url_col))
    targets = F.array_distinct(F.transform(_targets(html_col), host_of))
    links = pages.select(src.alias("src"), F.explode(targets).alias("dst")).where("src <> '' and dst <> '' and src <> dst")
    return links.groupBy("src", "dst").agg(F.count("*").alias("weight"))


def propagate(links: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int | None = None, tolerance: float = 1e-6) -> DataFrame:
    """Personalised PageRank: (host, score) from links (src, dst, weight) and seeds (host, share).

    Every round a host hands ``damping`` of its score to its targets by weight, and the seeds get the rest.
    What hosts without targets hold would also go to the seeds; that only scales all scores, so it
    is made good at the end, when they are scaled to a sum of one.  Partial sums are combined before the shuffle,
    so a host that everyone links to is no single task.

    Scores only grow, and each round adds at most ``damping`` times what the last one added.  It ends when five rounds have added no more than
    ``tolerance`` of the sum; then less than that share, damping**5 / (1 - damping**5) of it, has not arrived.  A caller
    who gives ``rounds`` stops after that many at the latest.
    """
    out = links.groupBy("src").agg(F.sum("weight").alias("total"))
    moves = links.join(out, "src").select("src", "dst", (F.col("weight") * damping / F.col("total")).alias("part"))
    moves = written(moves, "link-parts")
    if moves.isEmpty():
        return seeds.select("host", F.col("share").alias("score"))
    moves = cut_lineage(moves.repartition("src"))  # laid out once; every round then joins without moving the links
    source = seeds.select("host", (F.col("share") * (1 - damping)).alias("score"))
    scores, before, total, turn = source, 0.0, 0.0, 0
    while (not total or total - before > tolerance * total) and (rounds is None or turn < rounds):
        turn += 5
        for _ in range(5):
            sent = moves.join(scores, moves["src"] == scores["host"])
            sent = sent.select(F.col("dst").alias("host"), (F.col("score") * F.col("part")).alias("score"))
            scores = sent.union(source).groupBy("host").agg(F.sum("score").alias("score"))
        scores = cut_lineage(scores)
        before, total = total, scores.agg(F.coalesce(F.sum("score"), F.lit(0.0))).first()[0]
        if not total:
            return scores
    return scores.select("host", (F.col("score") / total).alias("score"))


def seed_shares(hosts: DataFrame, weight: str) -> tuple[DataFrame, float]:
    """Seeds by weight, and their total weight."""
    total = hosts.agg(F.coalesce(F.sum(weight), F.lit(0.0))).first()[0]
    return hosts.where(f"{weight} > 0").select("host", (F.col(weight) / F.lit(total or 1.0)).alias("share")), total


def judge_urls(
    pages: DataFrame, rules: list[Rule], threshold: float = 0.5, damping: float = 0.85, tolerance: float = 1e-6,
    url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """Verdict of each page's URL.

    Adds host, path, rule (the longest that fits, else null), trust, distrust and verdict to the columns of ``pages`` (replacing
    those of the same name).  A rule decides its URLs.  For others the host does: a host is a trusted seed by the share of its
    known URLs that an allow rule covers, and a blocked seed by the share that a block rule covers.  Known are its pages and
    the distinct targets of absolute links that are no pages here, so hosts without pages are seeds, too.  Trust flows
    along the links between hosts, distrust against them (who links to blocked hosts is suspect).
    Both are scaled to seed URLs, so without links they are those shares again; a host is blocked if distrust less
    trust exceeds ``threshold``, and allowed else, as is a URL without a host.
    """
    kinds = {r.name: r.verdict for r in rules}
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "trust", "distrust", "verdict")]
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    placed = pages.select(*own, host.alias("host"), path.alias("path")).withColumn(
        "rule", matching_rule(F.col("host"), F.col("path"), rules)
    )
    ruled = lambda kind: F.coalesce(F.col("rule").isin([n for n, v in kinds.items() if v == kind]), F.lit(False))
    linked = linked_urls(pages, html_col).where("host <> ''").join(
        placed.select("host", "path").distinct(), ["host", "path"], "left_anti"
    ).withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    hosts = written(
        placed.where("host <> ''").select("host", "rule").union(linked.select("host", "rule")).groupBy("host").agg(
            F.avg(ruled("allow").cast("int")).alias("allowed"), F.avg(ruled("block").cast("int")).alias("blocked")
        ), "hosts",
    )
    links = written(host_links(pages, url_col, html_col), "host-links")
    (good, n_good), (bad, n_bad) = seed_shares(hosts, "allowed"), seed_shares(hosts, "blocked")
    trust = propagate(links, good, damping, tolerance=tolerance).select("host", (F.col("score") * n_good).alias("trust"))
    against = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    distrust = propagate(against, bad, damping, tolerance=tolerance).select("host", (F.col("score") * n_bad).alias("distrust"))
    scores = written(
        hosts.select("host").join(trust, "host", "left").join(distrust, "host", "left").na.fill(0.0, ["trust", "distrust"])
        .where("trust > 0 or distrust > 0"), "host-scores",
    )
    judged = placed.join(broadcast_if_small(scores), "host", "left").na.fill(0.0, ["trust", "distrust"])
    verdict = F.when(F.col("distrust") - F.col("trust") > threshold, "block").otherwise("allow")
    if kinds:
        by_rule = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
        verdict = F.coalesce(F.try_element_at(by_rule, "rule"), verdict)
    return judged.select(*own, "host", "path", "rule", "trust", "distrust", verdict.alias("verdict"))
