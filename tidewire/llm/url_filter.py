"""URL filter: rules by host and path, and trust propagated over the links between hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import materialise

#: Change of all ranks together, over five rounds, at which propagation has settled.
SETTLED = 1e-6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without a host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest (verdict, "host/path") rule that fits host and path, as struct<rule, verdict>; else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, links): links between the hosts of pages (host, html), summed before the shuffle.

    A link without a host of its own stays on the page's. Null html and empty hosts link nowhere.
    """
    links = pages.where("host <> '' AND html IS NOT NULL").select("host", F.explode(F.regexp_extract_all("html", F.lit(r"""(?i)\bhref\s*=\s*["']?((?<=["'])[^"']*|(?<!["'])[^\s"'>]+)"""), F.lit(1))).alias("href"))
    to = F.when(F.col("href").rlike("^//"), host_of(F.concat(F.lit("http:"), "href"))).when(F.col("href").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), host_of(F.col("href"))).otherwise(F.col("host"))
    return links.select(F.col("host").alias("src"), to.alias("dst")).where("dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("links"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = 0.85) -> DataFrame:
    """(host, trust, distrust): personalised PageRank of both kinds in one pass a round.

    edges: (src, dst, links). seeds: (host, trusted, blocked), any weights >= 0. Trust follows
    links from the trusted seeds; distrust follows them backwards from the blocked ones, to the
    hosts that link there. Each kind starts as a distribution over its seeds and stays one; a
    host from which nothing leads on keeps its weight. Every fifth round is written to the
    shared folder, so the plan stays short. Rounds go on, if their number is not given, until
    five of them reach no new host and change the ranks by less than SETTLED in all. Without
    seeds of a kind nobody has any of it.
    """
    both = edges.selectExpr("'trust' AS kind", "src", "dst", "links").unionByName(edges.selectExpr("'distrust' AS kind", "dst AS src", "src AS dst", "links"))
    out = both.groupBy("kind", "src").agg(F.sum("links").alias("total"))
    moves = both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("links") / F.col("total")).alias("share"))
    start = seeds.selectExpr("host", "stack(2, 'trust', trusted, 'distrust', blocked) AS (kind, weight)").where("weight > 0")
    totals = start.groupBy("kind").agg(F.sum("weight").alias("total"))
    start = materialise(start.join(F.broadcast(totals), "kind").select("kind", F.col("host").alias("src"), (F.col("weight") / F.col("total")).alias("rank")), "seeds")
    hosts = edges.select("src").union(edges.select("dst")).union(start.select("src")).distinct()
    stay = hosts.withColumn("kind", F.explode(F.array(F.lit("trust"), F.lit("distrust")))).join(out, ["kind", "src"], "left_anti")
    moves = materialise(moves.unionByName(stay.select("kind", "src", F.col("src").alias("dst"), F.lit(1.0).alias("share"))), "moves")
    rank = before = start
    k = 0
    while rounds is None or k < rounds:
        moved = rank.join(moves, ["kind", "src"]).select("kind", F.col("dst").alias("src"), (damping * F.col("rank") * F.col("share")).alias("rank"))
        home = start.select("kind", "src", ((1 - damping) * F.col("rank")).alias("rank"))
        rank = moved.unionByName(home).groupBy("kind", "src").agg(F.sum("rank").alias("rank"))
        k += 1
        if k % 5 == 0 and k != rounds:
            rank = materialise(rank, "rank")
            if rounds is None:
                both = rank.join(before.withColumnRenamed("rank", "was"), ["kind", "src"], "left")
                new, change = both.agg(F.count_if(F.col("was").isNull()), F.coalesce(F.sum(F.abs(F.col("rank") - F.coalesce("was", F.lit(0.0)))), F.lit(0.0))).first()
                if not new and change < SETTLED:
                    break
                before = rank
    return rank.groupBy(F.col("src").alias("host")).agg(F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("rank"))), F.lit(0.0)).alias("trust"), F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("rank"))), F.lit(0.0)).alias("distrust"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], threshold: float = 0.5, rounds: int | None = None) -> DataFrame:
    """A row for each page (page_id, url, html): page_id, host, path, rule, verdict, trust, distrust.

    The longest rule that fits decides. Pages without one get the verdict of their host: block if
    distrust / (trust + distrust) >= threshold, else allow; hosts that neither reaches are
    allowed. A host's seeds are its pages that the rules allow and block. Null urls and urls
    without :// have empty host and path, no rule, and are allowed. Repeated pages are judged
    each for itself; other columns are left alone.
    """
    placed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    placed = placed.withColumn("fit", matching_rule(F.col("host"), F.col("path"), rules))
    seeds = placed.where("host <> '' AND fit IS NOT NULL").groupBy("host").agg(F.count_if(F.col("fit.verdict") == "allow").alias("trusted"), F.count_if(F.col("fit.verdict") == "block").alias("blocked"))
    edges = materialise(host_edges(placed), "edges")
    scores = materialise(propagate(edges, seeds, rounds), "scores")
    joined = placed.drop("html").join(scores, "host", "left").na.fill(0.0, ["trust", "distrust"])
    by_host = F.when((F.col("distrust") > 0) & (F.col("distrust") >= threshold * (F.col("trust") + F.col("distrust"))), "block").otherwise("allow")
    return joined.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", by_host).alias("verdict"), "trust", "distrust")
