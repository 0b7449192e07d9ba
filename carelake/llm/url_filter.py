"""URL verdicts: rules on hosts and paths, and trust carried over the links between hosts for what no rule fits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from carelake.operators.grouping import join_lookup
from carelake.session import stored

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The host of an absolute link; a relative one stays on its page's host. No part of it can run past the tag.
LINK = r"""(?i)<a\s[^<>]*?href\s*=\s*["']?\s*(?:https?:)?//([^\s"'<>/?#]+)"""
ALLOW, BLOCK = "allow", "block"
# (verdict, host, path): the rules of the registered query.
RULES = ((ALLOW, "com", "/"), (BLOCK, "example.com", "/en/"), (ALLOW, "www.example.com", "/en/"), (BLOCK, "net", "/es/"),
         (BLOCK, "net", "/fr/"))
# Rules become one expression, so there is a bound on how many.
MOST_RULES = 1000
# What a host gives to the next ones, in percent; how often; and a seed's mass, in units that are never split.
DAMPING, ROUNDS, UNIT = 85, 16, 10**8
# A host is blocked over so many percent of a seed's mass of distrust.
THRESHOLD = 50


def lowered(text: Column) -> Column:
    return F.translate(text, CAPITALS, SMALL)


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host and path of a url; both empty without ``://`` or without a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise(F.lit(""))
    rest = F.substring_index(F.substring_index(rest, "#", 1), "?", 1)
    host = F.substring_index(rest, "/", 1)
    return lowered(host), F.substr(rest, F.char_length(host) + 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct (verdict, rule), else null.

    A rule fits its host, all subdomains, and paths that begin with its own. Of
    two of one length the one with the longer host wins, and blocking before
    allowing where both have the same host and path.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"over {MOST_RULES} rules; join longer lists by host instead")
    if not rules:
        return F.lit(None).cast("struct<verdict:string,rule:string>")
    ordered = sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == BLOCK), reverse=True)

    def fits(name: str, start: str) -> Column:
        own = (host == name) | F.endswith(host, F.lit("." + name))
        return own & F.startswith(path, F.lit(start)) if start else own

    first, *rest = [(fits(name, start), F.struct(F.lit(verdict).alias("verdict"), F.lit(name + start).alias("rule")))
                    for verdict, name, start in ordered]
    return reduce(lambda chain, case: chain.when(*case), rest, F.when(*first))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, url) -> page_id, host, path, by_rule (verdict, rule) or null."""
    host, path = host_and_path("url")
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    return parts.withColumn("by_rule", fitting_rule(F.col("host"), F.col("path"), rules))


def host_edges(pages: DataFrame) -> DataFrame:
    """(url, html) -> distinct (a, b): some page of host a links to host b, another one.

    Links are found in the whole html and made distinct within a page and, by
    partial aggregation, within a task before anything is shuffled; the key is
    the pair, so no host gathers in one task.
    """
    host, _ = host_and_path("url")
    links = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lowered))
    found = pages.select(host.alias("a"), F.explode(links).alias("b"))
    return found.where("a <> '' and b <> '' and a <> b").distinct()


def seeds(rows: DataFrame, unit: int = UNIT) -> DataFrame:
    """Each host's share of pages that rules allow and that they block, in parts of ``unit``: (host, trust, distrust)."""
    share = lambda verdict: F.expr(f"{unit} * count_if(by_rule.verdict = '{verdict}') div count(*)")
    return rows.where("host <> ''").groupBy("host").agg(share(ALLOW).alias("trust"), share(BLOCK).alias("distrust"))


def propagate(seeded: DataFrame, edges: DataFrame, rounds: int = ROUNDS, damping: int = DAMPING) -> DataFrame:
    """Personalised PageRank of trust along links and of distrust against them: (host, trust, distrust).

    The rank is the sum over rounds of what reaches a host: a round passes on
    ``damping`` percent of the last one's arrivals, in equal parts for each
    edge, whole units only, so sums don't depend on their order. Mass that
    reaches a host without edges ends there. The rounds stop when nothing moves
    or after ``rounds``, which leaves 0.85**16, 7 %, of a seed's mass unsent.
    Trust and distrust go together: an edge belongs to both kinds, once each way.
    Every round's arrivals are stored, and lineage ends there.
    """
    both = (edges.select(F.lit("trust").alias("kind"), F.col("a").alias("from"), F.col("b").alias("to"))
            .unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("b").alias("from"), F.col("a").alias("to"))))
    paths = stored(both.join(both.groupBy("kind", "from").agg(F.count(F.lit(1)).alias("fan")), ["kind", "from"]), "host-edges")
    moving = seeded.select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust) as (kind, mass)")).where("mass > 0")
    arrived = [moving]
    for _ in range(rounds):
        sent = moving.withColumnRenamed("host", "from").join(paths, ["kind", "from"])
        moving = stored(sent.groupBy(F.col("to").alias("host"), "kind")
                        .agg(F.expr(f"sum(mass * {damping} div (100 * fan))").alias("mass")).where("mass > 0"), "arrivals")
        if moving.isEmpty():
            break
        arrived.append(moving)
    total = lambda kind: F.expr(f"coalesce(sum(mass) filter (where kind = '{kind}'), 0)").alias(kind)
    return reduce(DataFrame.unionByName, arrived).groupBy("host").agg(total("trust"), total("distrust"))


def verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, rounds: int = ROUNDS, damping: int = DAMPING,
             threshold: int = THRESHOLD) -> DataFrame:
    """Columns (page_id, url, html) -> page_id, host, path, rule, verdict, one row per row.

    Where no rule fits, the page's host decides: it is blocked if its distrust
    is over ``threshold`` percent of a whole seed's and over its trust. A host
    is a seed by the share of its own pages that rules allow or block, and gets
    more from the hosts it is linked with. Without either it is allowed, as are
    pages without a host. Null html has no links. Nothing is taken from equal
    page_ids, a null one included; further columns are ignored; an empty table
    gives no rows.
    """
    rows = judged(pages, rules)
    seeded = stored(seeds(rows), "host-seeds")
    ranks = propagate(seeded, host_edges(pages), rounds, damping)
    blocked = ranks.where(f"distrust * 100 > {threshold * UNIT} and distrust > trust").select("host", F.lit(BLOCK).alias("by_links"))
    return join_lookup(rows, blocked, "host").select(
        "page_id", "host", "path", F.col("by_rule.rule").alias("rule"),
        F.coalesce("by_rule.verdict", "by_links", F.lit(ALLOW)).alias("verdict"))
