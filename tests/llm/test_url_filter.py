"""Url verdicts against a plain computation of rules and ranks."""

import re
from collections import Counter

import pytest

from carelake.llm import url_filter
from carelake.llm.url_filter import DAMPING, ROUNDS, RULES, THRESHOLD, UNIT

SCHEMA = "page_id long, url string, html string, host string, verdict string, trust int"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.fullmatch(r"([^/?#]*)([^?#]*)(?s:.*)", url.split("://", 1)[1]).groups()
    return lower(host), path


def rule_of(host, path, rules):
    fit = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fit, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block"), default=None)


def expected(pages, rules=RULES, threshold=THRESHOLD):
    rows = [(page, *split(url), html) for page, url, html in pages]
    hits = [rule_of(host, path, rules) for _, host, path, _ in rows]
    hosts = Counter(r[1] for r in rows if r[1])
    scores = {}
    edges = {(host, lower(x)) for _, host, _, html in rows for x in re.findall(url_filter.LINK, html or "") if host and lower(x) != host}
    for kind, verdict, links in (("trust", "allow", edges), ("distrust", "block", {(b, a) for a, b in edges})):
        mass = Counter(r[1] for r, hit in zip(rows, hits) if hit and hit[0] == verdict)
        mass = {host: UNIT * n // hosts[host] for host, n in mass.items() if host}
        total, fan = Counter(mass), Counter(a for a, _ in links)
        for _ in range(ROUNDS):
            after = Counter()
            for a, b in links:
                after[b] += mass.get(a, 0) * DAMPING // (100 * fan[a])
            mass = after
            total.update(mass)
        scores[kind] = total
    blocked = {h for h, x in scores["distrust"].items() if 100 * x > threshold * UNIT and x > scores["trust"][h]}
    return Counter((page, host, path, hit and hit[1] + hit[2], hit[0] if hit else "block" if host in blocked else "allow")
                   for (page, host, path, _), hit in zip(rows, hits))


def got(spark, pages, **options):
    frame = spark.createDataFrame([(*p, "x", "y", 1) for p in pages], SCHEMA).repartition(3)
    return Counter(tuple(r) for r in url_filter.verdicts(frame, **options).select("page_id", "host", "path", "rule", "verdict").collect())


def link(*urls):
    return "<p>" + " ".join(f'<a class="x" href="{u}">go</a>' for u in urls)


PAGES = [
    (1, "http://WWW.Example.com/en/1?q#f", None), (2, "https://example.com/en/2", ""), (3, "x://a.example.com/de/3", link("http://Friend.org/a")),
    (4, "http://a.net/es/4", link("/local", "http://org-by-link.org/")), (5, "http://a.net/en/5", "x"), (6, "http://net", ""), (7, "http://net/es/", ""),
    (8, None, link("http://far.org")), (9, "no scheme", None), (10, "http://", ""), (11, "http://b.com", ""), (12, "http://b.com?/x", None), (13, "http://b.com/", ""),
    (20, "http://farm.org/1", link("http://a.net/x", "HTTP://net/")), (21, "https://half.org/", link("//a.net", "//b.com")), (22, "http://friend.org/", "<a" * 50_000),
    (23, "http://Farm2.org/", link("http://farm.org")), (24, "http://farm2.org/z/ü", link("http://farm.org")), (25, "http://b.com/b/en/", "<A HREF = '//farm3.org'>"),
    (26, "http://farm3.org#://x/y", link("http://farm3.org/own", "http://a.net", "http://net")), (None, "http://a.net/fr/", None), (None, "http://a.net/fr/", None),
    (30, "a://b://c/d", ""), (31, "http://example.com.net/en/", ""), (32, "http://xexample.com/en/", ""),
] + [(100 + i, "http://farm.org/1", link("http://a.net/x", "http://net/")) for i in range(40)]


def test_verdicts(spark):
    assert got(spark, PAGES) == expected(PAGES)
    result = expected(PAGES, threshold=20)
    assert got(spark, PAGES, threshold=20) == result
    by_host = {r[1]: r[4] for r in result if r[3] is None}
    assert by_host["farm.org"] == "block" and by_host["friend.org"] == "allow"


def test_long_chains_and_other_rules(spark):
    rules = [("block", "bad", ""), ("allow", "bad", ""), ("allow", "good", "/")]
    pages = [(i, f"http://h{i}/", link(f"http://h{i + 1}")) for i in range(25)] + [(50, "http://h25/", link("http://bad")), (51, "http://bad/", ""),
             (52, "http://good/", link(*[f"http://h{i}" for i in range(0, 20, 3)]))]
    assert got(spark, pages, rules=rules) == expected(pages, rules)


def test_no_pages_no_rules(spark):
    assert not got(spark, [])
    assert got(spark, PAGES[:5], rules=[]) == expected(PAGES[:5], [])
    with pytest.raises(ValueError):
        url_filter.verdicts(spark.createDataFrame([], SCHEMA), [("block", "x", "")] * 1001)


def test_the_given_pages_have_links(spark, sf_dir):
    """Links of the table are relative, so they give no edges; with hosts put in they give some."""
    from pyspark.sql import functions as F

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert url_filter.host_edges(pages).count() == 0
    linked = pages.withColumn("html", F.expr("regexp_replace(html, 'href=\"/', concat('href=\"http://', page_id % 7, '.org/'))"))
    assert url_filter.host_edges(linked).count() > 20
