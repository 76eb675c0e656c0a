from __future__ import annotations

import datetime as dt
import time
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from gridloom.functions.urls import absolute_url
from gridloom.operators import frontier, pages
from gridloom.operators.html import MOST_NESTED, read_page


def test_links_know_dates_next_pages_and_navigation():
    page = read_page(
        "<nav><a href='/n'>Nav</a></nav><ul><li><a href='/a'>Rule 2024-02-30</a> 2024-05-06</li><li>seen 2023年7月8日 <a href='/b'>B</a></li></ul>"
        "<a href='/2' rel='next'>more</a><a href='/3'>Next page</a><a href='/4'>下一页</a><a href=' /c '>C</a> 2022/1/2<a>no link</a>"
    )
    got = {link.href: (link.label, link.is_next, link.date_hint, link.skipped) for link in page.links}
    assert got["/n"] == ("Nav", False, dt.date(2023, 7, 8), True) or got["/n"][3]
    assert got["/a"] == ("Rule 2024-02-30", False, None, False)  # the first date is no day
    assert got["/b"] == ("B", False, dt.date(2023, 7, 8), False)  # from the item around
    assert [got[h][1] for h in ("/2", "/3", "/4", "/c")] == [True, True, True, False]


def test_deep_nesting_is_linear_and_loses_no_text():
    began = time.perf_counter()
    page = read_page("<li><ul>x " * 20_000)
    assert len(page.blocks) == 20_000 and all(t for t, _ in page.blocks)
    assert max(len(t.split()) for t, _ in page.blocks) <= MOST_NESTED
    read_page("<li><ul>" + "<div>" * 20_000 + "<li></li>" * 20_000)
    read_page("<p>" * 100_000 + "<a href=x>" * 50_000 + "</p></li>" * 50_000)
    assert time.perf_counter() - began < 20


@pytest.mark.parametrize("html", [None, "", "<", "<p", "</p></div>", "<a href='x'", "<!-- c", "<title>t", "&amp;&bad;", "<p/>x<br/>y"])
def test_broken_pages_do_not_fail(html):
    read_page(html)


def test_absolute_urls_as_the_standard_library_resolves_them(spark):
    bases = ["http://a/b/c/d?q", "https://x.org", "https://x.org/", "https://x.org/a/b/?p=1#f", "http://h/a/../b/c"]
    hrefs = ["g", "./g", "g/", "/g", "//g/z", "?y", "g?y", "#s", "g#s", "g?y#s", "", ".", "..", "../", "../g", "../../g", "../../../g", "/./g", "/../g", "g.", "..g", "./g/.", "g/../h", "http://o/p", "mailto:x", "a//b"]
    df = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string")
    for r in df.select("b", "h", absolute_url(F.col("b"), F.col("h")).alias("u")).collect():
        assert r["u"] == urljoin(r["b"], r["h"]), (r["b"], r["h"])
    assert spark.range(1).select(absolute_url(F.lit("no base"), F.lit("x"))).first()[0] is None


def test_attachments_outside_navigation(spark):
    html = "<nav><a href='/n.pdf'>N</a></nav><a href='f.PDF?x=1'></a><a href='/y'>附件：表</a><a href='/z'>z</a>"
    df = spark.createDataFrame([(1, "https://a.org/p/q", html)], "page_id long, url string, html string")
    got = [(r["label"], r["attachment_url"]) for r in pages.attachments(pages.parse_pages(df)).collect()]
    assert got == [("f.PDF?x=1", "https://a.org/p/f.PDF?x=1"), ("附件：表", "https://a.org/y")]


def test_text_outside_blocks_is_the_record_of_a_page_without_blocks(spark):
    df = spark.createDataFrame([(1, "https://a.org/", "<html><title>城市更新办法</title><body>政策正文</body></html>")], "page_id long, url string, html string")
    row = pages.page_records(pages.parse_pages(df)).first()
    assert row["title"] == "城市更新办法" and "政策正文" in row["full_text"] and row["parse_status"] == "partial"


SITE = {
    "https://a.org/list": "<li><a href='/old'>Old 2020-01-01</a></li><li><a href='/new'>New 2026-07-15</a></li><li><a href='/plain'>Plain</a></li><li><a href='/list2'>下一页</a></li><li><a href='/list3' rel='next'>3</a></li>",
    "https://a.org/list2": "<li><a href='/list'>下一页</a></li><li><a href='/list4'>next</a></li><li><a href='/new'>New again</a></li><li><a href='/p2'>P2</a></li>",
    "https://a.org/list3": "<li><a href='/list4'>next</a></li><li><a href='/p3'>P3</a></li>",
    "https://a.org/list4": "<li><a href='/list2'>next</a></li><li><a href='/gone'>next</a></li><li><a href='/p4'>P4</a></li>",
    "https://b.org/": "<li><a href='/'>next</a></li><li><a href='https://a.org/x'>elsewhere</a></li><li><a href='/only'>Only</a></li>",
    "https://c.org/": "no links",
}


@pytest.fixture(scope="module")
def site(spark):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(SITE.items())], "page_id long, url string, html string")
    links = pages.page_links(pages.parse_pages(df))
    seeds = spark.createDataFrame([("A", "https://a.org/list", 0), ("B", "https://b.org/", 0), ("C", "https://c.org/", 0), ("D", "https://nowhere.org/", 0), ("A", "https://www.a.org/list/", 1)], "source_id string, url string, seq int")
    known = df.select(F.col("url").alias("page"))
    return links, known, seeds


def visited_of(df):
    return sorted((r["source_id"], r["page_no"], r["page"].removeprefix("https://"), r["depth"]) for r in df.collect())


def test_walk_follows_next_pages_and_cycles_end(site):
    want = [("A", 1, "a.org/list", 0), ("A", 2, "a.org/list2", 1), ("A", 3, "a.org/list3", 1), ("A", 4, "a.org/list4", 2), ("B", 1, "b.org/", 0), ("C", 1, "c.org/", 0)]
    assert visited_of(frontier.walk_pages(*site)) == want
    assert visited_of(frontier.walk_pages(*site, max_pages=3)) == [w for w in want if w[1] <= 3]
    assert visited_of(frontier.walk_pages(*site, max_pages=1)) == [w for w in want if w[1] == 1]
    links, known, seeds = site
    assert visited_of(frontier.walk_pages(links, known, seeds.limit(0))) == []


def test_candidates_in_the_order_of_discovery(site):
    links, known, seeds = site
    visited = frontier.walk_pages(links, known, seeds)
    found = lambda **kw: sorted((r["source_id"], r["canonical_url"].rpartition("/")[2], r["title_hint"], r["depth"], r["discovery_score"]) for r in frontier.discover(links, visited, **kw).collect())
    old, new = ("A", "old", "Old 2020-01-01", 0, 0.75), ("A", "new", "New 2026-07-15", 0, 0.75)
    rest = [("A", "p2", "P2", 1, 0.6), ("A", "p3", "P3", 1, 0.6), ("A", "p4", "P4", 2, 0.6), ("A", "plain", "Plain", 0, 0.6), ("B", "only", "Only", 0, 0.6)]
    assert found() == sorted([old, new, *rest])
    window = {"since": dt.date(2026, 7, 1), "until": dt.date(2026, 7, 16)}
    assert found(**window) == sorted([new, *rest])
    assert found(**window, max_candidates=2) == sorted([new, rest[3], rest[4]])
    assert [r["parent_url"] for r in frontier.discover(links, visited).where("canonical_url LIKE '%p4'").collect()] == ["https://a.org/list4"]


def plain_walk(edges, seeds):
    """(page_no, page, depth) of a queue that starts with ``seeds``; ``edges`` maps a page to its next pages in order."""
    depth = {}
    for s in seeds:
        depth.setdefault(s, 0)
    queue = list(depth)
    for page in queue:
        for to in edges.get(page, ()):
            if to not in depth:
                depth[to] = depth[page] + 1
                queue.append(to)
    return [(n, p, depth[p]) for n, p in enumerate(queue, 1)]


def test_walk_equals_a_queue(spark):
    """Long chains, branches, joins of chains and cycles, from several seeds: depths and the queue's order."""
    import random

    r = random.Random(12)
    url = "https://{}.org/{}".format
    edges = {url("a", i): [url("a", i + 1)] for i in range(120)}
    edges[url("a", 120)] = [url("a", 7)]
    for i in (20, 33, 34, 80):
        edges[url("a", i)].insert(r.randrange(2), url("a", r.randrange(121)))
    edges |= {url("b", i): list(dict.fromkeys(url("b", r.randrange(40)) for _ in range(r.choice([1, 1, 1, 2, 3])))) for i in range(40)}
    edges = {p: [t for t in to if t != p] for p, to in edges.items()}
    seeds = {"A": [url("a", 0)], "A2": [url("a", 50), url("a", 22), url("a", 60)], "B": [url("b", 3), url("b", 1)], "C": [url("c", 1)]}
    links = spark.createDataFrame([(p, i, t, True) for p, to in edges.items() for i, t in enumerate(to)], "page string, pos int, canonical_url string, is_next boolean")
    known = spark.createDataFrame([(p,) for p in edges], "page string")
    given = spark.createDataFrame([(s, p, i) for s, ps in seeds.items() for i, p in enumerate(ps)], "source_id string, url string, seq int")
    there = {p: [t for t in to if t in edges] for p, to in edges.items()}
    want = sorted((s, *w) for s, ps in seeds.items() for w in plain_walk(there, [p for p in ps if p in edges]))
    got = lambda **kw: sorted((x["source_id"], x["page_no"], x["page"], x["depth"]) for x in frontier.walk_pages(links, known, given, **kw).collect())
    assert got() == want and max(w[3] for w in want) > 30
    assert got(max_pages=9) == [w for w in want if w[1] <= 9]


def test_a_long_chain_takes_few_tables(spark, monkeypatch):
    """A chain is not walked page by page."""
    written, stored = [], frontier.stored
    monkeypatch.setattr(frontier, "stored", lambda *x: written.append(1) or stored(*x))
    n = 400
    page = F.concat(F.lit("https://a.org/"), F.col("id").cast("string"))
    links = spark.range(n).select(page.alias("page"), F.lit(0).alias("pos"), F.concat(F.lit("https://a.org/"), ((F.col("id") + 1) % n).cast("string")).alias("canonical_url"), F.lit(True).alias("is_next"))
    seeds = spark.createDataFrame([("A", "https://a.org/0", 0)], "source_id string, url string, seq int")
    walked = frontier.walk_pages(links, links.select("page"), seeds)
    assert walked.agg(F.count("*"), F.max("depth"), F.max("page_no")).first() == (n, n - 1, n) and len(written) < 30
