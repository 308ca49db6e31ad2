from __future__ import annotations

from collections import deque

import pyarrow as pa

from sheaf.functions import slices as slc
from sheaf.operators import web as wb
from tests.conftest import rows

NS = "http://www.sitemaps.org/schemas/sitemap/0.9"


def test_page_text_title_and_documents(spark):
    html = ("<html><head><title> A &amp; B </title><style>p{x}</style>"
            "<script>var t='</p>';</script></head><body><!-- c --><h1>Hi</h1>"
            "<p>one&nbsp;two &lt;three&gt;</p></body></html>")
    pages = spark.createDataFrame([("https://e.com/a", html)], "url string, html string")
    c = wb.crawled_pages(pages).collect()[0]
    assert c["title"] == "A & B"
    assert c["inner_text"] == "Hi\n\none\u00a0two <three>"
    assert c["is_sitemap"] is False
    d = wb.page_documents(wb.crawled_pages(pages)).collect()[0]
    assert d["doc_id"] == "https://e.com/a" and d["metadata"] == {"title": "A & B", "url": "https://e.com/a"}


def test_link_resolution(spark):
    html = ('<a href="https://x.org/p#f">1</a><a href="/root">2</a><a href="rel/x">3</a>'
            '<a href="//cdn.e.com/y">4</a><a href="#top">5</a><a href="mailto:a@b">6</a><a href="/root">7</a>')
    pages = spark.createDataFrame([(1, "https://e.com/dir/page?q=1", html)], "page_id long, url string, html string")
    got = rows(wb.page_links(pages), "link", "n_refs")
    assert got == [("https://cdn.e.com/y", 1), ("https://e.com/dir/rel/x", 1), ("https://e.com/root", 2),
                   ("https://x.org/p", 1)]


def test_links_take_one_python_pass(spark):
    """A page is read and its links are resolved at once; neither its text nor the page itself goes along with each link."""
    pages = spark.createDataFrame([
        (1, "https://e.com/d/p", '<base href="/b&amp;c/"><a href="x">1</a><a href="https://y.org/?a&amp;b">2</a><a>3</a>'),
        (2, "https://e.com/d/p", None), (3, None, '<a href="https://e.com/z">1</a>'), (4, "https://e.com/d/p", '<a href="q">1</a>' * 600)],
        "page_id long, url string, html string").coalesce(1)
    links = wb.page_links(pages)
    assert rows(links) == [(1, "https://e.com/b&c/x", 1), (1, "https://y.org/?a&b", 1), (4, "https://e.com/d/q", 600)]
    assert links._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    hrefs = wb.page_hrefs(pages.filter("page_id <> 4"), "page_id")
    assert rows(hrefs, "page_id", "base", "href") == [
        (1, "https://e.com/b&c/", "https://y.org/?a&amp;b"), (1, "https://e.com/b&c/", "x"), (3, None, "https://e.com/z")]


def test_slices_are_bounded_by_rows_and_text(monkeypatch):
    monkeypatch.setattr(slc, "SLICE_ROWS", 3)
    monkeypatch.setattr(slc, "SLICE_BYTES", 10)
    texts = pa.array(["a" * 30, "b", None, "c" * 8, "d" * 4, "e", "f", "g", "h"][:9])
    cut = [part.to_pylist() for (part,) in slc.slices(texts)]
    assert cut == [["a" * 30], ["b", None, "c" * 8], ["d" * 4, "e", "f"], ["g", "h"]]
    assert [len(part) for (part,) in slc.slices(texts.slice(4))] == [3, 2] and not list(slc.slices(texts.slice(9)))


def test_sitemap_cases(spark):
    good = (f'<?xml version="1.0"?><urlset xmlns="{NS}"><url><loc>  https://a.com/1 \n</loc></url>'
            f"<url><loc>ftp://a.com/f</loc></url><url><loc></loc></url><url><loc>https://a.com/1</loc></url>"
            f"<url><loc>http://a.com/2</loc></url></urlset>")
    index = f'<sitemapindex xmlns="{NS}"><sitemap><loc>https://a.com/s.xml</loc></sitemap></sitemapindex>'
    other_ns = '<urlset xmlns="http://example.com/other"><url><loc>https://a.com/3</loc></url></urlset>'
    broken = f'<urlset xmlns="{NS}"><url><loc>https://a.com/4</loc></url>'
    sm = spark.createDataFrame([("good", good), ("index", index), ("other", other_ns), ("broken", broken)],
                               "sitemap_url string, content string")
    assert rows(wb.sitemap_links(sm)) == [("good", "http://a.com/2"), ("good", "https://a.com/1")]
    assert [r["sitemap_url"] for r in wb.sitemap_rejects(sm).collect()] == ["broken"]


def test_seed_checks(spark):
    jobs = spark.createDataFrame([("c", "p1", ["https://a", "http://b"]), ("c", "p2", []),
                                  ("c", "p3", ["https://a", "ftp://b"]), ("", "p4", ["https://a"])],
                                 "community_id string, platform_id string, urls array<string>")
    got = {r["platform_id"]: r["status"] for r in wb.check_seeds(jobs).collect()}
    assert got == {"p1": "ok", "p2": "no_urls", "p3": "invalid_url", "p4": "no_community"}


def _bfs(seed, edges, budget, max_depth):
    depth = {seed: 0}
    q = deque([seed])
    while q:
        u = q.popleft()
        if depth[u] == max_depth:
            continue
        for v in sorted(edges.get(u, [])):
            if v not in depth:
                depth[v] = depth[u] + 1
                q.append(v)
    return sorted(sorted(depth.items(), key=lambda kv: (kv[1], kv[0]))[:budget])


def test_crawl_frontier_against_brute_force(spark):
    import random
    rnd = random.Random(7)
    nodes = [f"n{i:02d}" for i in range(40)]
    edges = {}
    for _ in range(120):
        a, b = rnd.choice(nodes), rnd.choice(nodes)
        edges.setdefault(a, set()).add(b)
    seeds = ["n00", "n05", "n17"]
    edf = spark.createDataFrame([(a, b) for a, bs in edges.items() for b in bs], "src string, dst string")
    sdf = spark.createDataFrame([(s,) for s in seeds], "seed string")
    got = wb.crawl_frontier(sdf, edf, budget=6, max_depth=4)
    for s in seeds:
        mine = sorted((r["url"], r["depth"]) for r in got.filter(got.seed == s).collect())
        assert mine == _bfs(s, edges, 6, 4)


def test_seed_modes(spark):
    import pytest
    jobs = spark.createDataFrame([("c", "p1", ["https://a", "ftp://b", ""])],
                                 "community_id string, platform_id string, urls array<string>")
    assert [r["seed"] for r in wb.seed_urls(jobs).collect()] == ["https://a"]
    with pytest.raises(ValueError):
        wb.seed_urls(jobs, mode="raise")
    with pytest.raises(ValueError):
        wb.validate_seeds(["https://a", "ftp://b"])
    assert wb.validate_seeds(["http://a"]) == ["http://a"]


def test_sitemap_files_and_request_files(spark, tmp_dir):
    import json
    import os
    from sheaf.sources.requests import read_batch_requests, read_requests
    from sheaf.sources.sitemaps import read_sitemaps
    with open(os.path.join(tmp_dir, "sitemap.xml"), "w") as f:
        f.write(f'<?xml version="1.0"?>\n<urlset xmlns="{NS}">\n<url>\n<loc>https://a.com/x</loc>\n</url>\n</urlset>\n')
    got = wb.sitemap_links(read_sitemaps(spark, tmp_dir)).collect()
    assert [r["link"] for r in got] == ["https://a.com/x"]
    req_dir = os.path.join(tmp_dir, "req")
    os.makedirs(req_dir)
    with open(os.path.join(req_dir, "r.json"), "w") as f:
        f.write(json.dumps({"communityId": "c", "platformId": "p", "text": "t", "metadata": {"a": "b"}}) + "\n")
        f.write(json.dumps({"communityId": "c", "platformId": "p", "collectionName": "x",
                            "document": [{"docId": "1", "text": "t", "metadata": {}}]}) + "\n")
    single = read_requests(spark, req_dir).collect()
    assert single[0]["metadata"] == {"a": "b"} and single[0]["docId"] is None
    batch = read_batch_requests(spark, req_dir).collect()
    assert batch[1]["document"][0]["docId"] == "1"


def test_crawl_job_guards(spark):
    import pytest
    edges = spark.createDataFrame([("https://a/", "https://a/x")], "src string, dst string")
    got = rows(wb.crawl_job(spark, ["https://a/"], edges, max_depth=2), "url", "depth")
    assert got == [("https://a/", 0), ("https://a/x", 1)]
    with pytest.raises(ValueError):
        wb.crawl_job(spark, [], edges)
    with pytest.raises(ValueError):
        wb.crawl_job(spark, ["ftp://a/"], edges)


def test_href_forms(spark):
    html = ("<a href=\"/a\">1</a><a class='c' href = '/b'>2</a><a data-href=\"/no\">3</a>"
            "<A HREF=\"/c\">4</A><abbr href=\"/no\">5</abbr><a\nhref=\"/d\">6</a>")
    pages = spark.createDataFrame([(1, "https://e.com/", html)], "page_id long, url string, html string")
    assert [r["link"] for r in wb.page_links(pages).orderBy("link").collect()] == [
        "https://e.com/a", "https://e.com/b", "https://e.com/c", "https://e.com/d"]


def test_a_crawl_round_meets_what_a_seed_holds_in_one_exchange(spark):
    """The round before is all that a round reads: pages held by a seed come with its frontier, not from all rounds."""
    frontier = spark.createDataFrame([("a", "a2", 3, ["a", "a1", "a2"]), ("a", "a1", 3, None), ("b", "b", 1, ["b"])],
                                     "seed string, url string, held long, seen array<string>")
    edges = spark.createDataFrame([("a2", "a"), ("a2", "x"), ("a1", "x"), ("a1", "w"), ("a1", "y"), ("b", "b"), ("b", "z"), ("q", "z")],
                                  "src string, dst string")
    new = wb.crawl_round(frontier, edges, 5)
    got = {(r["seed"], r["url"]): (r["held"], sorted(r["seen"]) if r["seen"] else None) for r in new.collect()}
    assert got == {("a", "w"): (5, None), ("a", "x"): (5, None), ("b", "z"): (2, ["b", "z"])}
    plan = new._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and plan.count("Join") == 1
