"""Links and entities, the website pipeline, the wiki quarantine and continuous loads."""

from __future__ import annotations

import os

import pytest

from sheaf.functions.text import join_url
from sheaf.operators import web as wb
from sheaf.operators import wiki as wk
from sheaf.operators.load import read_collection
from sheaf.sources import wiki as wsrc
from sheaf.streaming import ingest
from tests.conftest import rows

NS = "http://www.sitemaps.org/schemas/sitemap/0.9"


@pytest.mark.parametrize("base,href,expected", [
    ("https://h.org/a/b", "?p=2", "https://h.org/a/b?p=2"),
    ("https://h.org/a/b/c", "../x", "https://h.org/a/x"),
    ("https://h.org/a/b", "./x/./y", "https://h.org/a/x/y"),
    ("https://h.org/a", "  /padded \n", "https://h.org/padded"),
    ("https://h.org/a", "HTTP://Other.org/z", "http://Other.org/z"),
    ("https://h.org/a", "//cdn.h.org/y#part", "https://cdn.h.org/y"),
    ("https://h.org/a", "#top", None), ("https://h.org/a", "", None), ("https://h.org/a", None, None),
    ("https://h.org/a", "mailto:a@b", None), ("https://h.org/a", "javascript:void(0)", None),
    ("https://h.org/a", "http://[broken", None), (None, "/x", None)])
def test_join_url(base, href, expected):
    assert join_url(base, href) == expected


def test_links_and_text_decode_references(spark):
    html = ('<html><head><title>It&#8217;s &eacute;t&eacute;</title></head><body>A&#x27;s&nbsp;&nbsp;B &amp;lt; C'
            '<a href="/s?a=1&amp;b=2">1</a><a href=" ?p=2 ">2</a></body></html>')
    pages = spark.createDataFrame([(1, "https://h.org/a/b", html)], "page_id long, url string, html string")
    assert rows(wb.page_links(pages), "link") == [("https://h.org/a/b?p=2",), ("https://h.org/s?a=1&b=2",)]
    got = wb.crawled_pages(pages).first()
    assert got["title"] == "It’s été" and got["inner_text"] == "A's\u00a0\u00a0B &lt; C12"


def test_website_documents_stay_on_their_host(spark):
    page = '<body>%s<a href="/b">b</a><a href="https://away.org/x">x</a></body>'
    pages = spark.createDataFrame([("https://h.org/a#top", page % "first "), ("https://h.org/b", "<body>second</body>"),
                                   ("https://away.org/x", "<body>other</body>"), ("https://h.org/alone", "<body>alone</body>")],
                                  "url string, html string")
    maps = spark.createDataFrame([("https://m.org/sitemap.xml", f'<urlset xmlns="{NS}"><url><loc>https://m.org/p</loc></url></urlset>')],
                                 "sitemap_url string, content string")
    more = pages.union(spark.createDataFrame([("https://m.org/p", "<body>mapped</body>")], "url string, html string"))
    jobs = spark.createDataFrame([("c", "p", ["https://h.org/a", "https://h.org/b"]), ("c", "m", ["https://m.org/sitemap.xml"]),
                                  ("c", "bad", ["https://h.org/a", "ftp://h.org"])],
                                 "community_id string, platform_id string, urls array<string>")
    got = rows(wb.website_documents(jobs, more, maps), "collection", "doc_id", "text")
    assert got == [("c_m", "https://m.org/p", "mapped"), ("c_p", "https://h.org/a", "first bx"), ("c_p", "https://h.org/b", "second")]


DUMP = """<mediawiki xmlns="%s" version="0.11"><siteinfo><sitename>W</sitename><dbname/><base/></siteinfo>
<page><title>Good</title><ns>0</ns><id>1</id>
<revision><id>5</id><timestamp>2024-01-01T00:00:00Z</timestamp><text>old</text></revision>
<revision><id>6</id><timestamp>2024-02-01T00:00:00Z</timestamp><text>new</text></revision></page>
<page><title>Torn</title><ns>0</ns><id</page>
<page><title>Empty</title><ns>0</ns><id>3</id></page></mediawiki>"""


def test_malformed_pages_and_headers(spark, tmp_dir):
    for name, version in (("dump.xml", "0.11"), ("old.xml", "0.10")):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(DUMP % f"http://www.mediawiki.org/xml/export-{version}/")
    pages = wsrc.read_dump(spark, tmp_dir)
    bad = {r["reason"]: r for r in wk.page_rejects(wk.flatten_pages(pages)).collect()}
    assert set(bad) == {"bad_xml", "no_revision"}
    assert bad["bad_xml"]["raw_xml"].startswith("<page><title>Torn</title>") and bad["no_revision"]["page_id"] == "3"
    assert [r["page_id"] for r in wk.current_revisions(pages).collect()] == ["1"]
    current = wk.flatten_pages(wk.current_pages(pages, namespaces=[0]))
    assert [r["text"] for r in current.collect() if r["has_revision"]] == ["new"]
    assert sorted(r["reason"] for r in wk.page_rejects(current).collect()) == ["bad_xml", "no_revision"]
    info = wsrc.read_siteinfo(spark, tmp_dir).collect()
    assert [(r["sitename"], r["dbname"], r["base"]) for r in info] == [("W", None, None)]


def test_stream_of_requests_upserts_the_collection(spark, tmp_dir):
    schema = "communityId string, platformId string, text string, metadata map<string,string>, docId string"
    src, store, check = (os.path.join(tmp_dir, n) for n in ("in", "store", "check"))
    for batch in ([("c", "p", "one", {}, "1"), ("c", "p", "two", {}, "2")], [("c", "p", "two again", {}, "2")]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
        ingest.start_load(spark, src, store, check).awaitTermination()
    got = rows(read_collection(spark, store), "collection", "doc_id", "chunk_text", "loaded_by")
    assert [tuple(map(str, r)) for r in got] == [("c_p", "1", "one", "0"), ("c_p", "2", "two again", "1")]
