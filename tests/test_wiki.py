"""MediaWiki dump reading and page → document rules (hand-made XML)."""

from __future__ import annotations

import os

import pytest

from sheaf.operators import wiki as wk
from sheaf.quality import REASON, split_valid
from sheaf.sources import wiki as wsrc

NS = "http://www.mediawiki.org/xml/export-0.11/"

DUMP = f"""<mediawiki xmlns="{NS}" version="0.11">
<siteinfo><sitename>Test Wiki</sitename><dbname>testwiki</dbname><base>https://t.example/</base>
<generator>MediaWiki 1.39</generator></siteinfo>
<page><title>No revision</title><ns>0</ns><id>1</id></page>
<page><title>Two revisions</title><ns>0</ns><id>2</id>
<revision><id>20</id><timestamp>2023-01-01T00:00:00Z</timestamp><contributor><username>a</username><id>7</id></contributor>
<comment>first</comment><model>wikitext</model><format>text/x-wiki</format><text>old</text><sha1>s1</sha1></revision>
<revision><id>21</id><parentid>20</parentid><timestamp>2024-01-01T00:00:00Z</timestamp><contributor><ip>10.0.0.1</ip></contributor>
<model>wikitext</model><format>text/x-wiki</format><text>new</text><sha1>s2</sha1></revision>
</page>
<page><title>Markup &amp; spaces</title><ns>1</ns><id>3</id>
<revision><id>30</id><timestamp>2024-02-01T00:00:00Z</timestamp><comment/><model>wikitext</model>
<text xml:space="preserve">  &lt;b&gt;bold&lt;/b&gt; &amp;amp;lt;  </text><sha1>s3</sha1></revision>
</page>
<page><title>Empty text</title><ns>0</ns><id>4</id>
<revision><id>40</id><timestamp>2024-02-01T00:00:00Z</timestamp><text/></revision>
</page>
</mediawiki>
"""


@pytest.fixture
def dump_dir(tmp_dir):
    with open(os.path.join(tmp_dir, "dump.xml"), "w") as f:
        f.write(DUMP)
    with open(os.path.join(tmp_dir, "other.xml"), "w") as f:   # another export version: no pages
        f.write(DUMP.replace("export-0.11", "export-0.10"))
    return tmp_dir


def test_flatten_rules(spark, dump_dir):
    flat = {r["page_id"]: r for r in wk.flatten_pages(wsrc.read_dump(spark, dump_dir)).collect()}
    assert sorted(flat) == ["1", "2", "3", "4"]
    assert flat["1"]["has_revision"] is False and flat["1"]["text"] is None
    two = flat["2"]                      # first revision in document order
    assert (two["revision_id"], two["text"], two["comment"], two["contributor_username"]) == ("20", "old", "first", "a")
    three = flat["3"]
    assert three["title"] == "Markup & spaces"
    assert three["text"] == "  <b>bold</b> &amp;lt;  "     # one level of decoding, spaces kept
    assert three["comment"] is None                         # <comment/> → None
    assert three["contributor_username"] is None            # no contributor element
    assert flat["4"]["text"] is None and flat["4"]["comment"] == ""   # <text/> → None, absent comment → ""


def test_documents_and_rejects(spark, dump_dir):
    docs = wk.page_documents(wk.flatten_pages(wsrc.read_dump(spark, dump_dir)))
    ok, rejected = split_valid(docs, barrier=True)
    assert sorted(r["doc_id"] for r in ok.collect()) == ["2", "3"]
    assert sorted((r["doc_id"], r[REASON]) for r in rejected.collect()) == [("1", "no_revision"), ("4", "null_text")]
    d = {r["doc_id"]: r for r in ok.collect()}["2"]
    assert d["metadata"]["ref_doc_id"] == "2" and d["metadata"]["title"] == "Two revisions"
    assert "comment" in d["excluded_embed_keys"] and "comment" not in d["excluded_llm_keys"]


def test_current_revision_and_namespaces(spark, dump_dir):
    pages = wsrc.read_dump(spark, dump_dir)
    cur = {r["page_id"]: r["revision_id"] for r in wk.current_revisions(pages).collect()}
    assert cur == {"2": "21", "3": "30", "4": "40"}
    cur = {r["page_id"] for r in wk.current_revisions(pages, namespaces=[1]).collect()}
    assert cur == {"3"}


def test_siteinfo_and_missing_files(spark, dump_dir, tmp_dir):
    info = wsrc.read_siteinfo(spark, dump_dir).filter("dbname = 'testwiki'").collect()
    assert info[0]["sitename"] == "Test Wiki"
    empty = os.path.join(tmp_dir, "nothing")
    os.makedirs(empty)
    with pytest.raises(FileNotFoundError):
        wsrc.read_dump(spark, empty)


def test_dump_round_trip(spark, tmp_dir):
    pages = spark.createDataFrame(
        [(0, 1, "<page><title>A</title><ns>0</ns><id>1</id><revision><id>5</id><text>x</text></revision></page>"),
         (1, 2, "<page><title>B</title><ns>0</ns><id>2</id><revision><id>6</id><text>y</text></revision></page>")],
        "part long, _order long, xml string")
    path = wsrc.write_dump(pages, os.path.join(tmp_dir, "dump"))
    back = wk.flatten_pages(wsrc.read_dump(spark, path, glob="*.txt"))
    assert sorted((r["page_id"], r["text"]) for r in back.collect()) == [("1", "x"), ("2", "y")]
    assert wsrc.read_siteinfo(spark, path, glob="*.txt").count() == 2


def test_gzip_dump_spread(spark, tmp_dir):
    import gzip
    path = os.path.join(tmp_dir, "gz")
    os.makedirs(path)
    with gzip.open(os.path.join(path, "dump.xml.gz"), "wt") as f:
        f.write(DUMP)
    pages = wsrc.read_dump(spark, path, glob="*.xml.gz", spread=4)
    assert pages.rdd.getNumPartitions() == 4
    assert sorted(r["page_id"] for r in wk.flatten_pages(pages).collect()) == ["1", "2", "3", "4"]
