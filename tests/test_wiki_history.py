"""Dumps with whole page histories: headers carried over splits, first and current revisions."""

from __future__ import annotations

import os

import pytest

from sheaf.operators import wiki as wk
from sheaf.sources import wiki as wsrc
from sheaf.sources import wiki_history as wh
from tests.conftest import rows

HEAD = '<mediawiki xmlns="http://www.mediawiki.org/xml/export-%s/" version="0.11">\n<siteinfo><sitename>%s</sitename><dbname/></siteinfo>\n'


def _revision(page, n, stamp, text):
    return (f"<revision><id>{page * 1000 + n}</id><timestamp>{stamp}</timestamp><contributor><username>u{n}</username><id>{n}</id></contributor>"
            f"<comment/><model>wikitext</model><text>{text}</text><sha1>s{n}</sha1></revision>\n")


def _page(page, revisions):
    # Timestamps fall and rise again, so the newest revision is neither the first nor the last one.
    stamps = [f"20{10 + (n * 7) % 11:02d}-01-01T00:00:{n % 60:02d}Z" for n in range(revisions)]
    body = "".join(_revision(page, n, s, f"page {page} version {n} &lt;b&gt; " + "word " * (page % 5) * 8) for n, s in enumerate(stamps))
    return f"<page><title>T &amp; {page}</title><ns>{page % 3}</ns><id>{page}</id>\n{body}</page>\n", stamps


@pytest.fixture
def dump(tmp_dir):
    counts = {1: 3, 2: 0, 3: 1, 4: 120, 5: 0, 6: 0, 7: 11, 8: 2}
    pages = {p: _page(p, n) for p, n in counts.items()}
    with open(os.path.join(tmp_dir, "full.xml"), "w") as f:
        f.write(HEAD % ("0.11", "Full") + "".join(x for x, _ in pages.values()) + "<page><title>Last</title><ns>0</ns><id>9</id></page></mediawiki>")
    with open(os.path.join(tmp_dir, "old.xml"), "w") as f:
        f.write(HEAD % ("0.10", "Old") + pages[1][0] + "</mediawiki>")
    return tmp_dir, counts, pages


def _choice(stamps, which):
    if not stamps:
        return None
    return 0 if which == "first" else max(range(len(stamps)), key=lambda n: (stamps[n], n))


@pytest.mark.parametrize("split", [None, 700, 3_000])
@pytest.mark.parametrize("which", ["first", "current"])
def test_revisions_find_their_pages_over_splits(spark, dump, split, which):
    path, counts, pages = dump
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        staged = wh.stage_dump(spark, path)
        if split:
            assert staged.select("file", "block").distinct().count() > 5  # one page's history over many blocks
        flat = {r["page_id"]: r for r in wk.flatten_pages(wh.history_pages(staged, which)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert set(flat) == {*map(str, counts), "9"}
    for page, (_, stamps) in pages.items():
        r, n = flat[str(page)], _choice(stamps, which)
        assert r["title"] == f"T & {page}" and r["namespace"] == str(page % 3) and r["raw_xml"] is None
        if n is None:
            assert not r["has_revision"]
        else:
            assert r["revision_id"] == str(page * 1000 + n) and r["timestamp"] == stamps[n] and r["contributor_username"] == f"u{n}"
            assert r["text"].startswith(f"page {page} version {n} <b> ") and r["comment"] is None


def test_same_as_the_page_reader(spark, dump):
    path = dump[0]
    pages = wk.flatten_pages(wsrc.read_dump(spark, path)).drop("raw_xml", "file")
    history = wk.flatten_pages(wh.history_pages(wh.stage_dump(spark, path))).drop("raw_xml", "file")
    columns = sorted(pages.columns)
    key = lambda r: repr(r)
    assert sorted(map(tuple, history.select(columns).collect()), key=key) == sorted(map(tuple, pages.select(columns).collect()), key=key)
    current = {r["page_id"]: r["revision_id"] for r in wk.current_revisions(wsrc.read_dump(spark, path)).collect()}
    newest = {r["page_id"]: r["revision_id"] for r in wk.current_revisions(wh.history_pages(wh.stage_dump(spark, path), "current")).collect()}
    assert newest == current


def test_site_information_and_malformed_pieces(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "d.xml"), "w") as f:
        f.write(HEAD % ("0.11", "W") + "<page><title>Torn</title><ns>0</ns><id</page><page><title>Good</title><ns>0</ns><id>1</id>"
                + _revision(1, 0, "2024", "ok") + "<revision><id>5</id><text>never <closed</text></revision></page>"
                + "<page><title>Fine</title><ns>0</ns><id>2</id>" + _revision(2, 0, "2024", "fine") + "</page></mediawiki>")
    staged = wh.stage_dump(spark, tmp_dir)
    assert rows(wh.history_siteinfo(staged), "sitename", "dbname") == [("W", None)]
    flat = wk.flatten_pages(wh.history_pages(staged))
    reasons = {r["title"]: r["reason"] for r in wk.page_rejects(flat).collect()}
    assert reasons.pop("Good") == "bad_xml" and list(reasons.values()) == ["bad_xml"]
    assert [r["text"] for r in flat.collect() if r["raw_xml"] is None] == ["fine"]
    with pytest.raises(FileNotFoundError):
        wh.stage_dump(spark, tmp_dir, glob="*.none")
    with pytest.raises(ValueError):
        wh.history_pages(staged, "last")
