"""Page text, title and links as a browser shows them."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sheaf.functions.html import read_page
from sheaf.operators import web as wb
from tests.conftest import rows


@pytest.mark.parametrize("page, text", [
    ('<a title="a>b" href="/x">t</a>', "t"),
    ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("a <b>b</b>c<i> d</i>", "a bc d"),
    ("<body>seen<script>var t='</p>'; if (a<b) x()", "seen"),
    ("seen<!-- a > b <p>c</p> -->too<!-- open <p>x", "seentoo"),
    ("a<!-->b<!--->c<!-- x --!>d", "abcd"),
    ("<title>T</title>no body element", "no body element"),
    ("<body>in</body>after", "in\nafter"),
    ("one<br>two<br/>three", "one\ntwo\nthree"),
    ("<p>one<p>two</p><div>three</div>four", "one\n\ntwo\n\nthree\nfour"),
    ("<ul><li>a<li>b</ul>", "a\nb"),
    ("<table><tr><th>a<th>b<tr><td>c<td>d</table>", "a\tb\nc\td"),
    ("<pre>  x\n   y </pre>z", "  x\n   y \nz"),
    ("  a \n\t b  <span> c </span>", "a b c"),
    ("<p hidden>no<p>yes", "yes"),
    ("<div style='color:red; Display : none'>a<div>b</div>c</div>d", "d"),
    ("<template>a<template>b</template>c</template>d", "d"),
    ("<noscript>a</noscript><style>p{}</style><select><option>o</select>b", "b"),
    ("<SCRIPT>x</ScRiPt >y", "y"),
    ("<textarea><p>raw</p></textarea>x", "x"),
    ("a &amp;lt; &eacute;&nbsp;b", "a &lt; \u00e9\u00a0b"),
    ("<!DOCTYPE html><?xml x?></ bogus>a</3>b", "ab"),
    ("cut <a href='/x", "cut"), ("cut <", "cut <"), ("cut </", "cut"), ("", ""), ("<div", ""), ("a<!", "a"), ("<p", ""), ("a<b", "a")])
def test_shown_text(page, text):
    assert read_page(page)[1] == text


@pytest.mark.parametrize("page, links, base", [
    ('<a title="a>b" href="/x">t</a><a href=/unq>u</a><a href=/u2/>', ["/x", "/unq", "/u2/"], None),
    ("<a data-href='/no'><abbr href='/no'><a HREF = '/b' href='/second'>", ["/b"], None),
    ("<base target=x><base href='/one/'><base href='/two/'><a href='z'>", ["z"], "/one/"),
    ("<!-- <a href='/c'> --><script>'<a href=/s>'</script><template><a href='/t'></template><div hidden><a href='/h'></div>", ["/h"], None),
    ("<a href><a href=''><a>", ["", ""], None)])
def test_links(page, links, base):
    assert read_page(page)[2:] == (base, links)


def test_title():
    assert read_page("<title> A\n &amp; <b> </title><title>B</title>")[0] == "A & <b>"
    assert read_page("no title")[0] == "" and read_page("<title>open")[0] == "open"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/!-=\"' abp&;\n", max_size=60))
def test_any_markup_is_read_to_its_end(page):
    title, text, base, links = read_page(page)
    assert "<p>" not in text or page.count("<") > 1
    plain = page.replace("<", "")
    if "<" not in page:
        assert read_page(plain)[1].split() == __import__("html").unescape(plain).split()


def test_long_pages_take_linear_time():
    import time
    started = time.time()
    for page in ("<" * 200_000, "<a " + "b='c' " * 50_000, "<a href=\"" + "x" * 1_000_000, "<!--" * 100_000, "<p>x " * 100_000, "<div hidden>" * 50_000):
        read_page(page)
    assert time.time() - started < 20


def test_base_address_and_null_pages(spark):
    page = "<base href='/deep/er/'><a href='x'>1</a><a href='?q=1'>2</a>"
    pages = spark.createDataFrame([(1, "https://e.com/a", page), (2, "https://e.com/b", None)], "page_id long, url string, html string")
    assert rows(wb.page_links(pages), "page_id", "link") == [(1, "https://e.com/deep/er/?q=1"), (1, "https://e.com/deep/er/x")]
    assert rows(wb.crawled_pages(pages), "page_id", "inner_text") == sorted([(1, "12"), (2, None)])


def test_the_later_capture_of_an_address_is_loaded(spark, tmp_dir):
    from sheaf.operators import load as ld
    pages = spark.createDataFrame([(2, "https://h.org/a", "<body>late</body>"), (1, "https://h.org/a#x", "<body>early and longer</body>")],
                                  "page_id long, url string, html string")
    jobs = spark.createDataFrame([("c", "p", ["https://h.org/a"])], "community_id string, platform_id string, urls array<string>")
    store = ld.load_documents(wb.website_documents(jobs, pages), f"{tmp_dir}/s", dim=8, sequence="sequence")
    assert rows(ld.read_collection(spark, store), "doc_id", "chunk_text") == [("https://h.org/a", "late")]
