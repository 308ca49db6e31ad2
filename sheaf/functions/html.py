"""what a browser shows of a page, by one pass over its text.

A state machine over the markup: tags with quoted and unquoted attributes, raw
text elements, comments, declarations. What it finds is laid out as
``innerText`` is: white space collapsed in running text and kept in ``pre``,
line breaks between blocks, a blank line around paragraphs, tabs between cells;
scripts, styles, templates and hidden elements are left out. Anchors and the
base address are collected on the way. Values go through slices of Arrow
batches; a page is read once for title, text and links.

Defined cases: NULL gives NULLs; a tag that the page's end cuts off is dropped;
an unclosed script or comment hides the rest; ``<`` before anything but a
letter, ``/``, ``!`` or ``?`` is text; text before ``<body>`` and after
``</body>`` counts as body text, as browsers move it there.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .slices import slices
from .text import join_url

# Element names by how they are read and shown.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"iframe", "noembed", "noframes", "noscript", "script", "style", "textarea", "title", "xmp"}
UNSEEN = {"audio", "canvas", "datalist", "iframe", "noembed", "noframes", "noscript", "object", "script", "select", "style",
          "svg", "template", "textarea", "title", "video"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
          "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html",
          "legend", "li", "listing", "main", "menu", "nav", "ol", "p", "plaintext", "pre", "search", "section", "summary", "table", "ul", "xmp"}
#: A start tag of the second set ends an open element of the first name.
ENDED_BY = {"p": BLOCKS - {"body", "html", "caption", "legend"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
            "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}

SPACE = " \t\n\r\f"
_NAME_END = re.compile(r"[ \t\n\r\f/>]")
_GAP = re.compile(r"[ \t\n\r\f/]*")
_ATTRIBUTE = re.compile(r"[^ \t\n\r\f/>][^ \t\n\r\f/>=]*")
_BLANK = re.compile(r"[ \t\n\r\f]*")
_UNQUOTED = re.compile(r"[^ \t\n\r\f>]*")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def read_tag(text: str, at: int) -> tuple[str, dict[str, str], int]:
    """The tag whose name starts at ``at``: its name, its attributes (the first of each name) and where it ends (-1: nowhere)."""
    end = _NAME_END.search(text, at)
    if end is None:
        return "", {}, -1
    name, at, attributes = text[at:end.start()].lower(), end.start(), {}
    while True:
        at = _GAP.match(text, at).end()
        if at >= len(text):
            return name, attributes, -1
        if text[at] == ">":
            return name, attributes, at + 1
        key = _ATTRIBUTE.match(text, at)
        at = _BLANK.match(text, key.end()).end()
        value = ""
        if text.startswith("=", at):
            at = _BLANK.match(text, at + 1).end()
            quote = text[at: at + 1]
            if quote in ('"', "'") and quote:
                close = text.find(quote, at + 1)
                if close < 0:
                    return name, attributes, -1
                value, at = text[at + 1: close], close + 1
            else:
                found = _UNQUOTED.match(text, at)
                value, at = found.group(), found.end()
        attributes.setdefault(key.group().lower(), value)


def events(text: str):
    """``(kind, name or text, attributes)`` of a page in order; kinds are ``text``, ``raw``, ``start`` and ``end``."""
    at, n = 0, len(text)
    while at < n:
        lt = text.find("<", at)
        if lt < 0:
            lt = n
        # A "<" that opens nothing belongs to the text.
        after = text[lt + 1: lt + 2]
        while lt < n and not (after.isascii() and after.isalpha() or after in ("/", "!", "?") and after):
            lt = text.find("<", lt + 1)
            lt = n if lt < 0 else lt
            after = text[lt + 1: lt + 2]
        if lt > at:
            yield "text", text[at:lt], None
        if lt >= n:
            return
        if after == "!" and text.startswith("--", lt + 2):
            if text.startswith((">", "->"), lt + 4):
                at = text.index(">", lt + 4) + 1
                continue
            ends = [e for e in (text.find("-->", lt + 4), text.find("--!>", lt + 4)) if e >= 0]
            if not ends:
                return
            at = text.index(">", min(ends)) + 1
        elif after in "!?" or after == "/" and not (text[lt + 2: lt + 3].isascii() and text[lt + 2: lt + 3].isalpha()):
            close = text.find(">", lt + 2)
            if close < 0:
                return
            at = close + 1
        elif after == "/":
            name, _, at = read_tag(text, lt + 2)
            if at < 0:
                return
            yield "end", name, None
        else:
            name, attributes, at = read_tag(text, lt + 1)
            if at < 0:
                return
            yield "start", name, attributes
            if name == "plaintext":
                yield "raw", text[at:], None
                return
            if name in RAW:
                close = re.compile(rf"</{name}(?=[ \t\n\r\f/>])", re.I).search(text, at)
                yield "raw", text[at: close.start() if close else n], None
                if close is None:
                    return
                at = close.start()


class Layout:
    """Text as ``innerText`` lays it out: strings, and numbers of required line breaks between them."""

    def __init__(self):
        self.items: list = []
        self.space = False   # a blank is due before the next word
        self.start = True    # at the start of a line

    def lines(self, n: int) -> None:
        self.space, self.start = False, True
        if self.items and isinstance(self.items[-1], int):
            self.items[-1] = max(self.items[-1], n)
        else:
            self.items.append(n)

    def mark(self, text: str) -> None:
        """A break or a tab of its own."""
        self.items.append(text)
        self.space, self.start = False, True

    def text(self, value: str) -> None:
        words = re.split(r"[ \t\n\r\f]+", value)
        if words[0] == "" and len(words) > 1:
            self.space = True
        last = words[-1] == "" and len(words) > 1
        run = " ".join(w for w in words if w)
        if run:
            self.items.append(f" {run}" if self.space and not self.start else run)
            self.space, self.start = last, False

    def kept(self, value: str) -> None:
        if value:
            self.items.append(value.replace("\r\n", "\n"))
            self.space, self.start = False, value.endswith("\n")

    def result(self) -> str:
        items = self.items
        first, last = 0, len(items)
        while first < last and isinstance(items[first], int):
            first += 1
        while last > first and isinstance(items[last - 1], int):
            last -= 1
        return "".join("\n" * i if isinstance(i, int) else i for i in items[first:last])


def read_page(text: str) -> tuple[str, str, str | None, list[str]]:
    """Title, shown text, base address (or None) and anchors' ``href`` values as written."""
    title, base, links, out = None, None, [], Layout()
    hidden, depth = "", 0       # the element that hides what follows, and how often its name is open
    pre, tables = 0, []         # open pre elements; rows and cells of the open tables
    inside = ""                 # the raw text element that is open
    for kind, name, attributes in events(text):
        if kind in ("text", "raw"):
            if kind == "raw" and inside == "title" and title is None:
                title = re.sub(r"[ \t\n\r\f]+", " ", _html.unescape(name)).strip(SPACE)
            if not hidden:
                shown = name if kind == "raw" else _html.unescape(name)
                out.kept(shown) if pre or kind == "raw" else out.text(shown)
            continue
        if kind == "start":
            inside = name if name in RAW else ""
            if hidden:
                if name in ENDED_BY.get(hidden, ()):
                    depth = 0
                elif name == hidden and name not in VOID:
                    depth += 1
                if depth:
                    if name == "a" and hidden != "template" and "href" in attributes:
                        links.append(attributes["href"])
                    continue
                hidden = ""
            if name == "base" and base is None and "href" in attributes:
                base = attributes["href"]
            if name == "a" and "href" in attributes:
                links.append(attributes["href"])
            if name in UNSEEN or "hidden" in attributes or _HIDING.search(attributes.get("style", "")):
                if name in BLOCKS:
                    out.lines(1)
                if name not in VOID:
                    hidden, depth = name, 1
                continue
            if name == "br":
                out.mark("\n")
            elif name == "table":
                out.lines(1)
                tables.append([0, 0])
            elif name == "tr" and tables:
                if tables[-1][0]:
                    out.lines(1)
                tables[-1] = [tables[-1][0] + 1, 0]
            elif name in ("td", "th") and tables:
                if tables[-1][1]:
                    out.mark("\t")
                tables[-1][1] += 1
                out.space, out.start = False, True
            elif name in BLOCKS:
                out.lines(2 if name == "p" else 1)
                pre += name in ("pre", "listing")
        elif hidden:
            if name == hidden:
                depth -= 1
                if not depth:
                    hidden = ""
                    if name in BLOCKS:
                        out.lines(1)
        elif name == "table":
            out.lines(1)
            if tables:
                tables.pop()
        elif name in BLOCKS:
            out.lines(2 if name == "p" else 1)
            if name in ("pre", "listing") and pre:
                pre -= 1
    return title or "", out.result(), base, links


def page_parts(html: Column | str) -> Column:
    """``struct<title, inner_text, base, hrefs>`` of a page's markup."""
    kind = pa.struct([("title", pa.string()), ("inner_text", pa.string()), ("base", pa.string()), ("hrefs", pa.list_(pa.string()))])

    @F.arrow_udf("title string, inner_text string, base string, hrefs array<string>")
    def parts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for (pages,) in slices(batch):
                rows = (None if page is None else read_page(page) for page in pages.to_pylist())
                yield pa.array([None if r is None else dict(zip(("title", "inner_text", "base", "hrefs"), r, strict=True)) for r in rows], kind)

    return parts(F.col(html) if isinstance(html, str) else html)


def page_anchors(url: Column | str, html: Column | str) -> Column:
    """``array<struct<base, href, link>>`` of a page's anchors in document order: the address that they are read against
    (the page's, or its ``<base href>`` joined to it), the reference as written, and the web address that it names
    (or NULL). The page is read and its links are resolved in one pass, and only the anchors leave it."""
    kind = pa.list_(pa.struct([("base", pa.string()), ("href", pa.string()), ("link", pa.string())]))

    def read(url: str | None, page: str | None) -> list[dict] | None:
        if page is None:
            return None
        _, _, base, hrefs = read_page(page)
        base = (join_url(url, _html.unescape(base)) if base is not None else None) or url
        return [{"base": base, "href": h, "link": join_url(base, _html.unescape(h))} for h in hrefs]

    @F.arrow_udf("array<struct<base string, href string, link string>>")
    def anchors(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            for urls, pages in slices(*batch):
                yield pa.array([read(*row) for row in zip(urls.to_pylist(), pages.to_pylist(), strict=True)], kind)

    return anchors(F.col(url) if isinstance(url, str) else url, F.col(html) if isinstance(html, str) else html)
