"""Text expressions: whitespace, addresses and links (F10, F14; page markup is in ``html.py``).

Patterns run JVM-side. URL joining follows the standard with its long rules, so
it goes through Arrow batches (a slice of a batch at a time, the standard
library's functions per value).
"""

from __future__ import annotations

import html as _html
from collections.abc import Iterator
from urllib.parse import urldefrag, urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .slices import slices

# Characters Python's str.strip() removes that also count as text breaks here.
WS = r"[ \t\n\r\f\x0B\x{1C}-\x{1F}\x{85}\x{A0}\x{2028}\x{2029}\x{3000}]"

def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(c) -> Column:
    """``str.strip()`` — leading and trailing whitespace, tabs and
    newlines included (Spark's ``trim`` removes spaces only)."""
    c = _c(c)
    return F.regexp_replace(F.regexp_replace(c, f"^{WS}+", ""), f"{WS}+$", "")


def http_url(c) -> Column:
    """Non-empty and starting with ``http://`` or ``https://`` (case sensitive)."""
    c = _c(c)
    return F.coalesce(c.startswith("http://") | c.startswith("https://"), F.lit(False))


def join_url(base: str | None, href: str | None) -> str | None:
    """The web address that ``href`` names on page ``base``, without fragment; None if it names none."""
    href = (href or "").strip()
    if not base or not href or href.startswith("#"):
        return None
    try:
        whole = urlsplit(urldefrag(urljoin(base.strip(), href)).url)
        return whole.geturl() if whole.scheme in ("http", "https") and whole.netloc else None
    except ValueError:  # a malformed host
        return None


def resolve_link(base_url, href) -> Column:
    """Resolve ``href`` (as written in the page) against the page url: white
    space around it cut, character references decoded, dot segments and query
    references resolved, scheme in lower case, fragment cut. Empty,
    fragment-only and other schemes (``mailto:``, ``javascript:``) give NULL.
    """
    @F.arrow_udf("string")
    def resolve(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            for bases, refs in slices(*batch):
                pairs = zip(bases.to_pylist(), refs.to_pylist(), strict=True)
                yield pa.array([join_url(b, None if r is None else _html.unescape(r)) for b, r in pairs], pa.string())
    return resolve(_c(base_url), _c(href))


def page_address(url) -> Column:
    """The address of a page as links give it (no fragment); NULL if it isn't a web address."""
    @F.arrow_udf("string")
    def address(urls: pa.Array) -> pa.Array:
        return pa.array([join_url(u, u) for u in urls.to_pylist()], pa.string())
    return address(_c(url))


def url_host(url) -> Column:
    return F.regexp_extract(_c(url), r"^https?://([^/?#:]+)", 1)


def xml_escape(c) -> Column:
    """Text → XML character data (``&``, ``<``, ``>``)."""
    c = F.replace(_c(c), F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))
