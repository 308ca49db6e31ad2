"""JSON payload expressions of stored points.

A payload is read as the service reads it: by Python's JSON parser, which takes
repeated keys (the last one counts) and ``NaN``, and nothing after the value.
One Arrow batch call parses a node once; every expression below reads its
fields from that result (equal calls in one projection are one call).
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# These strings must equal the reference's outputs.
SUMMARY_NOT_FOUND = "Summary text not found"
NO_RECENT_DATA = "No recent data found for the specified period."
NO_TEXT_CONTENT = "No text content found in the recent data."


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


PARTS = pa.struct([("kind", pa.string()), ("has_text", pa.bool_()), ("text", pa.string()), ("has_metadata", pa.bool_()), ("author", pa.string())])


def _as_text(value) -> str | None:
    """A JSON value as text: strings as they are (half characters replaced), None as None, others as JSON."""
    if value is None:
        return None
    text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    return text.encode("utf-8", "replace").decode()


def read_node(node: str | None) -> dict | None:
    """What the expressions need of a node; None if it isn't one JSON value."""
    try:
        value = json.loads(node)
    except (TypeError, ValueError, RecursionError):
        return None
    if not isinstance(value, dict):
        return {"kind": "other", "has_text": False, "has_metadata": False}
    metadata = value.get("metadata")
    return {"kind": "object", "has_text": "text" in value, "text": _as_text(value.get("text")), "has_metadata": isinstance(metadata, dict),
            "author": _as_text(metadata.get("author")) if isinstance(metadata, dict) else None}


@F.arrow_udf(T.StructType([T.StructField(f.name, T.BooleanType() if f.type == pa.bool_() else T.StringType()) for f in PARTS]))
def _parts(nodes: pa.Array) -> pa.Array:
    return pa.array([read_node(node) for node in nodes.to_pylist()], PARTS)


@F.arrow_udf(T.StringType())
def _canonical(nodes: pa.Array) -> pa.Array:
    def plain(node):
        try:
            # Numbers that JSON lacks are null; of repeated keys the last one stays.
            return json.dumps(json.loads(node, parse_constant=lambda name: None)).encode("utf-8", "replace").decode()
        except (TypeError, ValueError, RecursionError):
            return None
    return pa.array([plain(node) for node in nodes.to_pylist()], pa.string())


def node_parts(node: Column | str) -> Column:
    """``struct<kind, has_text, text, has_metadata, author>`` of a node; NULL for bad JSON and NULL."""
    return _parts(_c(node))


def is_json(node: Column | str) -> Column:
    """the whole text is one JSON value (bad or NULL input gives False)."""
    return node_parts(node)["kind"].isNotNull()


def parsed_content(node: Column | str) -> Column:
    """The parsed value as a VARIANT (of repeated keys the last; ``NaN`` and infinities as null)."""
    return F.try_parse_json(_canonical(_c(node)))


def summary_text(node: Column | str) -> Column:
    """F2 + P15 on a parsed payload: ``text`` of a JSON object, else the fixed marker.

    Only meaningful where ``is_json`` holds; callers route bad JSON (F3) first.
    """
    parts = node_parts(node)
    return F.when(parts["has_text"], parts["text"]).otherwise(F.lit(SUMMARY_NOT_FOUND))


def digest_line(node: Column | str) -> Column:
    """P19 + W14: ``author: text`` when the node has an author, plain text
    otherwise, NULL when the node carries no text (or is not a JSON object).

    F4: a node without ``metadata`` counts as having no author (the reference
    raises for the whole digest there; documented deviation).
    """
    parts = node_parts(node)
    # A null author counts as none, so that its text isn't lost.
    line = F.when(parts["author"].isNotNull(), F.concat(parts["author"], F.lit(": "), parts["text"])).otherwise(parts["text"])
    return F.when(F.coalesce(parts["has_text"], F.lit(False)), line)


def lacks_metadata(node: Column | str) -> Column:
    """the node has a text but no ``metadata`` object."""
    parts = node_parts(node)
    return F.coalesce(parts["has_text"] & ~parts["has_metadata"], F.lit(False))
