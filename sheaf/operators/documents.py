"""The common document table and what happens to it before a load
(P10-P13, P18, F12, F18, B1, N2, X1, X3).

Documents: ``doc_id, text, metadata map<string,string>,
excluded_embed_keys array<string>, excluded_llm_keys array<string>`` plus a
``collection`` column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import ingest_collection

CHUNK_SIZE = 512       # tokens per chunk (the deployment's CHUNK_SIZE)
BATCH_SIZE = 10        # documents per ingestion batch
TOKEN_BREAK = r"[ \t\n\r\f\x0B]+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def default_doc_id(collection, text) -> Column:
    """a repeatable id for a request without one (the reference's
    default is one random id shared by the whole process; not reproduced)."""
    return F.sha2(F.concat_ws("\u0001", _c(collection), _c(text)), 256)


def request_documents(requests: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """S13 + P18 + P10: single ingestion requests → documents (with the columns named in ``keep``)."""
    coll = ingest_collection("communityId", "collectionName", "platformId")
    return requests.select(
        *keep,
        coll.alias("collection"),
        F.coalesce(F.col("docId"), default_doc_id(coll, F.col("text"))).alias("doc_id"),
        "text", "metadata",
        F.coalesce("excludedEmbedMetadataKeys", F.array().cast("array<string>")).alias("excluded_embed_keys"),
        F.coalesce("excludedLlmMetadataKeys", F.array().cast("array<string>")).alias("excluded_llm_keys"))


def batch_documents(batches: DataFrame, key: str = "request_id", batch_size: int = BATCH_SIZE) -> DataFrame:
    """S14 + B1 + N2 + P11 + P18: header + document list → one row per
    document with its position and ``batch_id = position div batch_size``."""
    coll = ingest_collection("communityId", "collectionName", "platformId")
    return (batches.select(key, coll.alias("collection"),
                           F.posexplode("document").alias("position", "d"))
            .select(key, "collection", "position",
                    F.floor(F.col("position") / batch_size).cast("bigint").alias("batch_id"),
                    F.col("d.docId").alias("doc_id"), F.col("d.text").alias("text"),
                    F.col("d.metadata").alias("metadata"),
                    F.coalesce("d.excludedEmbedMetadataKeys", F.array().cast("array<string>"))
                    .alias("excluded_embed_keys"),
                    F.coalesce("d.excludedLlmMetadataKeys", F.array().cast("array<string>"))
                    .alias("excluded_llm_keys")))


def visible_metadata(metadata, excluded) -> Column:
    """Metadata without the excluded keys."""
    ex = F.coalesce(_c(excluded), F.array().cast("array<string>"))
    return F.map_filter(_c(metadata), lambda k, v: ~F.array_contains(ex, k))


def render_metadata(metadata) -> Column:
    """``key: value`` lines sorted by key; NULL values left out."""
    m = F.map_filter(_c(metadata), lambda k, v: v.isNotNull())
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)),
                                    lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def content_for(metadata, excluded, text) -> Column:
    """Text as seen by the embedding or the LLM: rendered visible metadata,
    a blank line, then the text (just the text when no metadata is visible)."""
    meta = F.nullif(render_metadata(visible_metadata(metadata, excluded)), F.lit(""))
    return F.concat_ws("\n\n", meta, _c(text))


def tokens(text) -> Column:
    """Whitespace tokens (an empty or blank text has none)."""
    t = F.trim(F.regexp_replace(_c(text), TOKEN_BREAK, " "))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " "))


def chunk_documents(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text",
                    size: int = CHUNK_SIZE) -> DataFrame:
    """Windows of ``size`` whitespace tokens; rows ``keys…, chunk_no,
    n_tokens, chunk_text``. Pure expressions, no Python; a document without
    tokens yields no chunk.

    The chunk strings are built inside one row (``transform`` over the chunk
    starts, each slicing ``size`` tokens) and only the finished chunks are
    exploded, so the work is linear in the text length even for a document
    of millions of words (the token array is never copied into every chunk
    row).
    """
    n = F.size("_tok")
    chunks = F.when(n > 0, F.transform(
        F.sequence(F.lit(0), F.ceil(n / F.lit(size)).cast("int") - 1),
        lambda i: F.struct(F.array_join(F.slice("_tok", i * size + 1, size), " ").alias("chunk_text"),
                           F.least(F.lit(size), n - i * size).cast("bigint").alias("n_tokens"))))
    return (docs.select(*keys, tokens(F.col(text)).alias("_tok"))
            .select(*keys, F.posexplode(chunks).alias("chunk_no", "_c"))
            .select(*keys, F.col("chunk_no").cast("bigint").alias("chunk_no"),
                    F.col("_c.n_tokens").alias("n_tokens"), F.col("_c.chunk_text").alias("chunk_text")))


def content_hash(text, metadata=None) -> Column:
    """Hash of what a load would store (text, and rendered metadata if given)."""
    parts = [_c(text)] if metadata is None else [_c(text), render_metadata(metadata)]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = ("collection", "doc_id"),
           version: str = "version", hash_col: str = "content_hash", exact_versions: bool = True) -> DataFrame:
    """New state of a keyed store after applying ``incoming``.

    Both inputs carry ``keys…, version, content_hash`` and any payload
    columns. Per key the newest version wins; when its content equals the
    stored content nothing changes (``unchanged``, stored version kept).
    One aggregation with map-side partial ``min_by``/``max_by`` — a hot key
    is pre-aggregated before the shuffle, so no group is ever collected.
    Rows: the stored columns plus ``action`` (keep, insert, update, unchanged).

    ``exact_versions`` (the default) applies several incoming versions of one
    key in order, as a store would one at a time: the content is the newest, and the
    version is the first one of the trailing run of identical content (the
    stored version when that run reaches back to it). See ``_upsert_exact``.
    """
    if exact_versions:
        return _upsert_exact(existing, incoming, list(keys), version, hash_col)
    keys = list(keys)
    payload = [c for c in existing.columns if c not in keys]
    rec = F.struct(*[F.col(c) for c in payload])
    both = (existing.withColumn("_side", F.lit(0))
            .unionByName(incoming.select(*keys, *payload).withColumn("_side", F.lit(1))))
    g = both.groupBy(*keys).agg(
        F.min_by(rec, F.struct("_side", version)).alias("_first"),
        F.max_by(rec, F.struct("_side", version)).alias("_last"),
        F.max("_side").alias("_has_new"), F.min("_side").alias("_min_side"))
    same = F.col(f"_first.{hash_col}") == F.col(f"_last.{hash_col}")
    action = (F.when(F.col("_has_new") == 0, F.lit("keep"))
              .when(F.col("_min_side") == 1, F.lit("insert"))
              .when(same, F.lit("unchanged"))
              .otherwise(F.lit("update")))
    chosen = F.when(action.isin("keep", "unchanged"), F.col("_first")).otherwise(F.col("_last"))
    return g.select(*keys, chosen.alias("_r"), action.alias("action")) \
        .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in payload], "action")


def _upsert_exact(existing: DataFrame, incoming: DataFrame, keys: list[str], version: str,
                  hash_col: str) -> DataFrame:
    """Sequential upsert semantics behind one shuffle by key.

    Per key, over unordered windows (buffered with spill, never sorted by
    version): the newest hash ``_h``, the sides present, and the last position
    whose hash differs from ``_h`` (``_brk``). The first row after ``_brk`` is
    the state that survives; that aggregation needs no further shuffle.
    """
    payload = [c for c in existing.columns if c not in keys]
    pos = F.struct("_side", version)
    own = Window.partitionBy(*keys)
    both = (existing.withColumn("_side", F.lit(0))
            .unionByName(incoming.select(*keys, *payload).withColumn("_side", F.lit(1))))
    tagged = (both.withColumn("_h", F.max_by(hash_col, pos).over(own)).withColumn("_min_side", F.min("_side").over(own))
              .withColumn("_max_side", F.max("_side").over(own)))
    run = (tagged.withColumn("_brk", F.max(F.when(F.col(hash_col) != F.col("_h"), pos)).over(own))
           .filter(F.col("_brk").isNull() | (pos > F.col("_brk"))))
    g = run.groupBy(*keys).agg(F.min_by(F.struct(*payload, "_side"), pos).alias("_r"),
                               F.first("_min_side").alias("_min_side"), F.first("_max_side").alias("_max_side"))
    action = (F.when(F.col("_max_side") == 0, F.lit("keep"))
              .when(F.col("_min_side") == 1, F.lit("insert"))
              .when(F.col("_r._side") == 0, F.lit("unchanged"))
              .otherwise(F.lit("update")))
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in payload], action.alias("action"))
