"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads whole test tables through the views of ``adapters.py``;
the matching DuckDB SQL lives in ``oracle.py`` under the same name, with the
same column names.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import epoch_seconds, period_threshold
from ..operators import digest as dg
from ..operators import documents as dc
from ..operators import load as ld
from ..operators import models as md
from ..operators import neighbours as nb
from ..operators import registry as rg
from ..operators import search as vs
from ..operators import summaries as sm
from ..operators import web as wb
from ..operators import wiki as wk
from ..quality import split_valid
from ..session import default_parallelism, scratch_path
from ..sources import points as pts_src
from ..sources import staging as stg
from ..sources import wiki as wsrc
from ..sources import wiki_history as whist
from ..sources import xmlsplit as xsplit
from ..sources.tables import read_table
from ..streaming import digest as st_digest
from ..streaming import ingest as st_ingest
from ..streaming import intake as st_intake
from ..streaming import windows as st_windows
from . import adapters as ad

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _latest_event_time(spark: SparkSession, sf_dir: str) -> datetime:
    """``as_of`` of the digests: the newest event (one scalar via the driver)."""
    latest = read_table(spark, sf_dir, "events", ["ts"]).agg(F.max("ts")).first()[0]
    return latest.replace(tzinfo=timezone.utc)


# --- stored summaries --------------------------------------------------------

@register("summaries_by_date")
def q_summaries_by_date(spark, sf_dir):
    return sm.summaries_by_date(ad.points(spark, sf_dir))


@register("summaries_latest")
def q_summaries_latest(spark, sf_dir):
    return sm.summaries_latest(ad.points(spark, sf_dir))


@register("summaries_of_date")
def q_summaries_of_date(spark, sf_dir):
    """W8 + P16 + W15: a single request for one collection and date."""
    return sm.fetch_summaries_by_date(ad.points(spark, sf_dir), "c1", "p2", date="2024-01-15")


@register("summaries_range")
def q_summaries_range(spark, sf_dir):
    pts = ad.points(spark, sf_dir)
    requests = ad.digest_requests(pts).select("community_id", "platform_id").distinct() \
        .withColumn("start_date", F.lit("2023-12-31")).withColumn("end_date", F.lit("2024-2-1"))
    return sm.summaries_range(pts, requests)


@register("summaries_payload")
def q_summaries_payload(spark, sf_dir):
    pts = ad.points(spark, sf_dir).select(*sm.POINT_COLUMNS)
    return _payload_as_text(sm.summaries_payload(pts))


def _payload_as_text(df):
    return df.withColumn("parsed_content", F.to_json("parsed_content"))


@register("summaries_range_payload")
def q_summaries_range_payload(spark, sf_dir):
    pts = ad.monthly_points(spark, sf_dir)
    requests = ad.digest_requests(pts).select("community_id", "platform_id").distinct() \
        .withColumn("start_date", F.lit("2023-12-31")).withColumn("end_date", F.lit("2024-2-1"))
    return _payload_as_text(sm.summaries_range(pts, requests, extract_text_only=False))


@register("summary_limits")
def q_summary_limits(spark, sf_dir):
    return sm.limit_report(ad.monthly_points(spark, sf_dir), ["collection", "date"], sm.SUMMARY_LIMIT)


@register("summaries_for_requests")
def q_summaries_for_requests(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations", ["conv_id"]).distinct()
    cid = F.col("conv_id")
    requests = conv.select(
        cid.alias("request_id"),
        F.concat(F.lit("c"), (cid % 5).cast("string")).alias("community_id"),
        F.when(cid % 13 == 0, F.lit("")).otherwise(F.concat(F.lit("p"), (cid % 4).cast("string")))
        .alias("platform_id"),
        F.concat(F.lit("2024-01-"), F.lpad((cid % 31 + 1).cast("string"), 2, "0")).alias("date"),
    )
    return sm.summaries_for_requests(ad.points(spark, sf_dir), requests)


# --- real-time digest -----------------------------------------------------------

def _digest(spark, sf_dir, period: str):
    pts = ad.points(spark, sf_dir)
    as_of = _latest_event_time(spark, sf_dir)
    threshold = epoch_seconds(period_threshold(period, as_of))
    return dg.digest_text(pts, ad.digest_requests(pts), threshold)


@register("digest_text")
def q_digest_text(spark, sf_dir):
    return _digest(spark, sf_dir, "72h")


@register("digest_since_date")
def q_digest_since_date(spark, sf_dir):
    return _digest(spark, sf_dir, "2024-01-20")


@register("digest_requests")
def q_digest_requests(spark, sf_dir):
    pts = ad.points(spark, sf_dir)
    return dg.digest_requests(pts, ad.period_requests(pts), _latest_event_time(spark, sf_dir))


@register("digest_periods")
def q_digest_periods(spark, sf_dir):
    """Up to a thousand distinct periods on one collection."""
    return dg.digest_requests(ad.points(spark, sf_dir), ad.hourly_requests(spark, sf_dir), _latest_event_time(spark, sf_dir))


@register("digest_limits")
def q_digest_limits(spark, sf_dir):
    return dg.digest_dropped(ad.points(spark, sf_dir), epoch_seconds(period_threshold("2024-01-01")))


@register("digest_prompt")
def q_digest_prompt(spark, sf_dir):
    return dg.digest_prompt(_digest(spark, sf_dir, "72h"))


# --- platform registry -----------------------------------------------------------

def _joined(arr, sep: str):
    return F.array_join(F.col(arr).cast("array<string>"), sep)


@register("wiki_jobs")
def q_wiki_jobs(spark, sf_dir):
    modules, platforms = ad.registry(spark, sf_dir)
    return rg.wiki_jobs(modules, platforms).select(
        "community_id", "platform_id", F.col("position").cast("bigint").alias("position"),
        _joined("namespaces", ",").alias("namespaces"), "base_url")


@register("site_jobs")
def q_site_jobs(spark, sf_dir):
    modules, platforms = ad.registry(spark, sf_dir)
    return rg.site_jobs(modules, platforms).select(
        "community_id", "platform_id", F.col("position").cast("bigint").alias("position"),
        _joined("urls", " ").alias("urls"))


@register("job_rejects")
def q_job_rejects(spark, sf_dir):
    modules, platforms = ad.registry(spark, sf_dir)
    return rg.job_rejects(modules, platforms)


@register("platform_rejects")
def q_platform_rejects(spark, sf_dir):
    modules, platforms = ad.registry(spark, sf_dir)
    return rg.job_rejects(modules, platforms, keys=["community_id", "platform_id"])


@register("wiki_job_of_platform")
def q_wiki_job_of_platform(spark, sf_dir):
    """The job of one platform (a single-platform request)."""
    modules, platforms = ad.registry(spark, sf_dir)
    return rg.wiki_jobs(modules, platforms, platform_id="pf3").select("community_id", "platform_id", "base_url")


# --- website ----------------------------------------------------------------------

@register("crawled_pages")
def q_crawled_pages(spark, sf_dir):
    return wb.crawled_pages(read_table(spark, sf_dir, "pages", ["url", "html"]))


@register("web_documents")
def q_web_documents(spark, sf_dir):
    docs = wb.page_documents(wb.crawled_pages(read_table(spark, sf_dir, "pages", ["url", "html"])))
    return docs.select("doc_id", "text", F.col("metadata")["title"].alias("meta_title"),
                       F.col("metadata")["url"].alias("meta_url"))


@register("web_links")
def q_web_links(spark, sf_dir):
    return wb.page_links(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))


@register("sitemap_links")
def q_sitemap_links(spark, sf_dir):
    return wb.sitemap_links(ad.sitemaps(spark, sf_dir))


@register("seed_check")
def q_seed_check(spark, sf_dir):
    modules, platforms = ad.registry(spark, sf_dir)
    return wb.check_seeds(rg.site_jobs(modules, platforms))


def _frontier(spark, sf_dir):
    seeds, edges = ad.link_graph(spark, sf_dir)
    return wb.crawl_frontier(seeds, edges, budget=wb.PAGES_PER_SEED)


@register("crawl_frontier")
def q_crawl_frontier(spark, sf_dir):
    return _frontier(spark, sf_dir).withColumn("depth", F.col("depth").cast("bigint"))


@register("crawl_union")
def q_crawl_union(spark, sf_dir):
    return wb.crawl_union(_frontier(spark, sf_dir)).withColumn("min_depth", F.col("min_depth").cast("bigint"))


@register("website_load")
def q_website_load(spark, sf_dir):
    """The website pipeline: jobs, seeds, frontier, pages, documents, collection."""
    docs = wb.website_documents(*ad.site_jobs(spark, sf_dir))
    return _stored_chunks(spark, ld.load_documents(docs, scratch_path(spark, "web-points"), sequence="sequence"))


def _stored_chunks(spark, path):
    return ld.read_collection(spark, path).select("collection", "doc_id", "chunk_no", "n_tokens", "chunk_text")


# --- MediaWiki -----------------------------------------------------------------------

def _wiki_flat(spark, sf_dir, full=False):
    return wk.flatten_pages(wsrc.parse_pages(ad.wiki_xml(spark, sf_dir, full)))


def _doc_columns(docs):
    return docs.select("doc_id", "text", *[F.col("metadata")[k].alias(k) for k in wk.METADATA_KEYS])


@register("wiki_documents")
def q_wiki_documents(spark, sf_dir):
    docs = wk.page_documents(_wiki_flat(spark, sf_dir))
    ok, _ = split_valid(docs, barrier=True)
    return _doc_columns(ok)


@register("wiki_current")
def q_wiki_current(spark, sf_dir):
    pages = wsrc.parse_pages(ad.wiki_xml(spark, sf_dir))
    return wk.current_revisions(pages, namespaces=[0, 2])


@register("wiki_current_documents")
def q_wiki_current_documents(spark, sf_dir):
    pages = wk.current_pages(wsrc.parse_pages(ad.wiki_xml(spark, sf_dir)), namespaces=[0, 2])
    ok, _ = split_valid(wk.page_documents(wk.flatten_pages(pages)), barrier=True)
    return _doc_columns(ok)


@register("wiki_rejects")
def q_wiki_rejects(spark, sf_dir):
    return wk.page_rejects(_wiki_flat(spark, sf_dir), keep=["doc_id"]).select("doc_id", "reason", "raw_xml")


def _wiki_job_flat(spark, sf_dir):
    modules, platforms = ad.registry(spark, sf_dir)
    jobs = rg.wiki_jobs(modules, platforms)
    return wk.job_pages(jobs, ad.wiki_xml(spark, sf_dir))


@register("wiki_job_pages")
def q_wiki_job_pages(spark, sf_dir):
    return _wiki_job_flat(spark, sf_dir).select("community_id", "platform_id", "page_id", "namespace")


@register("job_counts")
def q_job_counts(spark, sf_dir):
    return wk.job_counts(_wiki_job_flat(spark, sf_dir))


def _dump(spark, sf_dir):
    path = scratch_path(spark, "wiki-dump")
    pages = ad.wiki_xml(spark, sf_dir).select(
        F.floor(F.col("doc_id") / ad.DUMP_WIDTH).alias("part"), F.col("doc_id").alias("_order"), "xml")
    return wsrc.write_dump(pages, path)


@register("wiki_dump_pages")
def q_wiki_dump_pages(spark, sf_dir):
    pages = wsrc.read_dump(spark, _dump(spark, sf_dir), glob="*.txt")
    ok, _ = split_valid(wk.page_documents(wk.flatten_pages(pages)), barrier=True)
    return _doc_columns(ok)


@register("wiki_siteinfo")
def q_wiki_siteinfo(spark, sf_dir):
    return wsrc.read_siteinfo(spark, _dump(spark, sf_dir), glob="*.txt").drop("file")


def _history(spark, sf_dir):
    return whist.stage_dump(spark, _dump(spark, sf_dir), glob="*.txt")


@register("wiki_history_first")
def q_wiki_history_first(spark, sf_dir):
    """S3 + P7: the dump read revision by revision; the first one stands for its page."""
    ok, _ = split_valid(wk.page_documents(wk.flatten_pages(whist.history_pages(_history(spark, sf_dir)))), barrier=True)
    return _doc_columns(ok)


@register("wiki_history_current")
def q_wiki_history_current(spark, sf_dir):
    """W10 + W11 on the same reading: the newest revision."""
    pages = wk.current_pages(whist.history_pages(_history(spark, sf_dir), "current"), namespaces=[0, 2])
    ok, _ = split_valid(wk.page_documents(wk.flatten_pages(pages)), barrier=True)
    return _doc_columns(ok)


@register("wiki_history_siteinfo")
def q_wiki_history_siteinfo(spark, sf_dir):
    return whist.history_siteinfo(_history(spark, sf_dir)).drop("file")


# --- documents and ingestion ---------------------------------------------------------

def _wiki_docs(spark, sf_dir):
    ok, _ = split_valid(wk.page_documents(_wiki_flat(spark, sf_dir, full=True), keep=["community_id", "platform_id"]),
                        barrier=True)
    return ok


@register("embed_view")
def q_embed_view(spark, sf_dir):
    d = _wiki_docs(spark, sf_dir)
    return d.select("doc_id", dc.content_for("metadata", "excluded_embed_keys", "text").alias("embed_text"))


@register("llm_view")
def q_llm_view(spark, sf_dir):
    d = _wiki_docs(spark, sf_dir)
    return d.select("doc_id", dc.content_for("metadata", "excluded_llm_keys", "text").alias("llm_text"))


@register("single_documents")
def q_single_documents(spark, sf_dir):
    d = dc.request_documents(ad.single_requests(spark, sf_dir))
    return d.select("collection", "doc_id", "text", F.col("metadata")["role"].alias("role"),
                    F.array_join("excluded_embed_keys", ",").alias("excluded_embed"),
                    F.array_join("excluded_llm_keys", ",").alias("excluded_llm"))


@register("request_documents")
def q_request_documents(spark, sf_dir):
    d = dc.batch_documents(ad.batch_requests(spark, sf_dir))
    return d.select("request_id", "collection", "doc_id", "text", F.col("metadata")["role"].alias("role"),
                    F.col("position").cast("bigint").alias("position"), "batch_id")


@register("ingest_batches")
def q_ingest_batches(spark, sf_dir):
    d = dc.batch_documents(ad.batch_requests(spark, sf_dir))
    return d.groupBy("request_id", "batch_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_docs"))


@register("request_load")
def q_request_load(spark, sf_dir):
    """Batch ingestion: requests, documents, collection."""
    docs = dc.batch_documents(ad.batch_requests(spark, sf_dir))
    return _stored_chunks(spark, ld.load_documents(docs, scratch_path(spark, "request-points")))


@register("chunks")
def q_chunks(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return dc.chunk_documents(docs)


@register("upsert")
def q_upsert(spark, sf_dir):
    existing, incoming = ad.document_versions(spark, sf_dir)
    return dc.upsert(existing, incoming)


# --- staging, load, models, search ---------------------------------------------------

@register("staged_documents")
def q_staged_documents(spark, sf_dir):
    docs = _wiki_docs(spark, sf_dir).drop("platform_id")
    key = stg.store_transformed(docs, scratch_path(spark, "staging"))
    return _doc_columns(stg.read_staged(spark, key))


def _wiki_collection_docs(spark, sf_dir):
    return _wiki_docs(spark, sf_dir).withColumn(
        "collection", F.concat("community_id", F.lit("_"), "platform_id"))


@register("load_collection")
def q_load_collection(spark, sf_dir):
    path = ld.load_documents(_wiki_collection_docs(spark, sf_dir), scratch_path(spark, "points"))
    return ld.read_collection(spark, path).select(
        "collection", "doc_id", "chunk_no", "n_tokens", F.size("embedding").cast("bigint").alias("dim"))


@register("embed_default")
def q_embed_default(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    vec = md.embed(dc.chunk_documents(docs), text="chunk_text")
    return vec.select("doc_id", "chunk_no", F.size("embedding").cast("bigint").alias("dim"),
                      F.round(md.vector_norm("embedding"), 6).alias("norm"))


@register("vector_topk")
def q_vector_topk(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    return vs.vector_search(emb, ad.QUERY_VECTOR, 10, "vec_id", keys=["label"]) \
        .select("label", "rank", "vec_id", "score")


@register("vector_topk_requests")
def q_vector_topk_requests(spark, sf_dir):
    """L4 for many queries: the ten nearest of every 20th vector among all vectors."""
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    return nb.nearest(emb, F.col("vec_id") % 20 == 0, 10)


@register("extractive_summary")
def q_extractive_summary(spark, sf_dir):
    pts = ad.points(spark, sf_dir)
    threshold = epoch_seconds(period_threshold("72h", _latest_event_time(spark, sf_dir)))
    lines = dg.digest_lines(dg.recent_points(pts, threshold))
    return md.summarize(lines)


@register("extractive_sentences")
def q_extractive_sentences(spark, sf_dir):
    """The three most central sentences of every document."""
    return md.extractive_sentences(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@register("xml_level_split")
def q_xml_level_split(spark, sf_dir):
    nodes = xsplit.split_xml(ad.xml_documents(spark, sf_dir), level=2)
    return nodes.select("doc_id", F.col("node_no").cast("bigint").alias("node_no"), "content")


# --- streaming --------------------------------------------------------------------

@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    src, sink, ck = (scratch_path(spark, n) for n in ("requests", "ingested", "ingest-ck"))
    # Request files written with the input's own partitioning (no funnel into a few tasks).
    ad.single_requests(spark, sf_dir).write.parquet(src)
    st_ingest.start_ingest(spark, src, sink, ck).awaitTermination()
    d = st_ingest.latest_documents(spark, sink)
    return d.select("collection", "doc_id", "text", F.col("metadata")["role"].alias("role"),
                    F.array_join("excluded_embed_keys", ",").alias("excluded_embed"),
                    F.array_join("excluded_llm_keys", ",").alias("excluded_llm"))


@register("stream_load")
def q_stream_load(spark, sf_dir):
    """Continuous ingestion into the collections: each micro-batch is an upsert."""
    src, store, ck = (scratch_path(spark, n) for n in ("load-requests", "stream-points", "load-ck"))
    ad.single_requests(spark, sf_dir).write.parquet(src)
    st_ingest.start_load(spark, src, store, ck).awaitTermination()
    return _stored_chunks(spark, store)


@register("stream_digest")
def q_stream_digest(spark, sf_dir):
    src, sink, ck = (scratch_path(spark, n) for n in ("points", "windows", "windows-ck"))
    ad.points(spark, sf_dir).select("collection", "point_id", "ts").write.parquet(src)
    st_digest.start_digest_windows(spark, src, sink, ck,
                                   schema="collection string, point_id bigint, ts timestamp_ntz",
                                   state_partitions=default_parallelism(spark)).awaitTermination()
    return st_digest.latest_window_counts(spark, sink)


@register("stream_digest_texts")
def q_stream_digest_texts(spark, sf_dir):
    """ST2: digest texts of sliding windows from keyed state."""
    src, sink, ck = (scratch_path(spark, n) for n in ("points", "digests", "digests-ck"))
    ad.points(spark, sf_dir).select("collection", "point_id", "ts", "_node_content").write.parquet(src)
    st_windows.start_window_digests(spark, src, sink, ck, "collection string, point_id bigint, ts timestamp_ntz, _node_content string",
                                    state_partitions=default_parallelism(spark), window_size="2 days", slide="1 day").awaitTermination()
    return st_windows.latest_window_digests(spark, sink)


def _request_lines(spark, sf_dir):
    src = scratch_path(spark, "request-lines")
    ad.request_lines(spark, sf_dir).select("value").write.text(src)
    return src


@register("stream_rejects")
def q_stream_rejects(spark, sf_dir):
    """ST1: request lines that aren't requests, with their reasons."""
    sink, ck = (scratch_path(spark, n) for n in ("dead", "dead-ck"))
    st_intake.start_dead_letters(spark, _request_lines(spark, sf_dir), sink, ck).awaitTermination()
    return spark.read.parquet(sink).select("value", "reason")


@register("stream_intake")
def q_stream_intake(spark, sf_dir):
    """ST1 + X3: the lines that are requests, into the collections."""
    store, ck = (scratch_path(spark, n) for n in ("intake", "intake-ck"))
    st_intake.start_intake(spark, _request_lines(spark, sf_dir), store, ck).awaitTermination()
    return _stored_chunks(spark, store)


@register("stored_summaries")
def q_stored_summaries(spark, sf_dir):
    """S12 on the physical point store: points written partitioned by
    collection, read back with pruning/pushdown, summarised per date."""
    path = pts_src.write_points(ad.points(spark, sf_dir), scratch_path(spark, "point-store"))
    return sm.summaries_by_date(pts_src.read_points(spark, path))


@register("stored_requests")
def q_stored_requests(spark, sf_dir):
    """S12 + W8 + A1: the workflow's requests on the stored table, pruned by the requests."""
    path = pts_src.write_points(ad.points(spark, sf_dir), scratch_path(spark, "point-store"))
    return sm.stored_requests(pts_src.scan_points(spark, path), ad.summary_workflow_requests(spark, sf_dir))


@register("summaries_nested")
def q_summaries_nested(spark, sf_dir):
    """A4 nested form: per (collection, date) the list of summary records,
    rendered as ``point_id=text`` items joined by ``|`` (NULL text as ``-``)."""
    nested = sm.summaries_nested(sm.summaries_payload(ad.points(spark, sf_dir)))
    item = lambda x: F.concat(x["point_id"].cast("string"), F.lit("="),
                              F.coalesce(x["summary_text"], F.lit("-")))
    return nested.select("collection", "date", F.size("summaries").cast("bigint").alias("n_records"),
                         F.array_join(F.transform("summaries", item), "|").alias("records"))


@register("reload_collection")
def q_reload_collection(spark, sf_dir):
    """K4 + X3: a second load skips unchanged documents, keeps untouched
    ones and re-embeds only changed or new ones (``loaded_by``)."""
    first, second = ad.document_loads(spark, sf_dir)
    store = scratch_path(spark, "points")
    ld.load_documents(first, store, run="1")
    ld.load_documents(second, store, run="2")
    return ld.read_collection(spark, store).select("collection", "doc_id", "chunk_no", "n_tokens", "loaded_by")


def _incremental(spark, sf_dir):
    """A base, a delta that changes, empties and adds documents, and a compaction in between."""
    store = scratch_path(spark, "collections")
    first, second, third = ad.incremental_loads(spark, sf_dir)
    ld.load_documents(first, store, run="1")
    ld.load_documents(second, store, run="2")
    ld.compact(spark, store)
    ld.load_documents(third, store, run="3")
    return store


@register("load_incremental")
def q_load_incremental(spark, sf_dir):
    """K4 + X3: three loads into one store; node ids and chunk texts of what is live."""
    return ld.read_collection(spark, _incremental(spark, sf_dir)).select(
        "collection", "doc_id", "chunk_no", "node_id", "n_tokens", "chunk_text", "loaded_by")


@register("load_states")
def q_load_states(spark, sf_dir):
    """K4: every document ever loaded, also those without a live chunk."""
    return ld.read_documents(spark, _incremental(spark, sf_dir)).select(
        "collection", "doc_id", "state", "content_hash", "loaded_by")


@register("summaries_workflow")
def q_summaries_workflow(spark, sf_dir):
    """The workflow dispatch (date / latest / range) for a table of requests."""
    return sm.summaries_workflow(ad.points(spark, sf_dir), ad.summary_workflow_requests(spark, sf_dir))


@register("staged_extracted")
def q_staged_extracted(spark, sf_dir):
    """K1 + K3 + S9: extracted pages staged per community (the page host),
    then read back by key."""
    from ..functions.text import url_host
    pages = wb.crawled_pages(read_table(spark, sf_dir, "pages", ["url", "html"])) \
        .withColumn("community_id", url_host("url"))
    key = stg.store_extracted(pages, scratch_path(spark, "extracted"))
    back = stg.read_staged(spark, key, schema="url string, title string, inner_text string, "
                                               "is_sitemap boolean, community_id string")
    return back.select("url", "title", "inner_text", "is_sitemap")


OPERATORS = {
    "summaries_by_date": "S12 P15 N1 L1 F1 F2 F3 A2",
    "summaries_latest": "S12 A1 A2 F7 N1 L1",
    "summaries_range": "J2 A5 W15 W16 F6 F7",
    "summaries_payload": "P14 A4 F1 F2",
    "summaries_nested": "P14 A4",
    "summaries_for_requests": "J5 W15 P16",
    "summaries_workflow": "J2 A1 A5 W15 W16 F6 F7",
    "stored_summaries": "S12 N1 L1",
    "stored_requests": "S12 W8 J2 J5 A1 A5 W15 W16 F6 F7",
    "digest_text": "P17 F5 F8 W9 W14 L2 P19 A3 A8 F4",
    "digest_since_date": "P17 F5 F8 W9 W14 L2 P19 A3 A8",
    "digest_requests": "J5 P17 F5 F8 W9 W14 L2 P19 A3 A8 F4",
    "digest_periods": "J5 F5 F8 W9 W14 L2 P19 A3 A8",
    "digest_limits": "L2",
    "summaries_range_payload": "J2 A5 P14 W15 W16 L1",
    "summary_limits": "L1",
    "digest_prompt": "F17",
    "wiki_jobs": "S1 S2 P1 P2 P3 W1 W3 W4 W5 J1 F9",
    "site_jobs": "S1 S2 P1 P4 W1 W3 J1",
    "job_rejects": "R1 R2",
    "platform_rejects": "R1 R2",
    "wiki_job_of_platform": "W2",
    "summaries_of_date": "W8 W15 P16",
    "crawled_pages": "S7 F13 W12",
    "web_documents": "F13 P9",
    "web_links": "F14",
    "sitemap_links": "S8 A6 F10 W6",
    "seed_check": "W6 W7",
    "crawl_frontier": "J3 L3 U2",
    "crawl_union": "U1",
    "wiki_documents": "S3 P6 P7 P8 W13",
    "wiki_current": "W10 W11",
    "wiki_current_documents": "W10 W11 P8",
    "wiki_rejects": "W13 R1",
    "website_load": "S7 S8 J3 L3 U1 U2 W6 W7 P9 K4",
    "request_load": "S14 P11 P18 B1 K4",
    "stream_load": "ST1 X3 K4",
    "wiki_job_pages": "J4 W10",
    "job_counts": "A7",
    "wiki_dump_pages": "S3 S4",
    "wiki_siteinfo": "S5",
    "wiki_history_first": "S3 S4 P6 P7 P8",
    "wiki_history_current": "S3 W10 W11 P8",
    "wiki_history_siteinfo": "S5",
    "embed_view": "P12 F18",
    "llm_view": "P13 F18",
    "single_documents": "S13 P10 P18 F12",
    "request_documents": "S14 P11 P18",
    "ingest_batches": "B1 N2",
    "chunks": "X1",
    "upsert": "X3",
    "staged_documents": "K2 K3 S9 S10 S11 F16",
    "staged_extracted": "K1 K3 S9",
    "load_collection": "K4 X1 X2",
    "reload_collection": "K4 X3",
    "load_incremental": "K4 X3 X1",
    "load_states": "K4 X3",
    "embed_default": "X2",
    "vector_topk": "L4",
    "vector_topk_requests": "L4",
    "extractive_summary": "X4",
    "extractive_sentences": "X4",
    "xml_level_split": "S6 X5 F11",
    "stream_ingest": "ST1 P10",
    "stream_digest": "ST2",
    "stream_digest_texts": "ST2 W9 W14 L2 P19 A3",
    "stream_rejects": "ST1 R1",
    "stream_intake": "ST1 X3 K4 P10",
}
