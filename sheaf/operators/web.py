"""Website pipeline.

Fetching pages is network work outside Spark; these operators start from a
table of already collected pages ``(url, html)`` and do everything after the
fetch as Spark jobs: page text, link extraction, sitemap parsing, seed
validation, and the bounded link expansion of a crawl.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.html import page_anchors, page_parts
from ..functions.text import (
    http_url,
    page_address,
    py_strip,
    url_host,
)
from ..quality import REASON, first_reason, keep_rows
from ..session import scratch_path
from .summaries import top_per_key

# The crawl budget per seed url and the sitemap namespace.
PAGES_PER_SEED = 20
SITEMAP_NS = "http://www.sitemaps.org/schemas/sitemap/0.9"


def crawled_pages(pages: DataFrame) -> DataFrame:
    """S7 + F13 + W12: ``url, title, inner_text, is_sitemap`` per page (and its ``page_id``, if it has one)."""
    own = ["page_id"] if "page_id" in pages.columns else []
    return pages.select(*own, "url", page_parts("html").alias("_page")).select(
        *own, "url", F.col("_page.title").alias("title"), F.col("_page.inner_text").alias("inner_text"),
        F.col("url").contains("sitemap.xml").alias("is_sitemap"))


def page_hrefs(pages: DataFrame, *keep: str) -> DataFrame:
    """a row for each anchor with an ``href``, in document order: ``keep``, the ``base`` it is read against
    (the page's address, or its ``<base href>`` joined to it), ``href`` as written and the ``link`` that it names."""
    return pages.select(*keep, F.inline(page_anchors("url", "html")))


def page_documents(crawled: DataFrame, keep: tuple | list = ()) -> DataFrame:
    """``doc_id = url``, the inner text, metadata ``title`` and ``url`` (and the columns named in ``keep``)."""
    return crawled.select(
        *keep,
        F.col("url").alias("doc_id"),
        F.col("inner_text").alias("text"),
        F.create_map(F.lit("title"), F.col("title"), F.lit("url"), F.col("url")).alias("metadata"),
        F.array().cast("array<string>").alias("excluded_embed_keys"),
        F.array().cast("array<string>").alias("excluded_llm_keys"))


def page_links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """resolved outgoing links per page with their multiplicity:
    ``{key}, link, n_refs``."""
    return (page_hrefs(pages, key)
            .filter(F.col("link").isNotNull())
            .groupBy(key, "link").agg(F.count(F.lit(1)).cast("bigint").alias("n_refs")))


def sitemap_links(sitemaps: DataFrame, text: str = "content", key: str = "sitemap_url") -> DataFrame:
    """S8 + F10 + W6 (drop mode) + A6: distinct http(s) ``loc`` values of each
    sitemap ``urlset``, stripped. A sitemap index or another namespace gives
    no links; malformed XML is reported by ``sitemap_rejects``."""
    parsed = sitemaps.select(
        key, F.col(text).contains(SITEMAP_NS).alias("_ns"),
        F.from_xml(F.col(text), schemas.SITEMAP,
                   {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("x"))
    # keep_rows: the test on the parsed struct must not re-run from_xml.
    locs = (keep_rows(parsed, F.col("_ns") & F.col("x._corrupt_record").isNull())
            .select(key, F.explode("x.url").alias("u"))
            .select(key, py_strip(F.col("u.loc")).alias("link")))
    return locs.filter(http_url("link")).dropDuplicates([key, "link"])


def sitemap_rejects(sitemaps: DataFrame, text: str = "content", key: str = "sitemap_url") -> DataFrame:
    """Sitemaps whose XML is malformed (an error for the whole sitemap in the
    reference), as quarantine rows with reason ``invalid_sitemap_xml``."""
    parsed = sitemaps.select(key, F.from_xml(
        F.col(text), schemas.SITEMAP,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("x"))
    return keep_rows(parsed, F.col("x._corrupt_record").isNotNull()) \
        .select(key, F.lit("invalid_sitemap_xml").alias(REASON))


def link_edges(pages: DataFrame, sitemaps: DataFrame | None = None, same_host: bool = True) -> DataFrame:
    """The link graph ``src, dst`` of collected pages (``url, html``) and sitemaps (``sitemap_url, content``).

    Addresses carry no fragment. With ``same_host`` a link counts only if it
    stays on its page's host.
    """
    links = page_hrefs(pages.select("html", "url", F.col("url").alias("page")), "page")
    edges = links.select(page_address("page").alias("src"), F.col("link").alias("dst"))
    if sitemaps is not None:
        listed = sitemap_links(sitemaps)
        edges = edges.unionByName(listed.select(page_address("sitemap_url").alias("src"), page_address("link").alias("dst")))
    edges = edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
    if same_host:
        edges = edges.filter(F.lower(url_host("src")) == F.lower(url_host("dst")))
    return edges.distinct()


def website_documents(jobs: DataFrame, pages: DataFrame, sitemaps: DataFrame | None = None,
                      budget: int = PAGES_PER_SEED) -> DataFrame:
    """The website pipeline up to the load: jobs → seeds → frontier → pages → documents.

    Jobs (``community_id, platform_id, urls``) that :func:`check_seeds` doesn't
    pass are left out. Sitemaps lead to pages but are no documents themselves.
    Rows: the document columns and ``collection`` (``{community}_{platform}``);
    a page reached from several seeds of a job comes once. Pages with a
    ``page_id`` (the order of their capture) keep it as ``sequence``, by which
    a load takes the later of two captures of one address.
    """
    spark = pages.sparkSession
    good = check_seeds(jobs).filter(F.col("status") == "ok").select("community_id", "platform_id")
    seeds = (seed_urls(jobs.join(good, ["community_id", "platform_id"], "left_semi"))
             .withColumn("seed", page_address("seed")).filter(F.col("seed").isNotNull()).distinct())
    path = scratch_path(spark, "seeds")
    seeds.write.parquet(path)  # read twice: for the walk and for the jobs of what it reaches
    seeds = spark.read.parquet(path)
    reached = crawl_frontier(seeds.select("seed").distinct(), link_edges(pages, sitemaps), budget)
    wanted = (reached.join(seeds, "seed").select("community_id", "platform_id", "url").distinct())
    found = crawled_pages(pages.withColumn("url", page_address("url"))).filter(~F.col("is_sitemap"))
    docs = wanted.join(found, "url").withColumn("collection", F.concat_ws("_", "community_id", "platform_id"))
    if "page_id" in docs.columns:
        return page_documents(docs.withColumnRenamed("page_id", "sequence"), keep=["collection", "sequence"])
    return page_documents(docs, keep=["collection"])


def check_seeds(jobs: DataFrame, urls: str = "urls") -> DataFrame:
    """W6 + W7 per website job: counts of seed urls and the job status
    (``no_community``, ``no_urls``, ``invalid_url`` — one bad seed fails the
    whole job as in the reference — or ``ok``)."""
    u = F.coalesce(F.col(urls), F.array().cast("array<string>"))
    n_valid = F.size(F.filter(u, lambda x: http_url(x)))
    status = first_reason([
        (F.coalesce(F.col("community_id"), F.lit("")) == "", "no_community"),
        (F.size(u) == 0, "no_urls"),
        (n_valid < F.size(u), "invalid_url"),
    ])
    return jobs.select("community_id", "platform_id",
                       F.size(u).cast("bigint").alias("n_urls"),
                       n_valid.cast("bigint").alias("n_valid"),
                       F.coalesce(status, F.lit("ok")).alias("status"))


def validate_seeds(urls: list[str]) -> list[str]:
    """W6 for a single crawl call: the seeds, or an error that names those which aren't web addresses."""
    strange = [u for u in urls if not re.match(r"https?://", u if isinstance(u, str) else "")]
    if strange:
        raise ValueError(f"not web addresses: {strange}")
    return list(urls)


def seed_urls(jobs: DataFrame, urls: str = "urls", mode: str = "drop") -> DataFrame:
    """W6 + W7 as rows: one row per seed url of each job (``community_id,
    platform_id, seed``). ``mode="drop"`` leaves invalid urls out (sitemap
    behaviour); ``mode="raise"`` fails when any seed is invalid (the
    reference's behaviour for a crawl call)."""
    seeds = jobs.select("community_id", "platform_id", F.explode(urls).alias("seed"))
    valid = http_url(F.col("seed"))
    if mode == "raise":
        bad = seeds.filter(~valid)
        if not bad.isEmpty():
            raise ValueError(f"not a web address: {bad.first()['seed']}")
        return seeds
    if mode != "drop":
        raise ValueError("mode must be 'drop' or 'raise'")
    return seeds.filter(valid)


def crawl_frontier(seeds: DataFrame, edges: DataFrame, budget: int = PAGES_PER_SEED,
                   max_depth: int | None = None, workdir: str | None = None) -> DataFrame:
    """J3 + L3 + U2: pages reached from each seed, breadth first, without
    revisiting, at most ``budget`` per seed, ranked by (depth, url).

    ``seeds``: ``seed``; ``edges``: ``src, dst``. Each round is one equi join
    of the frontier with the edges and one exchange by seed, where what it
    reaches meets what the seed holds. A round keeps, per seed, only as many
    new pages (by url) as its budget has left: pages beyond that, and whatever
    they lead to, can never rank within the budget. So a round writes at most
    ``budget`` rows per seed and the walk ends by itself; no depth bound is needed.

    The edges are written once, as a table bucketed and sorted by ``src``: a
    round moves its frontier to the buckets and never the edges. The pages that
    a seed holds (``seen``, fewer than ``budget``) go along with its frontier, so
    a round reads the round before it alone and seeds that ended cost nothing.
    Lineage is cut every round by writing the round's new pages as a table
    (``depth=N``) under ``workdir`` (by default a fresh folder inside the shared
    checkpoint folder).
    Rows: ``seed, url, depth``.
    """
    spark = seeds.sparkSession
    base = (workdir or scratch_path(spark, "crawl")).rstrip("/")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"crawl_edges_{uuid.uuid4().hex}"
    (edges.select("src", "dst").repartition(buckets, "src").distinct().write.bucketBy(buckets, "src").sortBy("src")
     .option("path", f"{base}-edges").saveAsTable(table))
    try:
        e = spark.table(table)
        (seeds.select("seed").distinct().select("seed", F.col("seed").alias("url"), F.lit(1).cast("bigint").alias("held"), F.array("seed").alias("seen"))
         .write.parquet(f"{base}/depth=0"))
        depth = 0
        while max_depth is None or depth < max_depth:
            frontier = spark.read.parquet(f"{base}/depth={depth}").filter(F.col("held") < budget)
            depth += 1
            crawl_round(frontier, e, budget).write.parquet(f"{base}/depth={depth}")
            if spark.read.parquet(f"{base}/depth={depth}").isEmpty():
                break
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    visited = spark.read.parquet(base).select("seed", "url", F.col("depth").cast("int").alias("depth"))
    return top_per_key(visited, ["seed"], ["depth", "url"], budget)


def crawl_round(frontier: DataFrame, edges: DataFrame, budget: int) -> DataFrame:
    """``seed, url, held, seen``: the pages that a frontier's links reach for the first time, the first by url within the
    budget; ``held`` pages are then held by the seed, and one of its rows has them as ``seen`` if the budget isn't spent."""
    reached = frontier.join(edges, frontier.url == edges.src).select("seed", F.col("dst").alias("url"), F.lit(1).alias("_new"))
    known = frontier.select("seed", F.explode("seen").alias("url"), F.lit(0).alias("_new"))
    own = Window.partitionBy("seed")
    pages = reached.unionByName(known).repartition("seed").groupBy("seed", "url").agg(F.min("_new").alias("_new"))
    # What the seed holds comes first, so a row's number is what it holds with that page.
    pages = pages.withColumn("held", F.row_number().over(own.orderBy("_new", "url")).cast("bigint")).filter(F.col("held") <= budget)
    pages = pages.withColumn("_held", F.max("held").over(own)).withColumn("_all", F.collect_list("url").over(own))
    seen = F.when((F.col("held") == F.col("_held")) & (F.col("_held") < budget), F.col("_all"))
    return pages.filter(F.col("_new") == 1).select("seed", "url", F.col("_held").alias("held"), seen.alias("seen"))


def crawl_job(spark, urls: list[str], edges: DataFrame, budget: int = PAGES_PER_SEED,
              max_depth: int | None = None) -> DataFrame:
    """One website job: valid seeds (W6, W7), a budget for each (L3), and at least one page."""
    from ..quality import require_rows
    known = validate_seeds(urls)
    if not known:
        raise ValueError("the job has no seeds")
    seeds = spark.createDataFrame([(u,) for u in known], "seed string")
    return require_rows(crawl_frontier(seeds, edges, budget, max_depth), f"the crawl of {known} came back empty")


def crawl_union(frontier: DataFrame) -> DataFrame:
    """All crawls together; a page reached from several seeds occurs once
    per seed and collapses to one document (``doc_id = url``) at load."""
    return frontier.groupBy("url").agg(F.count(F.lit(1)).cast("bigint").alias("n_copies"),
                                       F.min("depth").alias("min_depth"))
