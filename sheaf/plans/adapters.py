"""Views of the reference's data model derived from the driver's test tables.

The test tables carry none of the reference's schemas, so each view is a
deterministic expression over one of them (the same rule is written as DuckDB
SQL in ``plans/oracle.py``). Every view keeps all rows of its source, so the
work of a query grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import day_string, epoch_seconds_col
from ..sources.tables import read_table


def _s(c: Column) -> Column:
    return c.cast("string")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored points of summary collections, one per event.

    ``collection = c{user_id%5}_p{event_id%3}_summary``; ``_node_content`` is a
    JSON text, deliberately NULL (``event_id%23=0``), broken (``%17``), without
    text (``%19``), a JSON array (``%29``), without metadata (``%31``),
    followed by other text (``%37``), in single quotes (``%41``), with a null
    author (``%43``) or without author (``%10``).
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    eid, uid = F.col("event_id"), F.col("user_id")
    text = F.concat(F.col("event_type"), F.lit(" #"), _s(eid))
    author = F.concat(F.lit("u"), _s(uid))
    node = (F.when(eid % 23 == 0, F.lit(None).cast("string"))
            .when(eid % 17 == 0, F.concat(F.lit('{"text": "'), text))
            .when(eid % 19 == 0, F.concat(F.lit('{"metadata": {"author": "'), author, F.lit('"}}')))
            .when(eid % 29 == 0, F.concat(F.lit('["'), text, F.lit('"]')))
            .when(eid % 31 == 0, F.concat(F.lit('{"text": "'), text, F.lit('"}')))
            .when(eid % 37 == 0, F.concat(F.lit('{"text": "'), text, F.lit('"} xyz')))
            .when(eid % 41 == 0, F.concat(F.lit("{'text': '"), text, F.lit("'}")))
            .when(eid % 43 == 0, F.concat(F.lit('{"text": "'), text, F.lit('", "metadata": {"author": null}}')))
            .when(eid % 10 == 0, F.concat(F.lit('{"text": "'), text, F.lit('", "metadata": {}}')))
            .otherwise(F.concat(F.lit('{"text": "'), text, F.lit('", "metadata": {"author": "'),
                                author, F.lit('"}}'))))
    return ev.select(
        F.concat(F.lit("c"), _s(uid % 5), F.lit("_p"), _s(eid % 3), F.lit("_summary")).alias("collection"),
        eid.alias("point_id"),
        day_string("ts").alias("date"),
        epoch_seconds_col("ts").alias("createdAt"),
        node.alias("_node_content"),
        F.col("ts"),
    )


def digest_requests(points_df: DataFrame) -> DataFrame:
    """Two digest requests per (community, platform) found in ``points``:
    one naming the stored collection explicitly, one by ids only (which
    resolves to ``{community}_{platform}``, a collection without points)."""
    pairs = points_df.select(
        F.regexp_extract("collection", r"^(c\d+)_", 1).alias("community_id"),
        F.regexp_extract("collection", r"^c\d+_(p\d+)_", 1).alias("platform_id"),
        "collection",
    ).distinct()
    return pairs.select(
        F.explode(F.array(
            F.struct(F.concat(F.col("collection"), F.lit("#name")).alias("request_id"),
                     F.col("collection").alias("collection_name"),
                     "community_id", "platform_id"),
            F.struct(F.concat(F.col("collection"), F.lit("#ids")).alias("request_id"),
                     F.lit(None).cast("string").alias("collection_name"),
                     "community_id", "platform_id"),
        )).alias("r")).select("r.*")


PERIODS = [None, "", "1h", "72h", "2024-01-01", "2024-01-20", "2024-13-45", "4 hours"]


def period_requests(points_df: DataFrame) -> DataFrame:
    """Every request of :func:`digest_requests`, once for each of ``PERIODS``."""
    period = F.explode(F.array(*[F.lit(p).cast("string") for p in PERIODS]))
    r = digest_requests(points_df).withColumn("period", period)
    return r.withColumn("request_id", F.concat("request_id", F.lit("#"), F.coalesce("period", F.lit("none"))))


def hourly_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest request per customer: every 20th asks one of the collections, all others one and the same,
    each for ``c_custkey % 1000 + 1`` hours."""
    k = F.col("c_custkey")
    other = F.concat(F.lit("c"), _s(k % 5), F.lit("_p"), _s(k % 3), F.lit("_summary"))
    return read_table(spark, sf_dir, "customer", ["c_custkey"]).select(
        _s(k).alias("request_id"), F.when(k % 20 == 0, other).otherwise(F.lit("c1_p1_summary")).alias("collection_name"),
        F.lit("c").alias("community_id"), F.lit("p").alias("platform_id"), F.concat(_s(k % 1000 + 1), F.lit("h")).alias("period"))


def monthly_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points dated by the first day of their month, so that a date holds more than any limit."""
    return points(spark, sf_dir).withColumn("date", F.concat(F.substring("date", 1, 8), F.lit("01")))


# --- platform registry (from customer) ----------------------------------------

MODULE_WIDTH = 100  # platform entries per module document (bounded nesting)


def _platform_name(k: Column) -> Column:
    return (F.when(k % 3 == 0, F.lit("mediaWiki"))
            .when(k % 3 == 1, F.lit("website"))
            .otherwise(F.lit("discord")))


def registry(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(modules, platforms)``: one platform per customer, named by
    ``c_custkey%3`` (mediaWiki / website / discord), in the community of its
    nation. Module documents group up to ``MODULE_WIDTH`` platforms of one
    community, entries in key order. Corner cases: ``activated`` missing
    (``%17=0``), false (``%4=0``); platform document missing (``%11=0``);
    baseURL NULL (``%7=0``); path NULL (``%13=0``); no namespaces (``%5=0``);
    no resources (``%6=0``); an ftp resource (``%9=0``).
    """
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    k = F.col("c_custkey")
    community = F.concat(F.lit("comm"), _s(F.col("c_nationkey")))
    pid = F.concat(F.lit("pf"), _s(k))
    activated = F.when(k % 17 == 0, F.lit(None).cast("boolean")).otherwise(k % 4 != 0)
    entry = F.struct(pid.alias("platform"), _platform_name(k).alias("name"),
                     F.struct(activated.alias("activated")).alias("metadata"))
    modules = (cust.groupBy(F.col("c_nationkey"), F.floor(k / MODULE_WIDTH).alias("_chunk"))
               .agg(F.sort_array(F.collect_list(F.struct(k.alias("k"), entry.alias("e")))).alias("_es"))
               .select(F.lit("assistant").alias("name"),
                       F.concat(F.lit("comm"), _s(F.col("c_nationkey"))).alias("community"),
                       F.lit(True).alias("activated"),
                       F.struct(F.transform("_es", lambda x: x["e"]).alias("platforms")).alias("options")))
    site = F.concat(F.lit("https://site"), _s(k), F.lit(".example.com/"))
    resources = (F.when(k % 6 == 0, F.array().cast("array<string>"))
                 .when(k % 9 == 0, F.array(F.concat(F.lit("ftp://files"), _s(k), F.lit(".example.com/")), site))
                 .otherwise(F.array(site, F.concat(site, F.lit("docs")))))
    metadata = F.struct(
        F.when(k % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("http://wiki"), _s(k), F.lit(".example.org"))).alias("baseURL"),
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.lit("/w/api.php")).alias("path"),
        F.when(k % 5 == 0, F.array().cast("array<int>"))
        .otherwise(F.array(F.lit(0), (k % 4).cast("int"))).alias("namespaces"),
        resources.alias("resources"))
    platforms = cust.filter(k % 11 != 0).select(
        pid.alias("_id"), _platform_name(k).alias("name"), community.alias("community"),
        metadata.alias("metadata"))
    return modules, platforms


# --- web (from pages, orders, customer) -------------------------------------------

SITEMAP_WIDTH = 50  # <url> entries per generated sitemap file


def sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sitemap XML texts listing the pages of each host, ``SITEMAP_WIDTH``
    pages per file (``page_id div 50``). Every loc has surrounding spaces;
    ``page_id%5=0`` is listed twice, ``page_id%7=0`` adds an ftp link."""
    from ..functions.text import url_host, xml_escape
    pg = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    host = url_host("url")
    one = F.concat(F.lit("<url><loc> "), xml_escape("url"), F.lit(" </loc></url>"))
    ftp = F.concat(F.lit("<url><loc>ftp://"), host, F.lit("/file"), _s(F.col("page_id")), F.lit("</loc></url>"))
    entry = F.concat(one,
                     F.when(F.col("page_id") % 5 == 0, one).otherwise(F.lit("")),
                     F.when(F.col("page_id") % 7 == 0, ftp).otherwise(F.lit("")))
    chunk = F.floor(F.col("page_id") / SITEMAP_WIDTH)
    grouped = (pg.groupBy(host.alias("host"), chunk.alias("chunk"))
               .agg(F.sort_array(F.collect_list(F.struct("page_id", entry.alias("e")))).alias("es")))
    return grouped.select(
        F.concat(F.lit("https://"), F.col("host"), F.lit("/sitemap.xml?part="), _s(F.col("chunk"))).alias("sitemap_url"),
        F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n'
                       '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'),
                 F.array_join(F.transform("es", lambda x: x["e"]), ""),
                 F.lit("</urlset>")).alias("content"))


def site_jobs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(jobs, pages, sitemaps)`` of the crawled hosts: a job per host, whose seeds are the host's sitemaps."""
    from ..functions.text import url_host
    maps = sitemaps(spark, sf_dir)
    host = url_host("sitemap_url")
    jobs = maps.select(host.alias("platform_id"), "sitemap_url").groupBy("platform_id").agg(
        F.sort_array(F.collect_list("sitemap_url")).alias("urls")).withColumn("community_id", F.lit("web"))
    return jobs, read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]), maps


def _shop(kind: str, key: Column) -> Column:
    return F.concat(F.lit(f"https://shop.example.com/{kind}/"), _s(key))


def link_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(seeds, edges)`` of a shop site: a customer page links to its order
    pages, an order page links to the next customer's page. Every customer
    page is a seed."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey"])
    edges = orders.select(_shop("customer", F.col("o_custkey")).alias("src"),
                          _shop("order", F.col("o_orderkey")).alias("dst")).unionByName(
        orders.select(_shop("order", F.col("o_orderkey")).alias("src"),
                      _shop("customer", F.col("o_custkey") + 1).alias("dst")))
    seeds = cust.select(_shop("customer", F.col("c_custkey")).alias("seed"))
    return seeds, edges


# --- MediaWiki (from documents, customer) ---------------------------------------------

XML_ILLEGAL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\r]"
DUMP_WIDTH = 200  # pages per generated dump file
WIKI_PLATFORMS = 100  # pages are spread over the first 100 platforms


def wiki_source_text(text: Column) -> Column:
    """Document text as it survives an XML round trip (characters illegal
    in XML and carriage returns removed)."""
    return F.regexp_replace(text, XML_ILLEGAL, "")


def wiki_xml(spark: SparkSession, sf_dir: str, full: bool = False) -> DataFrame:
    """One ``<page>`` element per document (``doc_id, community_id,
    platform_id, xml``). ``doc_id%3``: 0 → no revision, 1 → one, 2 → a draft
    revision first, then the current one. Comment absent (``%5=0``) or empty
    (``%5=1``); contributor absent (``%6=0``) or an IP (``%6=1``); no parent
    id (``%4=0``); namespace ``doc_id%4``. The page belongs to platform
    ``pf{doc_id%100}`` in the community of that customer. Pages of
    ``doc_id%47=5`` end within a tag. ``full``: every page is well-formed and
    has one revision, with the document's text."""
    from ..functions.text import xml_escape
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    d = F.col("doc_id")
    ds = _s(d)
    contributor = (F.when(d % 6 == 0, F.lit(""))
                   .when(d % 6 == 1, F.concat(F.lit("<contributor><ip>10.0.0."), _s(d % 250),
                                              F.lit("</ip></contributor>")))
                   .otherwise(F.concat(F.lit("<contributor><username>user"), _s(d % 7),
                                       F.lit("</username><id>"), _s(d % 7), F.lit("</id></contributor>"))))
    comment = (F.when(d % 5 == 0, F.lit("")).when(d % 5 == 1, F.lit("<comment/>"))
               .otherwise(F.concat(F.lit("<comment>edit "), ds, F.lit("</comment>"))))
    parent = F.when(d % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("<parentid>"), _s(d * 10), F.lit("</parentid>")))
    ts = F.concat(F.lit("2024-01-"), F.lpad(_s(d % 28 + 1), 2, "0"), F.lit("T"),
                  F.lpad(_s(d % 24), 2, "0"), F.lit(":00:00Z"))
    current = F.concat(
        F.lit("<revision><id>"), _s(d * 10 + 1), F.lit("</id>"), parent,
        F.lit("<timestamp>"), ts, F.lit("</timestamp>"), contributor, comment,
        F.lit('<model>wikitext</model><format>text/x-wiki</format><text xml:space="preserve">'),
        xml_escape(wiki_source_text(F.col("text"))), F.lit("</text><sha1>sha"), ds, F.lit("</sha1></revision>"))
    draft = F.concat(
        F.lit("<revision><id>"), _s(d * 10), F.lit("</id><timestamp>2023-12-01T00:00:00Z</timestamp>"),
        contributor, F.lit("<comment>draft</comment><model>wikitext</model><format>text/x-wiki</format>"
                           '<text xml:space="preserve">draft of '), ds,
        F.lit("</text><sha1>draft"), ds, F.lit("</sha1></revision>"))
    revisions = current if full else F.when(d % 3 == 0, F.lit("")).when(d % 3 == 1, current).otherwise(F.concat(draft, current))
    xml = F.concat(F.lit("<page><title>Page "), ds, F.lit(" &amp; notes</title><ns>"), _s(d % 4),
                   F.lit("</ns><id>"), ds, F.lit("</id>"), revisions, F.lit("</page>"))
    if not full:
        xml = F.when(d % 47 == 5, F.concat(F.lit("<page><title>Broken "), ds, F.lit("</title><id"), F.lit("</page>"))).otherwise(xml)
    owner = (d % WIKI_PLATFORMS).alias("_owner")
    return docs.select("*", owner).join(cust, F.col("_owner") == cust.c_custkey, "left").select(
        "doc_id",
        F.concat(F.lit("comm"), _s(F.col("c_nationkey"))).alias("community_id"),
        F.concat(F.lit("pf"), _s(F.col("_owner"))).alias("platform_id"),
        xml.alias("xml"))


# --- ingestion requests (from conversations) ---------------------------------------------

REQUEST_WIDTH = 5  # conversations per batch request
REQUEST_TURNS = 50  # turns of one conversation per batch request at most


def _collection_name(key: Column) -> Column:
    return (F.when(key % 2 == 0, F.lit(None).cast("string"))
            .when(key % 9 == 1, F.lit(""))
            .otherwise(F.lit("col")))


def single_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ingestion request per conversation turn. ``docId`` missing for
    ``turn%7=3``; ``collectionName`` NULL for even ``conv_id``, empty for
    ``conv_id%9=1``, else ``col``."""
    conv = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    c, t = F.col("conv_id"), F.col("turn")
    return conv.select(
        F.concat(F.lit("c"), _s(c % 10)).alias("communityId"),
        F.concat(F.lit("p"), _s(c % 4)).alias("platformId"),
        "text",
        F.create_map(F.lit("role"), F.col("role"), F.lit("turn"), _s(t)).alias("metadata"),
        F.when(t % 7 == 3, F.lit(None).cast("string")).otherwise(F.concat(_s(c), F.lit("-"), _s(t))).alias("docId"),
        F.array(F.lit("turn")).alias("excludedEmbedMetadataKeys"),
        F.array().cast("array<string>").alias("excludedLlmMetadataKeys"),
        _collection_name(c).alias("collectionName"))


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON line per conversation turn (``value``): a request with an id of its own, but cut short
    (``turn%11=4``), an array (``%11=5``), without ``platformId`` (``%11=6``), with a number as
    ``communityId`` (``%11=7``), with a text as ``metadata`` (``%11=8``) or without text (``%11=9``)."""
    conv = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    c, t = F.col("conv_id"), F.col("turn")
    text = F.to_json(F.struct(F.concat(F.lit("turn "), _s(t), F.lit(" of "), _s(c), F.lit(" by "), F.col("role")).alias("text")))
    body = F.expr("substring(b, 2, length(b) - 2)")
    own = conv.select(c, t, text.alias("b")).withColumn("b", body)
    community = F.concat(F.lit('"communityId":"c'), _s(c % 10), F.lit('"'))
    platform = F.concat(F.lit('"platformId":"p'), _s(c % 4), F.lit('"'))
    meta = F.concat(F.lit('"metadata":{"turn":"'), _s(t), F.lit('"}'))
    rest = F.concat(F.lit('"docId":"'), _s(c), F.lit("-"), _s(t), F.lit('"'))

    def line(*parts: Column) -> Column:
        return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))

    whole = line(community, platform, F.col("b"), meta, rest)
    value = (F.when(t % 11 == 4, F.expr("substring(w, 1, 40)")).when(t % 11 == 5, F.concat(F.lit("["), F.col("w"), F.lit("]")))
             .when(t % 11 == 6, line(community, F.col("b"), meta, rest))
             .when(t % 11 == 7, line(F.concat(F.lit('"communityId":'), _s(c)), platform, F.col("b"), meta, rest))
             .when(t % 11 == 8, line(community, platform, F.col("b"), F.lit('"metadata":"none"'), rest))
             .when(t % 11 == 9, line(community, platform, meta, rest)).otherwise(F.col("w")))
    return own.withColumn("w", whole).select("conv_id", "turn", value.alias("value"))


def batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch requests: the turns of ``REQUEST_WIDTH`` consecutive
    conversations (``conv_id div 5``) in (conversation, turn) order, at most
    ``REQUEST_TURNS`` turns of a conversation per request (``turn div 50``),
    so that no request grows without bound even for a huge conversation.
    ``request_id = '{conv_id div 5}-{turn div 50}'``."""
    conv = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    c, t = F.col("conv_id"), F.col("turn")
    g = (conv.groupBy(F.floor(c / REQUEST_WIDTH).alias("_rid"), F.floor(t / REQUEST_TURNS).alias("_part"))
         .agg(F.sort_array(F.collect_list(F.struct(c.alias("c"), t.alias("t"), "text", "role"))).alias("_ds")))
    rid = F.col("_rid")

    def doc(x):
        return F.struct(F.concat(_s(x["c"]), F.lit("-"), _s(x["t"])).alias("docId"), x["text"].alias("text"),
                        F.create_map(F.lit("role"), x["role"]).alias("metadata"),
                        F.array().cast("array<string>").alias("excludedEmbedMetadataKeys"),
                        F.array().cast("array<string>").alias("excludedLlmMetadataKeys"))
    return g.select(F.concat(_s(rid), F.lit("-"), _s(F.col("_part"))).alias("request_id"),
                    F.concat(F.lit("c"), _s(rid % 10)).alias("communityId"),
                    F.concat(F.lit("p"), _s(rid % 4)).alias("platformId"),
                    F.when(rid % 2 == 0, F.lit(None).cast("string")).otherwise(F.lit("col")).alias("collectionName"),
                    F.transform("_ds", doc).alias("document"))


def document_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(existing, incoming)`` for the upsert: every document stored at
    version 1 in ``col_{lang}``; a second batch changes ``doc_id%3=0``,
    repeats ``doc_id%5=0`` unchanged and adds ``doc_id%7=0`` to ``new_{lang}``."""
    from ..operators.documents import content_hash
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    d = F.col("doc_id")

    def rows(df, prefix, text, version):
        return df.select(F.concat(F.lit(prefix), F.col("lang")).alias("collection"), _s(d).alias("doc_id"),
                         F.lit(version).cast("bigint").alias("version"),
                         content_hash(text).alias("content_hash"))
    existing = rows(docs, "col_", F.col("text"), 1)
    incoming = (rows(docs.filter(d % 3 == 0), "col_", F.concat(F.col("text"), F.lit(" [rev 2]")), 2)
                .unionByName(rows(docs.filter((d % 5 == 0) & (d % 3 != 0)), "col_", F.col("text"), 2))
                .unionByName(rows(docs.filter(d % 7 == 0), "new_", F.col("text"), 2)))
    return existing, incoming


def xml_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-level XML per document: ``<doc id><meta><lang/><source/></meta><body/></doc>``."""
    from ..functions.text import xml_escape
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source"])
    return docs.select("doc_id", F.concat(
        F.lit('<doc id="'), _s(F.col("doc_id")), F.lit('"><meta><lang>'), xml_escape("lang"),
        F.lit("</lang><source>"), xml_escape("source"), F.lit("</source></meta><body>"),
        xml_escape(wiki_source_text(F.col("text"))), F.lit("</body></doc>")).alias("xml"))


# Fixed query vector of the vector search query (64 values from a rule).
QUERY_VECTOR = [((i % 7) - 3) / 3.0 for i in range(64)]


def document_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two loads of documents into ``col_{lang}`` collections: the first
    holds every document; the second changes ``doc_id%3=0``, repeats
    ``doc_id%5=0`` unchanged and adds ``doc_id%7=0`` to ``new_{lang}``."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    d = F.col("doc_id")

    def rows(df, prefix, text):
        return df.select(F.concat(F.lit(prefix), F.col("lang")).alias("collection"), _s(d).alias("doc_id"),
                         text.alias("text"))
    first = rows(docs, "col_", F.col("text"))
    second = (rows(docs.filter(d % 3 == 0), "col_", F.concat(F.col("text"), F.lit(" [rev 2]")))
              .unionByName(rows(docs.filter((d % 5 == 0) & (d % 3 != 0)), "col_", F.col("text")))
              .unionByName(rows(docs.filter(d % 7 == 0), "new_", F.col("text"))))
    return first, second


def incremental_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three loads into ``col_{lang}``: every document; ``doc_id%3=0`` changed, ``%5=0`` unchanged and ``%11=0``
    emptied; then ``%33=0`` with a text again and ``%13=0`` into ``new_{lang}``."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    d = F.col("doc_id")

    def rows(prefix, text, where):
        return docs.filter(where).select(F.concat(F.lit(prefix), F.col("lang")).alias("collection"), _s(d).alias("doc_id"), text.alias("text"))

    text = F.col("text")
    empty = d % 11 == 0
    second = rows("col_", F.when(empty, F.lit(" \n ")).when(d % 3 == 0, F.concat(text, F.lit(" [rev 2]"))).otherwise(text),
                  (d % 3 == 0) | (d % 5 == 0) | empty)
    third = rows("col_", F.concat(text, F.lit(" [rev 3]")), d % 33 == 0).unionByName(rows("new_", text, d % 13 == 0))
    return rows("col_", text, F.lit(True)), second, third


def summary_workflow_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored-summary request per conversation, all three kinds:
    ``conv_id%3`` 0 → latest date, 1 → one date, 2 → a three-day range
    written unpadded (reversed for ``conv_id%17=2``); no platform for
    ``conv_id%13=0``."""
    conv = read_table(spark, sf_dir, "conversations", ["conv_id"]).distinct()
    c = F.col("conv_id")
    lo, hi = _s(c % 28 + 1), _s(c % 28 + 3)
    rev = c % 17 == 2
    start = (F.when(c % 3 == 0, F.lit(None).cast("string"))
             .when(c % 3 == 1, F.concat(F.lit("2024-01-"), F.lpad(_s(c % 31 + 1), 2, "0")))
             .otherwise(F.concat(F.lit("2024-1-"), F.when(rev, hi).otherwise(lo))))
    end = F.when(c % 3 == 2, F.concat(F.lit("2024-1-"), F.when(rev, lo).otherwise(hi)))
    return conv.select(
        c.alias("request_id"),
        F.concat(F.lit("c"), _s(c % 5)).alias("community_id"),
        F.when(c % 13 == 0, F.lit("")).otherwise(F.concat(F.lit("p"), _s(c % 3))).alias("platform_id"),
        start.alias("start_date"), end.alias("end_date"))
