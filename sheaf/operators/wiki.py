"""MediaWiki pages → documents.

Input: a frame with a parsed ``page`` struct (see ``sources/wiki.py``).
Everything is a per-row projection (no shuffle) except the job join J4.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..quality import REASON, first_reason, keep_rows
from ..sources.wiki import parse_pages

# Metadata keys hidden from the embedding and from the LLM.
EXCLUDED_EMBED_KEYS = ["namespace", "revision_id", "parent_revision_id", "sha1", "model",
                       "contributor_user_id", "comment", "timestamp"]
EXCLUDED_LLM_KEYS = ["namespace", "revision_id", "parent_revision_id", "sha1", "model",
                     "contributor_user_id"]

# The metadata keys of a page's document.
METADATA_KEYS = ["title", "namespace", "revision_id", "parent_revision_id", "timestamp", "comment",
                 "contributor_username", "contributor_user_id", "sha1", "model", "ref_doc_id"]


def _absent_empty(c: Column) -> Column:
    """§1.4 for ``comment`` and ``text``: absent → ``""``, empty → NULL
    (Spark reads them the other way round)."""
    return F.when(c.isNull(), F.lit("")).when(c == "", F.lit(None).cast("string")).otherwise(c)


def flatten_pages(pages: DataFrame) -> DataFrame:
    """P6 + P7: one flat record per page, first revision in document order.

    Columns: ``title, namespace, page_id, has_revision``, the revision
    fields ``revision_id, parent_revision_id, timestamp, comment,
    contributor_username, contributor_user_id, model, format, text, sha1``
    and ``raw_xml``, the fragment itself where it isn't well-formed.
    """
    rev = F.try_element_at(F.col("page.revision"), F.lit(1))
    has = rev.isNotNull()

    def leaf(c: Column) -> Column:
        return F.when(has, F.nullif(c, F.lit("")))

    return pages.select(
        *[c for c in pages.columns if c != "page"],
        F.nullif(F.col("page.title"), F.lit("")).alias("title"),
        F.nullif(F.col("page.ns"), F.lit("")).alias("namespace"),
        F.nullif(F.col("page.id"), F.lit("")).alias("page_id"),
        has.alias("has_revision"),
        leaf(rev["id"]).alias("revision_id"),
        leaf(rev["parentid"]).alias("parent_revision_id"),
        leaf(rev["timestamp"]).alias("timestamp"),
        F.when(has, _absent_empty(rev["comment"])).alias("comment"),
        leaf(rev["contributor"]["username"]).alias("contributor_username"),
        leaf(rev["contributor"]["id"]).alias("contributor_user_id"),
        leaf(rev["model"]).alias("model"),
        leaf(rev["format"]).alias("format"),
        F.when(has, _absent_empty(rev["text"])).alias("text"),
        leaf(rev["sha1"]).alias("sha1"),
        F.col("page._corrupt_record").alias("raw_xml"),
    )


def page_checks() -> list[tuple[Column, str]]:
    """W13 and the decisions of §7.5: malformed XML, no revision, no id, NULL text."""
    return [
        (F.col("raw_xml").isNotNull(), "bad_xml"),
        (~F.col("has_revision"), "no_revision"),
        (F.col("page_id").isNull(), "no_page_id"),
        (F.col("text").isNull(), "null_text"),
    ]


def page_documents(flat: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P8 + P12 + P13: documents of valid pages (``doc_id = page_id``) with
    the metadata map, both exclusion lists and a reject reason column.
    ``keep`` names extra input columns to carry (e.g. job keys)."""
    keep = keep or []
    meta = F.create_map(*[x for k in METADATA_KEYS
                          for x in (F.lit(k), F.col("page_id") if k == "ref_doc_id" else F.col(k))])
    return flat.select(
        *keep,
        F.col("page_id").alias("doc_id"), "text", meta.alias("metadata"),
        F.array(*[F.lit(k) for k in EXCLUDED_EMBED_KEYS]).alias("excluded_embed_keys"),
        F.array(*[F.lit(k) for k in EXCLUDED_LLM_KEYS]).alias("excluded_llm_keys"),
        first_reason(page_checks()).alias(REASON))


def page_rejects(flat: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The quarantine of pages that give no document: ``keep, page_id, title, reason, raw_xml``
    (the fragment of a malformed page, so that none is lost)."""
    checked = flat.select(*keep, "page_id", "title", first_reason(page_checks()).alias("reason"), "raw_xml")
    return keep_rows(checked, F.col("reason").isNotNull())


def current_pages(pages: DataFrame, namespaces: list[int] | None = None) -> DataFrame:
    """W10 + W11: the pages of the selected namespaces, each with its newest revision only
    (by timestamp, then id), ready for :func:`flatten_pages`. Pages without a
    revision and malformed ones stay as they are, for the quarantine."""
    newest = F.array_max(F.transform("page.revision", lambda r: F.struct(
        r["timestamp"].alias("ts"), r["id"].try_cast("bigint").alias("rid"), r.alias("r"))))["r"]
    some = F.size(F.coalesce(F.col("page.revision"), F.array())) > 0
    if namespaces:
        wanted = F.col("page.ns").try_cast("int").isin([int(n) for n in namespaces])
        pages = keep_rows(pages, wanted | F.col("page._corrupt_record").isNotNull())
    return pages.withColumn("page", F.col("page").withField(
        "revision", F.when(some, F.array(newest)).otherwise(F.col("page.revision"))))


def current_revisions(pages: DataFrame, namespaces: list[int] | None = None) -> DataFrame:
    """W10 + W11: newest revision of each page (by timestamp, then id) among
    pages of the selected namespaces (an empty list selects all).

    Per-row ``array_max`` over the page's own revisions: no shuffle.
    Rows: ``page_id, namespace, revision_id, timestamp``.
    """
    keep = (F.size(F.coalesce(F.col("page.revision"), F.array())) > 0) & F.col("page._corrupt_record").isNull()
    if namespaces:
        keep = keep & F.col("page.ns").try_cast("int").isin([int(n) for n in namespaces])
    newest = F.array_max(F.transform("page.revision", lambda r: F.struct(
        r["timestamp"].alias("ts"), r["id"].try_cast("bigint").alias("rid"), r["id"].alias("id"))))
    # keep_rows: the test on parsed fields must not re-run the parse (see quality.keep_rows).
    return keep_rows(pages, keep).select(
        F.col("page.id").alias("page_id"), F.col("page.ns").alias("namespace"),
        newest["id"].alias("revision_id"), newest["ts"].alias("timestamp"))


def job_pages(jobs: DataFrame, pages: DataFrame, xml: str = "xml") -> DataFrame:
    """J4 + W10: flattened pages of each wiki job in the job's namespaces.

    ``pages`` are raw page elements with their job keys (``community_id,
    platform_id, xml``). They are joined to the jobs *before* parsing, so
    only pages of valid jobs are parsed. The namespace test runs once per parsed row (``keep_rows``).
    """
    j = jobs.select("community_id", "platform_id", "namespaces")
    scoped = pages.join(j, ["community_id", "platform_id"])
    flat = flatten_pages(parse_pages(scoped, xml))
    in_ns = F.array_contains(F.col("namespaces"), F.col("namespace").try_cast("int"))
    # The namespace of a malformed page is unknown: it stays, for the quarantine.
    return keep_rows(flat, in_ns | F.col("raw_xml").isNotNull()).drop("namespaces")


def job_counts(flat_with_jobs: DataFrame) -> DataFrame:
    """Pages, documents and rejected pages per job."""
    reason = first_reason(page_checks())
    return flat_with_jobs.groupBy("community_id", "platform_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_pages"),
        F.count(F.when(reason.isNull(), 1)).cast("bigint").alias("n_documents"),
        F.count(reason).cast("bigint").alias("n_rejected"))
