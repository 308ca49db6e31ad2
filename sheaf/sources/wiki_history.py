"""Dumps that hold whole page histories (S3, S5, P7, W11): records are revisions, not pages.

A page of a full export can be gigabytes of revisions, so a file is cut at
``</revision>``: Hadoop's line reader splits it at any byte offset, and a page's
revisions spread over as many tasks as its bytes need. The text is read once
(:func:`stage_dump`): revisions, page headers, the export version and the site
information are parsed in that scan and written as one table.

A record holds a page's header only where the page starts; further revisions
inherit it. :func:`history_pages` carries headers forward by a segmented scan
in two levels: inside a file block, and from block to block through one row
for each block. Which revision stands for a page is decided on keys alone;
texts are joined for the chosen ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..session import scratch_path
from .wiki import EXPORT_NS, NAMESPACE, XML_OPTIONS

REVISION = f"""id string, parentid string, timestamp string, comment string, contributor {schemas.CONTRIBUTOR},
               model string, format string, text string, sha1 string, _corrupt_record string"""
HEADER = "title string, ns string, id string, _corrupt_record string"
#: A place in a dump: the file, its block, the record in the block and the page in the record.
PLACE = ["file", "block", "record", "part"]


def stage_dump(spark: SparkSession, path: str, glob: str = "*.xml", out: str | None = None) -> DataFrame:
    """The parsed pieces of all dump files under ``path``: at most a page header and a revision each.

    Columns: ``file, block, record, part``, ``starts`` (a page starts here), ``head`` and ``revision`` (parsed, NULL if
    there is none), ``raw`` (what isn't well-formed), ``export`` (the root's namespace) and ``siteinfo``.
    Written to ``out`` (a folder of the shared checkpoint folder by default). No matching file is an error.
    """
    records = (spark.read.option("lineSep", "</revision>").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
               .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
               .withColumn("record", F.monotonically_increasing_id()))
    # The first piece goes on with the page before it, every other one starts a page.
    pieces = records.select("file", "block", "record", F.posexplode(F.split("value", "<page>")).alias("part", "piece"))
    rev_at = F.locate("<revision>", F.col("piece"))
    starts = F.col("part") > 0
    head = F.when(rev_at > 0, F.substring("piece", F.lit(1), rev_at - 1)).otherwise(F.col("piece"))
    torn = F.locate("</page>", F.col("piece")) == 0
    head_xml = F.when(starts, F.concat(F.lit("<page>"), F.substring_index(head, "</page>", 1), F.lit("</page>")))
    rev_xml = F.when(rev_at > 0, F.concat(F.expr("substring(piece, locate('<revision>', piece))"), F.lit("</revision>")))
    parsed = pieces.select(
        *PLACE, starts.alias("starts"), F.from_xml(head_xml, HEADER, XML_OPTIONS).alias("head"), F.from_xml(rev_xml, REVISION, XML_OPTIONS).alias("revision"),
        (starts & (rev_at == 0) & torn).alias("cut"),
        F.nullif(F.regexp_extract("piece", NAMESPACE, 1), F.lit("")).alias("export"),
        F.when(F.col("piece").contains("<siteinfo>"), F.regexp_extract("piece", r"(?s)(<siteinfo>.*</siteinfo>)", 1)).alias("siteinfo"))
    raw = F.coalesce("head._corrupt_record", "revision._corrupt_record", F.when(F.col("cut"), F.concat(F.lit("<page>"), F.coalesce("head.title", F.lit("")))))
    parsed = parsed.withColumn("raw", raw)
    out = out or scratch_path(spark, "wiki-history")
    parsed.filter("starts or revision is not null or export is not null or siteinfo is not null").drop("cut").write.parquet(out)
    staged = spark.read.parquet(out)
    if staged.isEmpty():
        raise FileNotFoundError(f"{path} holds no dump files ({glob})")
    return staged


def _known_files(staged: DataFrame) -> DataFrame:
    """Files of the export version whose pages are read."""
    return staged.filter(F.col("export") == EXPORT_NS).select("file").distinct()


def history_siteinfo(staged: DataFrame) -> DataFrame:
    """``file, sitename, dbname, base, generator`` of each file of the export version."""
    info = staged.filter(F.col("siteinfo").isNotNull() & (F.col("export") == EXPORT_NS)).select(
        "file", F.from_xml("siteinfo", schemas.SITEINFO, XML_OPTIONS).alias("s"))
    return info.select("file", *[F.nullif(F.col(f"s.{c}"), F.lit("")).alias(c) for c in ("sitename", "dbname", "base", "generator")])


def page_starts(staged: DataFrame) -> DataFrame:
    """``PLACE`` of each revision with the place of the page it belongs to (``page_block, page_record, page_part``); keys only."""
    keys = staged.select(*PLACE, "starts", F.col("revision").isNotNull().alias("has_revision"))
    own = F.when(F.col("starts"), F.struct(F.col("block").alias("b"), F.col("record").alias("r"), F.col("part").alias("p")))
    inside = Window.partitionBy("file", "block").orderBy("record", "part").rowsBetween(Window.unboundedPreceding, 0)
    filled = keys.withColumn("page", F.last(own, ignorenulls=True).over(inside))
    # One row a block: the last page that starts in it, or in the nearest block before.
    last = keys.filter("starts").groupBy("file", "block").agg(F.max(own).alias("last"))
    blocks = keys.select("file", "block").distinct().join(last, ["file", "block"], "left")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("file", "block", F.last("last", ignorenulls=True).over(before).alias("carried"))
    page = F.coalesce("page", "carried")
    return (filled.filter("starts or has_revision").join(carried, ["file", "block"])
            .select(*PLACE, "has_revision", page["b"].alias("page_block"), page["r"].alias("page_record"), page["p"].alias("page_part")))


def history_pages(staged: DataFrame, which: str = "first") -> DataFrame:
    """S3 + P7 / W11: ``file, page`` as :func:`sheaf.sources.wiki.read_dump` gives them, with one revision a page.

    ``which``: ``first`` (in document order) or ``current`` (newest timestamp, then id). Pages without a revision have none.
    """
    if which not in ("first", "current"):
        raise ValueError("which must be 'first' or 'current'")
    page_key = ["file", "page_block", "page_record", "page_part"]
    keys = staged.select(*PLACE, F.col("revision.timestamp").alias("ts"), F.col("revision.id").try_cast("bigint").alias("rid"),
                         F.col("revision._corrupt_record").isNotNull().alias("bad"))
    owned = page_starts(staged).join(_known_files(staged), "file", "left_semi").filter(F.col("page_record").isNotNull())
    place = F.struct("block", "record", "part")
    ranked = owned.filter("has_revision").join(keys, PLACE)
    pick = F.min_by(place, place) if which == "first" else F.max_by(place, F.struct("ts", "rid", "block", "record", "part"))
    # A malformed revision makes its page malformed, whichever revision is asked for.
    chosen = ranked.groupBy(*page_key).agg(pick.alias("c"), F.max(F.when(F.col("bad"), place)).alias("w"))
    chosen = chosen.select(*page_key, F.coalesce("w", "c").alias("c")).select(
        *page_key, F.col("c.block").alias("block"), F.col("c.record").alias("record"), F.col("c.part").alias("part"))
    revisions = staged.filter(F.col("revision").isNotNull()).select(*PLACE, "revision", F.col("raw").alias("rev_raw"))
    texts = chosen.join(revisions, PLACE).drop("block", "record", "part")
    heads = staged.filter("starts").join(_known_files(staged), "file", "left_semi").select(
        "file", F.col("block").alias("page_block"), F.col("record").alias("page_record"), F.col("part").alias("page_part"), "head", "raw")
    kind = f"array<struct<{REVISION.replace(', _corrupt_record string', '')}>>"
    revision = F.when(F.col("revision").isNotNull(), F.array(F.col("revision").dropFields("_corrupt_record"))).cast(kind)
    return heads.join(texts, page_key, "left").select("file", F.struct(
        F.col("head.title").alias("title"), F.col("head.ns").alias("ns"), F.col("head.id").alias("id"), revision.alias("revision"),
        F.coalesce("raw", "rev_raw").alias("_corrupt_record")).alias("page"))
