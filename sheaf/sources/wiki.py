"""MediaWiki XML export scans (S3, S4, S5, K-side dump writing).

A dump can be tens of gigabytes in one file, and the XML reader does not
split a file. The default path therefore reads dumps as text split at
``</page>`` (``lineSep``), which Hadoop's line reader splits across tasks at
any byte offset, and parses each page fragment with ``from_xml``. Page text
cannot contain a literal ``</page>`` because exports escape ``<``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

# Fixed value: the only export namespace whose pages are read.
EXPORT_NS = "http://www.mediawiki.org/xml/export-0.11/"
NAMESPACE = r'<mediawiki[^>]*xmlns="([^"]*)"'
XML_OPTIONS = {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false",
               "columnNameOfCorruptRecord": "_corrupt_record"}
PAGE_SCHEMA = schemas.WIKI_PAGE + ", _corrupt_record string"


def parse_pages(df: DataFrame, xml: str = "xml") -> DataFrame:
    """``from_xml`` of one ``<page>`` element per row into column ``page``
    (leaves as strings; ``revision`` an array in document order)."""
    return df.withColumn("page", F.from_xml(F.col(xml), PAGE_SCHEMA, XML_OPTIONS)).drop(xml)


def _records(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return (spark.read.option("lineSep", "</page>").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").text(path)
            .withColumn("file", F.input_file_name()))


def read_dump(spark: SparkSession, path: str, glob: str = "*.xml", check: bool = True,
              spread: int | None = None) -> DataFrame:
    """S3 + S4: pages of every dump file under ``path`` (``file, page``).

    Only files of the export-0.11 namespace yield pages (another version
    yields none, as in the reference). No matching file is an error.

    ``spread``: for dumps compressed with a codec Hadoop cannot split (gzip),
    one task reads a whole file; ``spread=N`` redistributes the page
    fragments over N partitions before the (expensive) XML parse.
    """
    rec = _records(spark, path, glob)
    if check and rec.isEmpty():
        raise FileNotFoundError(f"{path} holds no dump files ({glob})")
    pages = rec.filter(F.col("value").contains("<page>")).select(
        "file", F.concat(F.lit("<page>"), F.substring_index("value", "<page>", -1),
                         F.lit("</page>")).alias("xml"))
    version = (rec.filter(F.col("value").contains("<mediawiki"))
               .select("file", F.regexp_extract("value", NAMESPACE, 1).alias("ns"))
               .filter(F.col("ns") == EXPORT_NS).select("file"))
    pages = pages.join(version, "file", "left_semi")
    if spread:
        pages = pages.repartition(spread)
    return parse_pages(pages)


def read_siteinfo(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """The ``<siteinfo>`` of each dump file of the export namespace
    (``file, sitename, dbname, base, generator``; an empty element is NULL)."""
    rec = (_records(spark, path, glob).filter(F.col("value").contains("<siteinfo>"))
           .filter(F.regexp_extract("value", NAMESPACE, 1) == EXPORT_NS))
    info = F.from_xml(F.regexp_extract("value", r"(?s)(<siteinfo>.*</siteinfo>)", 1),
                      schemas.SITEINFO, XML_OPTIONS)
    return rec.select("file", info.alias("s")).select(
        "file", *[F.nullif(F.col(f"s.{c}"), F.lit("")).alias(c) for c in ("sitename", "dbname", "base", "generator")])


def dump_header(sitename: Column, dbname: Column) -> Column:
    return F.concat(
        F.lit(f'<mediawiki xmlns="{EXPORT_NS}" version="0.11" xml:lang="en">\n<siteinfo><sitename>'),
        sitename, F.lit("</sitename><dbname>"), dbname,
        F.lit("</dbname><base>https://wiki.example.org/</base><generator>MediaWiki 1.39</generator></siteinfo>"))


def write_dump(pages: DataFrame, path: str, part: str = "part") -> str:
    """Write page elements (``part, xml``) as one dump file per ``part``,
    each a complete export document (root, site information, pages).

    All rows of a part go to one task (``repartition(part)``), sorted header,
    pages, footer. Part sizes are the caller's choice; use many parts for a
    large table.
    """
    parts = pages.select(part).distinct()
    header = parts.select(part, F.lit(0).alias("_k"), F.lit(0).cast("bigint").alias("_o"),
                          dump_header(F.concat(F.lit("Wiki "), F.col(part).cast("string")),
                                      F.concat(F.lit("wiki"), F.col(part).cast("string"))).alias("value"))
    body = pages.select(part, F.lit(1).alias("_k"), F.col("_order").cast("bigint").alias("_o"),
                        F.col("xml").alias("value"))
    footer = parts.select(part, F.lit(2).alias("_k"), F.lit(0).cast("bigint").alias("_o"),
                          F.lit("</mediawiki>").alias("value"))
    rows = header.unionByName(body).unionByName(footer)
    (rows.repartition(part).sortWithinPartitions(part, "_k", "_o")
     .select(part, "value").write.mode("overwrite").partitionBy(part).text(path))
    return path
