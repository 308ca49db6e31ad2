"""XML level split (S6, X5, F11): cut each XML document into the nodes at a
given depth (leaves above that depth count as nodes too), each serialised
as text without the XML declaration.

A small Python table function parses one document per call; Spark runs it
in every task over its own rows (``lateralJoin``), so a large collection of
files is split in parallel. A single huge file should first be cut into
records (as ``sources/wiki.py`` does for dumps).
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf


def pieces(xml: str, level: int) -> Iterator[str]:
    """the text of every element that closes at ``level``, or above it without having had a child.

    Such elements don't lie within each other, so the order in which they
    close is the order of the document.
    """
    parser = ET.XMLPullParser(("start", "end"))
    parser.feed(xml)
    parser.close()
    childless = []  # for each open element: no child so far
    for event, element in parser.read_events():
        if event == "start":
            if childless:
                childless[-1] = False
            childless.append(True)
            continue
        bare = childless.pop()
        depth = len(childless)
        if depth == level or (bare and depth < level):
            yield ET.tostring(element, encoding="unicode").strip()


@udtf(returnType="node_no int, content string")
class LevelSplit:
    def eval(self, xml: str, level: int):
        if xml is None:
            return
        try:
            found = list(pieces(xml, int(level)))
        except ET.ParseError:
            yield None, None
            return
        yield from enumerate(found)


def split_xml(df: DataFrame, xml: str = "xml", level: int = 0) -> DataFrame:
    """S6 + X5: rows of ``df`` (without ``xml``) joined with ``node_no, content`` of
    each of their nodes. A malformed document gives one row with NULL in both."""
    return (df.lateralJoin(LevelSplit(F.col(xml).outer(), F.lit(level)))
            .drop(xml))


def read_xml_files(spark, path: str, glob: str = "*.xml") -> DataFrame:
    """S6 source: one row per XML file (``file, xml``), read whole; the
    file path rides along as the extra information of every node."""
    return (spark.read.option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").text(path, wholetext=True)
            .select(F.input_file_name().alias("file"), F.col("value").alias("xml")))
