"""Platform registry: which wiki and website jobs to run (S1, S2, P1-P4,
W1-W5, J1, R1, R2).

``modules`` holds one document per community module with a nested list of
platforms; ``platforms`` holds the metadata of each platform. The reference
walks modules in Python and looks up metadata one key at a time (an N+1
pattern); here the nested list is exploded and joined to the metadata once.
How the metadata side is joined (broadcast or shuffle) is the planner's choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..quality import REASON, first_reason, reject_counts

WIKI = "mediaWiki"
WEBSITE = "website"


def module_platforms(modules: DataFrame, platform_name: str | list[str]) -> DataFrame:
    """S1 + P1 + W1: one row per platform entry of the given name(s), in array
    order (``position``), with its community, ``kind`` (the platform name)
    and ``activated`` flag. Modules without such a platform are dropped
    before the explode (S1's query)."""
    names = [platform_name] if isinstance(platform_name, str) else list(platform_name)
    has_kind = F.exists("options.platforms", lambda p: p["name"].isin(names))
    return (modules.filter(has_kind)
            .select(F.col("community").cast("string").alias("community_id"),
                    F.posexplode("options.platforms").alias("position", "p"))
            .filter(F.col("p.name").isin(names))
            .select("community_id", "position", F.col("p.name").alias("kind"),
                    F.col("p.platform").cast("string").alias("platform_id"),
                    F.col("p.metadata.activated").alias("activated")))


def _with_metadata(entries: DataFrame, platforms: DataFrame) -> DataFrame:
    """Attach platform metadata (left join; not found → NULL ``_id``)."""
    meta = platforms.select(F.col("_id").cast("string").alias("_id"),
                            F.col("metadata.baseURL").alias("baseURL"),
                            F.col("metadata.path").alias("path"),
                            F.col("metadata.namespaces").alias("namespaces"),
                            F.col("metadata.resources").alias("resources"))
    return entries.join(meta, entries.platform_id == meta._id, "left")


def _wiki_reason():
    """W3-W5 and J1 for MediaWiki entries, checked in the reference's order."""
    base, path, ns = F.col("baseURL"), F.col("path"), F.col("namespaces")
    return first_reason([
        (F.col("_id").isNull(), "platform_not_found"),
        (base.isNull() & path.isNull(), "bad_url_fields"),
        (F.col("activated").isNull(), "missing_activated"),
        (~F.col("activated"), "not_activated"),
        (F.coalesce(F.size(ns), F.lit(0)) <= 0, "no_namespaces"),
        (base.isNull() | path.isNull(), "bad_url_fields"),
    ])


def _site_reason():
    """W3 and J1 for website entries."""
    return first_reason([
        (F.col("_id").isNull(), "platform_not_found"),
        (F.col("activated").isNull(), "missing_activated"),
        (~F.col("activated"), "not_activated"),
    ])


def wiki_candidates(modules: DataFrame, platforms: DataFrame,
                    platform_id: str | None = None) -> DataFrame:
    """MediaWiki entries with metadata and a reject reason (W3 activated,
    W4 namespaces, W5 url fields), checked in the reference's order. W2:
    ``platform_id`` is compared as a string; ``""`` matches nothing (the
    reference tests ``is not None``)."""
    entries = module_platforms(modules, WIKI)
    if platform_id is not None:
        entries = entries.filter(F.col("platform_id") == F.lit(str(platform_id)))
    return _with_metadata(entries, platforms).withColumn(REASON, _wiki_reason())


def wiki_jobs(modules: DataFrame, platforms: DataFrame, platform_id: str | None = None) -> DataFrame:
    """P2 + P3: ``community_id, platform_id, namespaces, base_url`` per valid
    MediaWiki platform (``base_url = baseURL + path``), plus ``position``."""
    c = wiki_candidates(modules, platforms, platform_id)
    return c.filter(F.col(REASON).isNull()).select(
        "community_id", "platform_id", "position", "namespaces",
        F.concat("baseURL", "path").alias("base_url"))


def site_candidates(modules: DataFrame, platforms: DataFrame,
                    platform_id: str | None = None) -> DataFrame:
    """Website entries with a reject reason (W3 activated). W2 website
    variant: an empty ``platform_id`` means no filter."""
    entries = module_platforms(modules, WEBSITE)
    if platform_id:
        entries = entries.filter(F.col("platform_id") == F.lit(str(platform_id)))
    return _with_metadata(entries, platforms).withColumn(REASON, _site_reason())


def site_jobs(modules: DataFrame, platforms: DataFrame, platform_id: str | None = None) -> DataFrame:
    """``community_id, platform_id, urls`` per valid website platform."""
    c = site_candidates(modules, platforms, platform_id)
    return c.filter(F.col(REASON).isNull()).select(
        "community_id", "platform_id", "position", F.col("resources").alias("urls"))


def job_rejects(modules: DataFrame, platforms: DataFrame, keys: Sequence[str] = ("kind",)) -> DataFrame:
    """R1 + R2: rejected platform entries counted per ``keys`` (of ``kind,
    community_id, platform_id``) and reason. Both kinds come from one explode
    and one metadata join."""
    entries = _with_metadata(module_platforms(modules, [WIKI, WEBSITE]), platforms)
    reason = F.when(F.col("kind") == WIKI, _wiki_reason()).otherwise(_site_reason())
    rejected = entries.select("kind", "community_id", "platform_id", reason.alias(REASON)).filter(F.col(REASON).isNotNull())
    return reject_counts(rejected, list(keys))
