"""Collection naming rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def summary_collection(community_id, platform_id) -> Column:
    """``{community}_{platform}_summary``."""
    return F.concat(_c(community_id), F.lit("_"), _c(platform_id), F.lit("_summary"))


def digest_collection(collection_name, community_id, platform_id) -> Column:
    """An explicit name is used as is; else ``{community}_{platform}``
    when both ids are non-empty; else NULL (a rejected request)."""
    name, com, plat = _c(collection_name), _c(community_id), _c(platform_id)
    return (F.when(F.coalesce(name, F.lit("")) != "", name)
            .when((F.coalesce(com, F.lit("")) != "") & (F.coalesce(plat, F.lit("")) != ""),
                  F.concat(com, F.lit("_"), plat)))


def ingest_collection(community_id, collection_name, platform_id) -> Column:
    """``{community}_{collectionName or platform}``; only a NULL name falls
    back to the platform (an empty name is kept as empty)."""
    return F.concat(_c(community_id), F.lit("_"),
                    F.coalesce(_c(collection_name), _c(platform_id)))
