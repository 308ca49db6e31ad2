"""Explicit schemas of the data model (no inference anywhere)."""

from __future__ import annotations

MODULES = """
name string, community string, activated boolean,
options struct<platforms: array<struct<platform: string, name: string,
                                       metadata: struct<activated: boolean>>>>
"""

PLATFORMS = """
_id string, name string, community string,
metadata struct<baseURL: string, path: string, namespaces: array<int>, resources: array<string>>,
disconnectedAt timestamp, connectedAt timestamp, createdAt timestamp, updatedAt timestamp
"""

CONTRIBUTOR = "struct<username: string, id: string>"

# A <page> element of a MediaWiki export as read by ``from_xml``: every
# leaf is a plain string (so absent and empty stay distinguishable) and
# <revision> is an array, element 0 being the first in document order.
WIKI_PAGE = f"""
title string, ns string, id string,
revision array<struct<id: string, parentid: string, timestamp: string, comment: string,
                      contributor: {CONTRIBUTOR}, model: string, format: string,
                      text: string, sha1: string>>
"""

SITEINFO = "sitename string, dbname string, base string, generator string"

DOCUMENTS = """
doc_id string, text string, metadata map<string, string>,
excluded_embed_keys array<string>, excluded_llm_keys array<string>
"""

INGESTION_REQUEST = """
communityId string, platformId string, text string, metadata map<string, string>,
docId string, excludedEmbedMetadataKeys array<string>, excludedLlmMetadataKeys array<string>,
collectionName string
"""

BATCH_DOCUMENT = """struct<docId: string, text: string, metadata: map<string, string>,
excludedEmbedMetadataKeys: array<string>, excludedLlmMetadataKeys: array<string>>"""

BATCH_REQUEST = f"""
communityId string, platformId string, collectionName string, document array<{BATCH_DOCUMENT}>
"""

POINTS = "collection string, point_id bigint, date string, createdAt double, _node_content string"

SITEMAP = "url array<struct<loc: string>>, _corrupt_record string"
