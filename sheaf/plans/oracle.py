"""DuckDB twins of the registered queries (the correctness oracle).

Each string runs on DuckDB with the test tables registered as views. The
derived views of ``plans/adapters.py`` are repeated here as CTEs with the same
rules, so that both engines start from the same rows.
"""

from __future__ import annotations

NL = "chr(10)"

POINTS_CTE = """points AS (
  SELECT 'c' || CAST(user_id % 5 AS VARCHAR) || '_p' || CAST(event_id % 3 AS VARCHAR) || '_summary' AS collection,
         event_id AS point_id,
         strftime(ts, '%Y-%m-%d') AS date,
         CAST(epoch_us(ts) AS DOUBLE) / 1000000 AS createdAt,
         CASE
           WHEN event_id % 23 = 0 THEN NULL
           WHEN event_id % 17 = 0 THEN '{"text": "' || event_type || ' #' || CAST(event_id AS VARCHAR)
           WHEN event_id % 19 = 0 THEN '{"metadata": {"author": "u' || CAST(user_id AS VARCHAR) || '"}}'
           WHEN event_id % 29 = 0 THEN '["' || event_type || ' #' || CAST(event_id AS VARCHAR) || '"]'
           WHEN event_id % 31 = 0 THEN '{"text": "' || event_type || ' #' || CAST(event_id AS VARCHAR) || '"}'
           WHEN event_id % 37 = 0 THEN '{"text": "' || event_type || ' #' || CAST(event_id AS VARCHAR) || '"} xyz'
           WHEN event_id % 41 = 0 THEN '{''text'': ''' || event_type || ' #' || CAST(event_id AS VARCHAR) || '''}'
           WHEN event_id % 43 = 0 THEN '{"text": "' || event_type || ' #' || CAST(event_id AS VARCHAR)
                || '", "metadata": {"author": null}}'
           WHEN event_id % 10 = 0 THEN '{"text": "' || event_type || ' #' || CAST(event_id AS VARCHAR) || '", "metadata": {}}'
           ELSE '{"text": "' || event_type || ' #' || CAST(event_id AS VARCHAR)
                || '", "metadata": {"author": "u' || CAST(user_id AS VARCHAR) || '"}}'
         END AS _node_content,
         ts
  FROM events)"""

PAIRS_CTE = r"""pairs AS (
  SELECT DISTINCT collection,
         regexp_extract(collection, '^(c\d+)_', 1) AS community_id,
         regexp_extract(collection, '^c\d+_(p\d+)_', 1) AS platform_id
  FROM points)"""


def summary_core(src: str, keys: str = "collection, date", limit: int = 100, name: str = "per_key") -> str:
    """CTEs ``{name}_ranked``, ``{name}_parsed`` and ``{name}`` for the
    text-only summaries of ``src`` per ``keys``."""
    x = "_node_content"
    return f"""{name}_ranked AS (
  SELECT {keys}, point_id, {x},
         row_number() OVER (PARTITION BY {keys} ORDER BY point_id) AS rn
  FROM {src}),
{name}_parsed AS (
  SELECT {keys}, point_id,
         CASE WHEN {x} IS NULL THEN 'no_content'
              WHEN NOT json_valid({x}) THEN 'bad_json'
              WHEN json_type({x}) = 'OBJECT' AND json_exists({x}, '$.text')
                   AND json_extract_string({x}, '$.text') IS NULL THEN 'null_text'
         END AS reason,
         CASE WHEN {x} IS NULL OR NOT json_valid({x}) THEN NULL
              WHEN json_type({x}) = 'OBJECT' AND json_exists({x}, '$.text')
                   THEN json_extract_string({x}, '$.text')
              ELSE 'Summary text not found'
         END AS summary_text
  FROM {name}_ranked WHERE rn <= {limit}),
{name} AS (
  SELECT {keys},
         count(summary_text) AS n_summaries,
         coalesce(string_agg(summary_text, {NL} ORDER BY point_id), '') AS summaries,
         count(reason) AS n_rejected
  FROM {name}_parsed GROUP BY {keys})"""


def digest_core(src: str, threshold_sql: str, limit: int = 500) -> str:
    x = "_node_content"
    return f"""recent AS (
  SELECT collection, point_id, {x} FROM {src} WHERE createdAt > ({threshold_sql})),
recent_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY collection ORDER BY point_id) AS rn FROM recent),
lines AS (
  SELECT collection, point_id,
         CASE WHEN json_valid({x}) AND json_type({x}) = 'OBJECT' AND json_exists({x}, '$.text') THEN
              CASE WHEN json_type({x}, '$.metadata') = 'OBJECT'
                        AND json_extract_string({x}, '$.metadata.author') IS NOT NULL
                   THEN json_extract_string({x}, '$.metadata.author') || ': ' || json_extract_string({x}, '$.text')
                   ELSE json_extract_string({x}, '$.text') END
         END AS line
  FROM recent_ranked WHERE rn <= {limit}),
agg AS (
  SELECT collection, count(*) AS n_points, count(line) AS n_texts,
         string_agg(line, {NL} ORDER BY point_id) AS combined
  FROM lines GROUP BY collection),
requests AS (
  SELECT collection || '#name' AS request_id, collection AS collection_name, community_id, platform_id FROM pairs
  UNION ALL
  SELECT collection || '#ids', NULL, community_id, platform_id FROM pairs),
resolved AS (
  SELECT request_id,
         CASE WHEN coalesce(collection_name, '') <> '' THEN collection_name
              WHEN coalesce(community_id, '') <> '' AND coalesce(platform_id, '') <> ''
                   THEN community_id || '_' || platform_id END AS collection
  FROM requests),
digests AS (
  SELECT r.request_id, r.collection,
         CASE WHEN r.collection IS NULL THEN 'no_collection' ELSE 'ok' END AS status,
         coalesce(a.n_points, 0) AS n_points, coalesce(a.n_texts, 0) AS n_texts,
         CASE WHEN r.collection IS NULL THEN NULL
              WHEN coalesce(a.n_points, 0) = 0 THEN 'No recent data found for the specified period.'
              WHEN coalesce(a.n_texts, 0) = 0 THEN 'No text content found in the recent data.'
              ELSE a.combined END AS digest
  FROM resolved r LEFT JOIN agg a ON r.collection = a.collection)"""


LATEST_THRESHOLD_72H = "SELECT CAST(max(epoch_us(ts)) - 259200000000 AS DOUBLE) / 1000000 FROM events"
DATE_THRESHOLD = "SELECT CAST(epoch_us(TIMESTAMP '2024-01-20 00:00:00') AS DOUBLE) / 1000000"

ORACLE: dict[str, str] = {}

ORACLE["summaries_by_date"] = f"""WITH {POINTS_CTE},
{summary_core('points')}
SELECT * FROM per_key"""

ORACLE["summaries_of_date"] = f"""WITH {POINTS_CTE},
scoped AS (SELECT * FROM points WHERE collection = 'c1_p2_summary' AND date = '2024-01-15'),
{summary_core('scoped')}
SELECT * FROM per_key"""

ORACLE["summaries_latest"] = f"""WITH {POINTS_CTE},
latest AS (SELECT collection, max(date) AS date FROM points GROUP BY collection),
scoped AS (SELECT p.* FROM points p JOIN latest l ON p.collection = l.collection AND p.date = l.date),
{summary_core('scoped')}
SELECT * FROM per_key"""

ORACLE["summaries_range"] = f"""WITH {POINTS_CTE},
{PAIRS_CTE},
spine AS (
  SELECT community_id, platform_id, collection, strftime(g.d, '%Y-%m-%d') AS date
  FROM pairs, generate_series(DATE '2023-12-31', DATE '2024-02-01', INTERVAL 1 DAY) AS g(d)),
{summary_core('points')}
SELECT s.community_id, s.platform_id, s.date,
       coalesce(p.n_summaries, 0) AS n_summaries, coalesce(p.summaries, '') AS summaries
FROM spine s LEFT JOIN per_key p ON s.collection = p.collection AND s.date = p.date"""

def payload_sql(src: str) -> str:
    """The first 100 points per (collection, date) of ``src`` with the payload columns (object fields in order of name)."""
    x = "_node_content"
    return f"""payload AS (
  SELECT collection, date, point_id, createdAt, {x},
         CASE WHEN NOT ok THEN NULL
              WHEN json_type({x}) = 'OBJECT' AND json_exists({x}, '$.text') THEN json_extract_string({x}, '$.text')
              ELSE 'Summary text not found' END AS summary_text,
         CASE WHEN NOT ok THEN NULL
              WHEN json_type({x}) <> 'OBJECT' THEN CAST(json({x}) AS VARCHAR)
              ELSE '{{' || concat_ws(',', '"metadata":' || CAST(json_extract({x}, '$.metadata') AS VARCHAR),
                                    '"text":' || CAST(json_extract({x}, '$.text') AS VARCHAR)) || '}}' END AS parsed_content,
         CAST(ok AS INTEGER) AS parsed
  FROM (SELECT *, coalesce({x} IS NOT NULL AND json_valid({x}), false) AS ok,
               row_number() OVER (PARTITION BY collection, date ORDER BY point_id) AS rn
        FROM {src}) WHERE rn <= 100)"""


ORACLE["summaries_payload"] = f"""WITH {POINTS_CTE},
{payload_sql('points')}
SELECT * FROM payload"""

MONTHLY_CTE = "monthly AS (SELECT * REPLACE (substr(date, 1, 8) || '01' AS date) FROM points)"

ORACLE["summaries_range_payload"] = f"""WITH {POINTS_CTE},
{PAIRS_CTE},
{MONTHLY_CTE},
spine AS (
  SELECT community_id, platform_id, collection, strftime(g.d, '%Y-%m-%d') AS date
  FROM pairs, generate_series(DATE '2023-12-31', DATE '2024-02-01', INTERVAL 1 DAY) AS g(d)),
{payload_sql('monthly')}
SELECT s.community_id, s.platform_id, s.date, p.* EXCLUDE (collection, date)
FROM spine s LEFT JOIN payload p ON s.collection = p.collection AND s.date = p.date"""

ORACLE["summary_limits"] = f"""WITH {POINTS_CTE},
{MONTHLY_CTE}
SELECT collection, date, count(*) AS n_total, greatest(count(*) - 100, 0) AS n_dropped
FROM monthly GROUP BY collection, date"""

ORACLE["summaries_for_requests"] = f"""WITH {POINTS_CTE},
requests AS (
  SELECT conv_id AS request_id,
         'c' || CAST(conv_id % 5 AS VARCHAR) AS community_id,
         CASE WHEN conv_id % 13 = 0 THEN '' ELSE 'p' || CAST(conv_id % 4 AS VARCHAR) END AS platform_id,
         '2024-01-' || lpad(CAST(conv_id % 31 + 1 AS VARCHAR), 2, '0') AS date
  FROM (SELECT DISTINCT conv_id FROM conversations)),
req AS (
  SELECT *, CASE WHEN coalesce(platform_id, '') = '' THEN 'no_platform' END AS reason,
         CASE WHEN coalesce(platform_id, '') <> '' THEN community_id || '_' || platform_id || '_summary' END AS collection
  FROM requests),
{summary_core('points')}
SELECT r.request_id, r.collection, r.date, coalesce(r.reason, 'ok') AS status,
       CASE WHEN r.reason IS NULL THEN coalesce(p.n_summaries, 0) END AS n_summaries,
       CASE WHEN r.reason IS NULL THEN coalesce(p.summaries, '') END AS summaries
FROM req r LEFT JOIN per_key p ON r.collection = p.collection AND r.date = p.date"""

ORACLE["digest_text"] = f"""WITH {POINTS_CTE},
{PAIRS_CTE},
{digest_core('points', LATEST_THRESHOLD_72H)}
SELECT * FROM digests"""

ORACLE["digest_since_date"] = f"""WITH {POINTS_CTE},
{PAIRS_CTE},
{digest_core('points', DATE_THRESHOLD)}
SELECT * FROM digests"""

def answer_core() -> str:
    """Digests of ``requests (request_id, collection, threshold)`` over ``points``."""
    return f"""asked AS (SELECT DISTINCT collection, threshold FROM requests WHERE threshold IS NOT NULL),
ranked AS (
  SELECT a.collection, a.threshold, p.point_id, p._node_content AS x,
         row_number() OVER (PARTITION BY a.collection, a.threshold ORDER BY p.point_id) AS rn
  FROM asked a JOIN points p ON p.collection = a.collection AND p.createdAt > a.threshold),
lines AS (
  SELECT collection, threshold, point_id,
         CASE WHEN json_valid(x) AND json_type(x) = 'OBJECT' AND json_exists(x, '$.text')
              THEN coalesce(json_extract_string(x, '$.metadata.author') || ': ', '') || json_extract_string(x, '$.text')
         END AS line
  FROM ranked WHERE rn <= 500),
agg AS (
  SELECT collection, threshold, count(*) AS n_points, count(line) AS n_texts,
         string_agg(line, {NL} ORDER BY point_id) AS combined
  FROM lines GROUP BY collection, threshold)
SELECT r.request_id, r.collection, CASE WHEN r.threshold IS NULL THEN 'bad_period' ELSE 'ok' END AS status,
       coalesce(n_points, 0) AS n_points, coalesce(n_texts, 0) AS n_texts,
       CASE WHEN r.threshold IS NULL THEN NULL
            WHEN coalesce(n_points, 0) = 0 THEN 'No recent data found for the specified period.'
            WHEN coalesce(n_texts, 0) = 0 THEN 'No text content found in the recent data.'
            ELSE combined END AS digest
FROM requests r LEFT JOIN agg a ON r.collection = a.collection AND r.threshold = a.threshold"""


# What each period means is written out here: the moment it reaches back to, or none.
ORACLE["digest_requests"] = f"""WITH {POINTS_CTE},
{PAIRS_CTE},
newest AS (SELECT max(epoch_us(ts)) AS us FROM events),
periods AS (
  SELECT unnest([NULL, '', '1h', '72h', '2024-01-01', '2024-01-20', '2024-13-45', '4 hours']) AS period,
         unnest([us - 3600000000, us - 3600000000, us - 3600000000, us - 259200000000, 1704067200000000,
                 1705708800000000, NULL, NULL]) AS us
  FROM newest),
requests AS (
  SELECT collection || '#name#' || coalesce(period, 'none') AS request_id, collection,
         CAST(us AS DOUBLE) / 1000000 AS threshold
  FROM pairs, periods
  UNION ALL
  SELECT collection || '#ids#' || coalesce(period, 'none'), community_id || '_' || platform_id, CAST(us AS DOUBLE) / 1000000
  FROM pairs, periods),
{answer_core()}"""

ORACLE["digest_periods"] = f"""WITH {POINTS_CTE},
newest AS (SELECT max(epoch_us(ts)) AS us FROM events),
requests AS (
  SELECT CAST(c_custkey AS VARCHAR) AS request_id,
         CASE WHEN c_custkey % 20 = 0 THEN 'c' || CAST(c_custkey % 5 AS VARCHAR) || '_p' || CAST(c_custkey % 3 AS VARCHAR) || '_summary'
              ELSE 'c1_p1_summary' END AS collection,
         CAST(us - (c_custkey % 1000 + 1) * 3600000000 AS DOUBLE) / 1000000 AS threshold
  FROM customer, newest),
{answer_core()}"""

ORACLE["digest_limits"] = f"""WITH {POINTS_CTE}
SELECT collection, count(*) AS n_total, greatest(count(*) - 500, 0) AS n_dropped
FROM points WHERE createdAt > 1704067200 GROUP BY collection"""

ORACLE["digest_prompt"] = f"""WITH {POINTS_CTE},
{PAIRS_CTE},
{digest_core('points', LATEST_THRESHOLD_72H)}
SELECT request_id, collection,
       'Please provide a concise summary of the following content, focusing on the key points and main themes. '
       || {NL} || {NL} || 'Content:' || {NL} || digest AS prompt
FROM digests WHERE status = 'ok' AND n_texts > 0"""


REGISTRY_CTE = """cust AS (SELECT c_custkey AS k, c_nationkey FROM customer),
entries AS (
  SELECT 'comm' || CAST(c_nationkey AS VARCHAR) AS community_id,
         'pf' || CAST(k AS VARCHAR) AS platform_id,
         row_number() OVER (PARTITION BY c_nationkey, k // 100 ORDER BY k) - 1 AS position,
         CASE k % 3 WHEN 0 THEN 'mediaWiki' WHEN 1 THEN 'website' ELSE 'discord' END AS name,
         CASE WHEN k % 17 = 0 THEN NULL ELSE k % 4 <> 0 END AS activated
  FROM cust),
plat AS (
  SELECT 'pf' || CAST(k AS VARCHAR) AS _id,
         CASE WHEN k % 7 = 0 THEN NULL ELSE 'http://wiki' || CAST(k AS VARCHAR) || '.example.org' END AS baseURL,
         CASE WHEN k % 13 = 0 THEN NULL ELSE '/w/api.php' END AS path,
         CASE WHEN k % 5 = 0 THEN []::INTEGER[] ELSE [0, CAST(k % 4 AS INTEGER)] END AS namespaces,
         CASE WHEN k % 6 = 0 THEN []::VARCHAR[]
              WHEN k % 9 = 0 THEN ['ftp://files' || CAST(k AS VARCHAR) || '.example.com/',
                                   'https://site' || CAST(k AS VARCHAR) || '.example.com/']
              ELSE ['https://site' || CAST(k AS VARCHAR) || '.example.com/',
                    'https://site' || CAST(k AS VARCHAR) || '.example.com/docs'] END AS resources
  FROM cust WHERE k % 11 <> 0),
wiki AS (
  SELECT e.community_id, e.platform_id, e.position, p.baseURL, p.path, p.namespaces,
         CASE WHEN p._id IS NULL THEN 'platform_not_found'
              WHEN p.baseURL IS NULL AND p.path IS NULL THEN 'bad_url_fields'
              WHEN e.activated IS NULL THEN 'missing_activated'
              WHEN NOT e.activated THEN 'not_activated'
              WHEN coalesce(len(p.namespaces), 0) <= 0 THEN 'no_namespaces'
              WHEN p.baseURL IS NULL OR p.path IS NULL THEN 'bad_url_fields' END AS reason
  FROM entries e LEFT JOIN plat p ON e.platform_id = p._id WHERE e.name = 'mediaWiki'),
site AS (
  SELECT e.community_id, e.platform_id, e.position, p.resources,
         CASE WHEN p._id IS NULL THEN 'platform_not_found'
              WHEN e.activated IS NULL THEN 'missing_activated'
              WHEN NOT e.activated THEN 'not_activated' END AS reason
  FROM entries e LEFT JOIN plat p ON e.platform_id = p._id WHERE e.name = 'website')"""

ORACLE["wiki_jobs"] = f"""WITH {REGISTRY_CTE}
SELECT community_id, platform_id, position, array_to_string(namespaces, ',') AS namespaces,
       baseURL || path AS base_url
FROM wiki WHERE reason IS NULL"""

ORACLE["site_jobs"] = f"""WITH {REGISTRY_CTE}
SELECT community_id, platform_id, position, array_to_string(resources, ' ') AS urls
FROM site WHERE reason IS NULL"""

ORACLE["job_rejects"] = f"""WITH {REGISTRY_CTE}
SELECT kind, reason, count(*) AS n FROM (
  SELECT 'mediaWiki' AS kind, reason FROM wiki WHERE reason IS NOT NULL
  UNION ALL
  SELECT 'website', reason FROM site WHERE reason IS NOT NULL) GROUP BY kind, reason"""


ORACLE["platform_rejects"] = f"""WITH {REGISTRY_CTE}
SELECT community_id, platform_id, reason, count(*) AS n FROM (
  SELECT community_id, platform_id, reason FROM wiki WHERE reason IS NOT NULL
  UNION ALL
  SELECT community_id, platform_id, reason FROM site WHERE reason IS NOT NULL) GROUP BY ALL"""

ORACLE["wiki_job_of_platform"] = f"""WITH {REGISTRY_CTE}
SELECT community_id, platform_id, baseURL || path AS base_url FROM wiki WHERE reason IS NULL AND platform_id = 'pf3'"""


# --- website ----------------------------------------------------------------------

def _decode(x: str) -> str:
    """The character references that the test pages hold."""
    for src, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
        x = f"replace({x}, '{src}', '{char}')"
    return x


def _collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '[ \\t\\n\\r\\f]+', ' ', 'g'))"


def _without(x: str, start: str, end: str) -> str:
    """``x`` without what stands between ``start`` and ``end`` (both known strings of the test pages)."""
    parts = f"string_split({x}, '{start}')"
    rest = f"list_transform({parts}[2:], lambda part: CASE WHEN strpos(part, '{end}') = 0 THEN '' ELSE substr(part, strpos(part, '{end}') + {len(end)}) END)"
    return f"array_to_string(list_prepend({parts}[1], {rest}), '')"


def html_title_sql(h: str = "html") -> str:
    return _collapse(_decode(f"split_part(split_part({h}, '<title>', 2), '</title>', 1)"))


# Elements of the test pages; chr(1) and chr(2) stand for one and two required line breaks, chr(3) for <br>.
_BLOCKS = ", ".join(f"'{mark}{tag}'" for tag in ("html", "body", "nav", "ul", "li", "div", "article", "h1", "footer") for mark in ("", "/"))


def html_text_sql(h: str = "html") -> str:
    t = h
    for tag in ("title", "style", "script"):
        t = _without(t, f"<{tag}>", f"</{tag}>")
    t = _without(t, "<!--", "-->")
    name = "regexp_extract(lower(piece), '^/?[a-z0-9]+')"
    mark = f"CASE WHEN {name} IN ('p', '/p') THEN chr(2) WHEN {name} = 'br' THEN chr(3) WHEN {name} IN ({_BLOCKS}) THEN chr(1) ELSE '' END"
    pieces = f"list_transform(string_split({t}, '<')[2:], lambda piece: {mark} || substr(piece, strpos(piece, '>') + 1))"
    t = f"regexp_replace(array_to_string({pieces}, ''), '[ \\t\\n\\r\\f]+', ' ', 'g')"
    for n in (1, 2, 3):
        t = f"replace(replace({t}, chr({n}) || ' ', chr({n})), ' ' || chr({n}), chr({n}))"
    t = f"trim({t}, ' ' || chr(1) || chr(2))"
    t = f"regexp_replace({t}, '[\\x01\\x02]*\\x02[\\x01\\x02]*', chr(10) || chr(10), 'g')"
    t = f"replace(regexp_replace({t}, '\\x01+', chr(10), 'g'), chr(3), chr(10))"
    return _decode(t)


ORACLE["crawled_pages"] = f"""SELECT url, {html_title_sql()} AS title, {html_text_sql()} AS inner_text,
       contains(url, 'sitemap.xml') AS is_sitemap FROM pages"""

ORACLE["web_documents"] = f"""SELECT url AS doc_id, {html_text_sql()} AS text,
       {html_title_sql()} AS meta_title, url AS meta_url FROM pages"""

# Links of the test pages are double-quoted and start at the root.
ORACLE["web_links"] = """WITH l AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="(/[^"]*)"', 1)) AS href FROM pages)
SELECT page_id, regexp_extract(url, '^https?://[^/?#]+') || replace(href, '&amp;', '&') AS link, count(*) AS n_refs
FROM l GROUP BY ALL"""

ORACLE["sitemap_links"] = r"""SELECT DISTINCT
       'https://' || regexp_extract(url, '^https?://([^/?#:]+)', 1) || '/sitemap.xml?part='
         || CAST(page_id // 50 AS VARCHAR) AS sitemap_url,
       url AS link
FROM pages"""

ORACLE["seed_check"] = f"""WITH {REGISTRY_CTE},
s AS (
  SELECT community_id, platform_id, coalesce(resources, []::VARCHAR[]) AS u FROM site WHERE reason IS NULL),
c AS (
  SELECT community_id, platform_id, len(u) AS n_urls,
         len(list_filter(u, lambda x: starts_with(x, 'http://') OR starts_with(x, 'https://'))) AS n_valid
  FROM s)
SELECT community_id, platform_id, CAST(n_urls AS BIGINT) AS n_urls, CAST(n_valid AS BIGINT) AS n_valid,
       CASE WHEN coalesce(community_id, '') = '' THEN 'no_community'
            WHEN n_urls = 0 THEN 'no_urls'
            WHEN n_valid < n_urls THEN 'invalid_url' ELSE 'ok' END AS status
FROM c"""

# A walk that goes on reaches a new page at each depth, so 20 pages lie within depth 19.
FRONTIER_CTE = """RECURSIVE edges AS (
  SELECT 'https://shop.example.com/customer/' || CAST(o_custkey AS VARCHAR) AS src,
         'https://shop.example.com/order/' || CAST(o_orderkey AS VARCHAR) AS dst FROM orders
  UNION
  SELECT 'https://shop.example.com/order/' || CAST(o_orderkey AS VARCHAR),
         'https://shop.example.com/customer/' || CAST(o_custkey + 1 AS VARCHAR) FROM orders),
seeds AS (SELECT 'https://shop.example.com/customer/' || CAST(c_custkey AS VARCHAR) AS seed FROM customer),
walk(seed, url, depth) AS (
  SELECT seed, seed, 0 FROM seeds
  UNION
  SELECT w.seed, e.dst, w.depth + 1 FROM walk w JOIN edges e ON w.url = e.src WHERE w.depth < 19),
best AS (SELECT seed, url, min(depth) AS depth FROM walk GROUP BY seed, url),
frontier AS (
  SELECT seed, url, CAST(depth AS BIGINT) AS depth FROM (
    SELECT *, row_number() OVER (PARTITION BY seed ORDER BY depth, url) AS rn FROM best) WHERE rn <= 20)"""

ORACLE["crawl_frontier"] = f"""WITH {FRONTIER_CTE}
SELECT * FROM frontier"""

ORACLE["crawl_union"] = f"""WITH {FRONTIER_CTE}
SELECT url, count(*) AS n_copies, min(depth) AS min_depth FROM frontier GROUP BY url"""


# --- MediaWiki -----------------------------------------------------------------------

def wiki_cte(draft: str = "d % 3 = 2", where: str = "d % 3 <> 0 AND d % 47 <> 5") -> str:
    """Documents of the wiki pages that fulfil ``where``; ``draft`` tells whose draft revision is read."""
    return rf"""wd AS (
  SELECT doc_id AS d, regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\r]', '', 'g') AS txt,
         '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || 'T'
           || lpad(CAST(doc_id % 24 AS VARCHAR), 2, '0') || ':00:00Z' AS ts
  FROM documents),
wiki_docs AS (
  SELECT CAST(d AS VARCHAR) AS doc_id,
         CASE WHEN {draft} THEN 'draft of ' || CAST(d AS VARCHAR) ELSE txt END AS text,
         'Page ' || CAST(d AS VARCHAR) || ' & notes' AS title,
         CAST(d % 4 AS VARCHAR) AS namespace,
         CAST(CASE WHEN {draft} THEN d * 10 ELSE d * 10 + 1 END AS VARCHAR) AS revision_id,
         CASE WHEN {draft} OR d % 4 = 0 THEN NULL ELSE CAST(d * 10 AS VARCHAR) END AS parent_revision_id,
         CASE WHEN {draft} THEN '2023-12-01T00:00:00Z' ELSE ts END AS timestamp,
         CASE WHEN {draft} THEN 'draft' WHEN d % 5 = 0 THEN '' WHEN d % 5 = 1 THEN NULL
              ELSE 'edit ' || CAST(d AS VARCHAR) END AS comment,
         CASE WHEN d % 6 IN (0, 1) THEN NULL ELSE 'user' || CAST(d % 7 AS VARCHAR) END AS contributor_username,
         CASE WHEN d % 6 IN (0, 1) THEN NULL ELSE CAST(d % 7 AS VARCHAR) END AS contributor_user_id,
         CASE WHEN {draft} THEN 'draft' || CAST(d AS VARCHAR) ELSE 'sha' || CAST(d AS VARCHAR) END AS sha1,
         'wikitext' AS model,
         CAST(d AS VARCHAR) AS ref_doc_id
  FROM wd WHERE {where})"""


WIKI_CTE = wiki_cte()
#: Every page with its document's whole text.
WIKI_FULL_CTE = wiki_cte("false", "txt <> ''")

ORACLE["wiki_current_documents"] = f"""WITH {wiki_cte("false", "d % 3 <> 0 AND d % 47 <> 5 AND d % 4 IN (0, 2)")}
SELECT * FROM wiki_docs"""

ORACLE["wiki_rejects"] = """SELECT doc_id, CASE WHEN doc_id % 47 = 5 THEN 'bad_xml' ELSE 'no_revision' END AS reason,
       CASE WHEN doc_id % 47 = 5 THEN '<page><title>Broken ' || CAST(doc_id AS VARCHAR) || '</title><id</page>' END AS raw_xml
FROM documents WHERE doc_id % 3 = 0 OR doc_id % 47 = 5"""

ORACLE["wiki_documents"] = f"""WITH {WIKI_CTE}
SELECT * FROM wiki_docs"""

ORACLE["wiki_dump_pages"] = ORACLE["wiki_documents"]

ORACLE["wiki_siteinfo"] = """SELECT DISTINCT 'Wiki ' || CAST(doc_id // 200 AS VARCHAR) AS sitename,
       'wiki' || CAST(doc_id // 200 AS VARCHAR) AS dbname,
       'https://wiki.example.org/' AS base, 'MediaWiki 1.39' AS generator
FROM documents"""

ORACLE["wiki_history_first"] = ORACLE["wiki_documents"]
ORACLE["wiki_history_current"] = ORACLE["wiki_current_documents"]
ORACLE["wiki_history_siteinfo"] = ORACLE["wiki_siteinfo"]

ORACLE["wiki_current"] = f"""WITH {WIKI_CTE}
SELECT CAST(d AS VARCHAR) AS page_id, CAST(d % 4 AS VARCHAR) AS namespace,
       CAST(d * 10 + 1 AS VARCHAR) AS revision_id, ts AS timestamp
FROM wd WHERE d % 3 <> 0 AND d % 47 <> 5 AND d % 4 IN (0, 2)"""

WIKI_JOB_CTE = f"""{REGISTRY_CTE},
wpages AS (
  SELECT 'comm' || CAST(c.c_nationkey AS VARCHAR) AS community_id, 'pf' || CAST(d.doc_id % 100 AS VARCHAR) AS platform_id,
         CASE WHEN d.doc_id % 47 <> 5 THEN CAST(d.doc_id AS VARCHAR) END AS page_id,
         CASE WHEN d.doc_id % 47 <> 5 THEN CAST(d.doc_id % 4 AS VARCHAR) END AS namespace, d.doc_id
  FROM documents d LEFT JOIN customer c ON c.c_custkey = d.doc_id % 100),
jp AS (
  SELECT p.* FROM wpages p JOIN wiki w
    ON w.reason IS NULL AND p.community_id = w.community_id AND p.platform_id = w.platform_id
  WHERE p.namespace IS NULL OR list_contains(w.namespaces, CAST(p.namespace AS INTEGER)))"""

ORACLE["wiki_job_pages"] = f"""WITH {WIKI_JOB_CTE}
SELECT community_id, platform_id, page_id, namespace FROM jp"""

ORACLE["job_counts"] = f"""WITH {WIKI_JOB_CTE}
SELECT community_id, platform_id, count(*) AS n_pages,
       count(*) FILTER (WHERE doc_id % 3 <> 0 AND doc_id % 47 <> 5) AS n_documents,
       count(*) FILTER (WHERE doc_id % 3 = 0 OR doc_id % 47 = 5) AS n_rejected
FROM jp GROUP BY community_id, platform_id"""


# --- documents and ingestion ---------------------------------------------------------

ORACLE["embed_view"] = f"""WITH {WIKI_FULL_CTE}
SELECT doc_id,
       concat_ws(chr(10) || chr(10),
                 nullif(concat_ws(chr(10), 'contributor_username: ' || contributor_username,
                                  'ref_doc_id: ' || ref_doc_id, 'title: ' || title), ''),
                 text) AS embed_text
FROM wiki_docs"""

ORACLE["llm_view"] = f"""WITH {WIKI_FULL_CTE}
SELECT doc_id,
       concat_ws(chr(10) || chr(10),
                 nullif(concat_ws(chr(10), 'comment: ' || comment,
                                  'contributor_username: ' || contributor_username,
                                  'ref_doc_id: ' || ref_doc_id, 'timestamp: ' || timestamp,
                                  'title: ' || title), ''),
                 text) AS llm_text
FROM wiki_docs"""

ORACLE["single_documents"] = """WITH r AS (
  SELECT 'c' || CAST(conv_id % 10 AS VARCHAR) || '_'
           || coalesce(CASE WHEN conv_id % 2 = 0 THEN NULL WHEN conv_id % 9 = 1 THEN '' ELSE 'col' END,
                       'p' || CAST(conv_id % 4 AS VARCHAR)) AS collection,
         CASE WHEN turn % 7 = 3 THEN NULL ELSE CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) END AS doc_id,
         text, role
  FROM conversations)
SELECT collection, coalesce(doc_id, sha256(concat_ws(chr(1), collection, text))) AS doc_id, text, role,
       'turn' AS excluded_embed, '' AS excluded_llm
FROM r"""

BATCH_CTE = """b AS (
  SELECT CAST(conv_id // 5 AS VARCHAR) || '-' || CAST(turn // 50 AS VARCHAR) AS request_id,
         'c' || CAST((conv_id // 5) % 10 AS VARCHAR) || '_'
           || coalesce(CASE WHEN (conv_id // 5) % 2 = 0 THEN NULL ELSE 'col' END,
                       'p' || CAST((conv_id // 5) % 4 AS VARCHAR)) AS collection,
         CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS doc_id, text, role,
         row_number() OVER (PARTITION BY conv_id // 5, turn // 50 ORDER BY conv_id, turn) - 1 AS position
  FROM conversations)"""

ORACLE["request_documents"] = f"""WITH {BATCH_CTE}
SELECT request_id, collection, doc_id, text, role, position, position // 10 AS batch_id FROM b"""

ORACLE["ingest_batches"] = f"""WITH {BATCH_CTE}
SELECT request_id, position // 10 AS batch_id, count(*) AS n_docs FROM b GROUP BY ALL"""

ORACLE["chunks"] = """WITH t AS (
  SELECT doc_id, trim(regexp_replace(text, '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g')) AS s FROM documents),
k AS (SELECT doc_id, CASE WHEN s = '' THEN []::VARCHAR[] ELSE string_split(s, ' ') END AS tok FROM t),
c AS (SELECT doc_id, tok, unnest(generate_series(0, len(tok) - 1, 512)) AS st FROM k WHERE len(tok) > 0)
SELECT doc_id, st // 512 AS chunk_no, len(list_slice(tok, st + 1, st + 512)) AS n_tokens,
       array_to_string(list_slice(tok, st + 1, st + 512), ' ') AS chunk_text
FROM c"""

ORACLE["upsert"] = """WITH existing AS (
  SELECT 'col_' || lang AS collection, CAST(doc_id AS VARCHAR) AS doc_id, 1 AS version, sha256(text) AS h, 0 AS side
  FROM documents),
incoming AS (
  SELECT 'col_' || lang, CAST(doc_id AS VARCHAR), 2, sha256(text || ' [rev 2]'), 1 FROM documents WHERE doc_id % 3 = 0
  UNION ALL
  SELECT 'col_' || lang, CAST(doc_id AS VARCHAR), 2, sha256(text), 1 FROM documents WHERE doc_id % 5 = 0 AND doc_id % 3 <> 0
  UNION ALL
  SELECT 'new_' || lang, CAST(doc_id AS VARCHAR), 2, sha256(text), 1 FROM documents WHERE doc_id % 7 = 0),
u AS (SELECT * FROM existing UNION ALL SELECT * FROM incoming),
g AS (
  SELECT collection, doc_id, min(side) AS min_side, max(side) AS max_side,
         arg_min(h, side * 1000000 + version) AS h_first, arg_min(version, side * 1000000 + version) AS v_first,
         arg_max(h, side * 1000000 + version) AS h_last, arg_max(version, side * 1000000 + version) AS v_last
  FROM u GROUP BY collection, doc_id),
a AS (
  SELECT *, CASE WHEN max_side = 0 THEN 'keep' WHEN min_side = 1 THEN 'insert'
                 WHEN h_first = h_last THEN 'unchanged' ELSE 'update' END AS action FROM g)
SELECT collection, doc_id,
       CAST(CASE WHEN action IN ('keep', 'unchanged') THEN v_first ELSE v_last END AS BIGINT) AS version,
       CASE WHEN action IN ('keep', 'unchanged') THEN h_first ELSE h_last END AS content_hash,
       action
FROM a"""


# --- staging, load, models, search ---------------------------------------------------

def chunk_sql(src: str, keys: str) -> str:
    """Chunk rows (``keys, chunk_no, n_tokens, chunk_text``) of ``src(keys, text)``."""
    return f"""ck_t AS (
  SELECT {keys}, trim(regexp_replace(text, '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g')) AS s FROM {src}),
ck_k AS (SELECT {keys}, CASE WHEN s = '' THEN []::VARCHAR[] ELSE string_split(s, ' ') END AS tok FROM ck_t),
ck_c AS (SELECT {keys}, tok, unnest(generate_series(0, len(tok) - 1, 512)) AS st FROM ck_k WHERE len(tok) > 0),
chunks AS (
  SELECT {keys}, st // 512 AS chunk_no, len(list_slice(tok, st + 1, st + 512)) AS n_tokens,
         array_to_string(list_slice(tok, st + 1, st + 512), ' ') AS chunk_text
  FROM ck_c)"""


ORACLE["staged_documents"] = f"""WITH {WIKI_FULL_CTE}
SELECT * FROM wiki_docs"""

ORACLE["load_collection"] = f"""WITH {WIKI_FULL_CTE},
wc AS (
  SELECT 'comm' || CAST(c.c_nationkey AS VARCHAR) || '_pf' || CAST(CAST(w.doc_id AS BIGINT) % 100 AS VARCHAR) AS collection,
         w.doc_id, w.text
  FROM wiki_docs w LEFT JOIN customer c ON c.c_custkey = CAST(w.doc_id AS BIGINT) % 100),
{chunk_sql('wc', 'collection, doc_id')}
SELECT collection, doc_id, chunk_no, n_tokens, CAST(1024 AS BIGINT) AS dim FROM chunks"""

ORACLE["embed_default"] = f"""WITH {chunk_sql('documents', 'doc_id')}
SELECT doc_id, chunk_no, CAST(1024 AS BIGINT) AS dim, 1.0::DOUBLE AS norm FROM chunks"""


def _vector_topk_sql() -> str:
    from .adapters import QUERY_VECTOR
    q = "[" + ", ".join(repr(x) for x in QUERY_VECTOR) + "]::DOUBLE[]"
    return f"""WITH q AS (SELECT {q} AS v),
s AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, q.v FROM embeddings, q),
c AS (
  SELECT vec_id, label,
         CASE WHEN sqrt(list_dot_product(e, e)) > 0 AND sqrt(list_dot_product(v, v)) > 0
                    THEN list_dot_product(e, v) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(v, v)))
                    ELSE 0.0 END AS score
  FROM s)
SELECT label, rank, vec_id, round(score, 6) AS score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS BIGINT) AS rank FROM c)
WHERE rank <= 10"""


ORACLE["vector_topk"] = _vector_topk_sql()

ORACLE["vector_topk_requests"] = """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT *, sqrt(list_dot_product(v, v)) AS n FROM e),
s AS (
  SELECT q.vec_id AS query_id, r.vec_id AS id,
         CASE WHEN q.n > 0 AND r.n > 0 THEN list_dot_product(q.v, r.v) / (q.n * r.n) ELSE 0.0 END AS score
  FROM u q JOIN u r ON q.vec_id <> r.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank, id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s)
WHERE rank <= 10"""

ORACLE["extractive_summary"] = f"""WITH {POINTS_CTE},
{PAIRS_CTE},
{digest_core('points', LATEST_THRESHOLD_72H)},
ls AS (SELECT collection, point_id, line FROM lines WHERE line IS NOT NULL),
words AS (
  SELECT collection, point_id, unnest(string_split_regex(lower(line), '[^\\p{{L}}\\p{{N}}]+')) AS w FROM ls),
wf AS (SELECT * FROM words WHERE w <> ''),
tf AS (SELECT collection, w, count(*) AS tf FROM wf GROUP BY ALL),
sc AS (SELECT wf.collection, wf.point_id, sum(tf.tf) AS score FROM wf JOIN tf USING (collection, w) GROUP BY ALL),
scored AS (
  SELECT ls.*, coalesce(sc.score, 0) AS score,
         row_number() OVER (PARTITION BY ls.collection ORDER BY coalesce(sc.score, 0) DESC, ls.point_id) AS rn
  FROM ls LEFT JOIN sc USING (collection, point_id)),
top AS (SELECT collection, string_agg(line, ' ' ORDER BY point_id) AS summary FROM scored WHERE rn <= 3 GROUP BY ALL),
cnt AS (SELECT collection, count(*) AS n_lines FROM ls GROUP BY ALL)
SELECT cnt.collection, cnt.n_lines, top.summary FROM cnt LEFT JOIN top USING (collection)"""

def _rank_rounds(n: int) -> str:
    """Rank tables ``r0`` to ``rN``, one power iteration each."""
    sql = "r0 AS (SELECT doc_id, position, 1000000000::BIGINT AS rank FROM s)"
    for i in range(n):
        sql += f""",
r{i + 1} AS (
  SELECT s.doc_id, s.position, (150000000 + coalesce(g.given, 0))::BIGINT AS rank
  FROM s LEFT JOIN (
    SELECT l.doc_id, l.position, sum((850 * r.rank * l.weight) // (1000 * l.total)) AS given
    FROM links l JOIN r{i} r ON r.doc_id = l.doc_id AND r.position = l.src GROUP BY ALL) g
  ON g.doc_id = s.doc_id AND g.position = s.position)"""
    return sql


ORACLE["extractive_sentences"] = f"""WITH cut AS (
  SELECT doc_id, string_split(regexp_replace(text, '([.!?])[ \\t\\n\\r\\f\\x0B]+', '\\1' || chr(1), 'g'), chr(1)) AS parts FROM documents),
s AS (
  SELECT doc_id, position::BIGINT AS position, trim(parts[position + 1]) AS sentence
  FROM (SELECT doc_id, parts, unnest(range(0, len(parts))) AS position FROM cut) WHERE trim(parts[position + 1]) <> ''),
w AS (
  SELECT DISTINCT doc_id, position, w FROM (
    SELECT doc_id, position, unnest(string_split_regex(lower(sentence), '[^\\p{{L}}\\p{{N}}]+')) AS w FROM s) WHERE w <> ''),
rare AS (SELECT doc_id, w FROM w GROUP BY ALL HAVING count(*) BETWEEN 2 AND 10),
pairs AS (
  SELECT a.doc_id, b.position AS src, a.position, count(*) AS weight
  FROM w a JOIN rare USING (doc_id, w) JOIN w b ON b.doc_id = a.doc_id AND b.w = a.w AND b.position <> a.position GROUP BY ALL),
links AS (SELECT *, sum(weight) OVER (PARTITION BY doc_id, src)::BIGINT AS total FROM pairs),
{_rank_rounds(3)},
top AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.doc_id ORDER BY r3.rank DESC, s.position) AS rn FROM s JOIN r3 USING (doc_id, position)),
n AS (SELECT doc_id, count(*) AS n_sentences FROM s GROUP BY doc_id)
SELECT n.doc_id, n.n_sentences, string_agg(top.sentence, ' ' ORDER BY top.position) AS summary
FROM n JOIN top ON top.doc_id = n.doc_id AND top.rn <= 3 GROUP BY ALL"""

ORACLE["xml_level_split"] = r"""WITH x AS (
  SELECT doc_id, lang, source, regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\r]', '', 'g') AS t FROM documents)
SELECT doc_id, CAST(0 AS BIGINT) AS node_no, '<lang>' || lang || '</lang>' AS content FROM x
UNION ALL
SELECT doc_id, CAST(1 AS BIGINT), '<source>' || source || '</source>' FROM x
UNION ALL
SELECT doc_id, CAST(2 AS BIGINT),
       '<body>' || replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</body>' FROM x"""


# A sitemap lists up to 50 pages; with itself, 19 of them fit into the budget of 20.
ORACLE["website_load"] = f"""WITH addr AS (
  SELECT page_id, regexp_extract(url, '^https?://([^/?#:]+)', 1) AS host, regexp_replace(url, '#.*$', '') AS url,
         {html_text_sql()} AS text FROM pages),
listed AS (SELECT DISTINCT host, page_id // 50 AS part, url FROM addr),
ranked AS (SELECT *, row_number() OVER (PARTITION BY host, part ORDER BY url) AS rn FROM listed),
reached AS (SELECT DISTINCT host, url FROM ranked WHERE rn <= 19),
docs AS (
  SELECT 'web_' || r.host AS collection, a.url AS doc_id, a.text FROM reached r JOIN addr a ON a.url = r.url
  QUALIFY row_number() OVER (PARTITION BY r.host, a.url ORDER BY a.page_id DESC) = 1),
{chunk_sql('docs', 'collection, doc_id')}
SELECT * FROM chunks"""

ORACLE["request_load"] = f"""WITH {BATCH_CTE},
docs AS (SELECT collection, doc_id, text FROM b),
{chunk_sql('docs', 'collection, doc_id')}
SELECT * FROM chunks"""

ORACLE["stream_load"] = f"""WITH d AS ({ORACLE["single_documents"]}),
docs AS (SELECT DISTINCT collection, doc_id, text FROM d),
{chunk_sql('docs', 'collection, doc_id')}
SELECT * FROM chunks"""


# --- streaming --------------------------------------------------------------------

ORACLE["stream_ingest"] = ORACLE["single_documents"]

ORACLE["stream_digest"] = f"""WITH {POINTS_CTE},
w AS (SELECT collection, date_trunc('hour', ts) - to_hours(k) AS ws FROM points, range(0, 4) AS r(k))
SELECT collection, strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(ws + INTERVAL 4 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS n_points
FROM w GROUP BY ALL"""


ORACLE["stream_digest_texts"] = f"""WITH {POINTS_CTE},
w AS (
  SELECT collection, point_id, _node_content AS x, date_trunc('day', ts) - to_days(k) AS ws FROM points, range(0, 2) AS r(k)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY collection, ws ORDER BY point_id) AS rn FROM w),
lines AS (
  SELECT collection, ws, point_id,
         CASE WHEN json_valid(x) AND json_type(x) = 'OBJECT' AND json_exists(x, '$.text')
              THEN coalesce(json_extract_string(x, '$.metadata.author') || ': ', '') || json_extract_string(x, '$.text')
         END AS line
  FROM ranked WHERE rn <= 500)
SELECT collection, strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(ws + INTERVAL 2 DAY, '%Y-%m-%d %H:%M:%S') AS window_end,
       count(*) AS n_points, count(line) AS n_texts,
       coalesce(string_agg(line, {NL} ORDER BY point_id), 'No text content found in the recent data.') AS digest
FROM lines GROUP BY collection, ws"""

LINES_CTE = """parts AS (
  SELECT conv_id, turn, '"text":"turn ' || turn || ' of ' || conv_id || ' by ' || role || '"' AS b,
         '"communityId":"c' || conv_id % 10 || '"' AS community, '"platformId":"p' || conv_id % 4 || '"' AS platform,
         '"metadata":{"turn":"' || turn || '"}' AS meta, '"docId":"' || conv_id || '-' || turn || '"' AS rest, role
  FROM conversations),
lines AS (
  SELECT conv_id, turn, role, CASE turn % 11
    WHEN 4 THEN substr('{' || concat_ws(',', community, platform, b, meta, rest) || '}', 1, 40)
    WHEN 5 THEN '[{' || concat_ws(',', community, platform, b, meta, rest) || '}]'
    WHEN 6 THEN '{' || concat_ws(',', community, b, meta, rest) || '}'
    WHEN 7 THEN '{' || concat_ws(',', '"communityId":' || conv_id, platform, b, meta, rest) || '}'
    WHEN 8 THEN '{' || concat_ws(',', community, platform, b, '"metadata":"none"', rest) || '}'
    WHEN 9 THEN '{' || concat_ws(',', community, platform, meta, rest) || '}'
    ELSE '{' || concat_ws(',', community, platform, b, meta, rest) || '}' END AS value
  FROM parts)"""

ORACLE["stream_rejects"] = f"""WITH {LINES_CTE}
SELECT value, CASE turn % 11 WHEN 4 THEN 'no_json' WHEN 5 THEN 'no_object' WHEN 6 THEN 'missing_platformId' WHEN 7 THEN 'bad_communityId'
                             WHEN 8 THEN 'bad_metadata' ELSE 'missing_text' END AS reason
FROM lines WHERE turn % 11 BETWEEN 4 AND 9"""

ORACLE["stream_intake"] = f"""WITH {LINES_CTE},
docs AS (
  SELECT 'c' || conv_id % 10 || '_p' || conv_id % 4 AS collection, conv_id || '-' || turn AS doc_id,
         'turn ' || turn || ' of ' || conv_id || ' by ' || role AS text
  FROM lines WHERE turn % 11 NOT BETWEEN 4 AND 9),
{chunk_sql('docs', 'collection, doc_id')}
SELECT * FROM chunks"""

ORACLE["stored_summaries"] = ORACLE["summaries_by_date"]

ORACLE["summaries_nested"] = f"""WITH {POINTS_CTE},
ranked AS (
  SELECT collection, date, point_id, _node_content,
         row_number() OVER (PARTITION BY collection, date ORDER BY point_id) AS rn
  FROM points),
p AS (
  SELECT collection, date, point_id,
         CASE WHEN _node_content IS NULL OR NOT json_valid(_node_content) THEN NULL
              WHEN json_type(_node_content) = 'OBJECT' AND json_exists(_node_content, '$.text')
                   THEN json_extract_string(_node_content, '$.text')
              ELSE 'Summary text not found' END AS summary_text
  FROM ranked WHERE rn <= 100)
SELECT collection, date, count(*) AS n_records,
       string_agg(CAST(point_id AS VARCHAR) || '=' || coalesce(summary_text, '-'), '|' ORDER BY point_id) AS records
FROM p GROUP BY collection, date"""

ORACLE["reload_collection"] = f"""WITH v1 AS (
  SELECT 'col_' || lang AS collection, CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents),
v2 AS (
  SELECT 'col_' || lang AS collection, CAST(doc_id AS VARCHAR) AS doc_id, text || ' [rev 2]' AS text
  FROM documents WHERE doc_id % 3 = 0
  UNION ALL
  SELECT 'col_' || lang, CAST(doc_id AS VARCHAR), text FROM documents WHERE doc_id % 5 = 0 AND doc_id % 3 <> 0
  UNION ALL
  SELECT 'new_' || lang, CAST(doc_id AS VARCHAR), text FROM documents WHERE doc_id % 7 = 0),
changed AS (
  SELECT v2.* FROM v2 LEFT JOIN v1 ON v1.collection = v2.collection AND v1.doc_id = v2.doc_id
  WHERE v1.text IS NULL OR v1.text <> v2.text),
final AS (
  SELECT collection, doc_id, text, '2' AS loaded_by FROM changed
  UNION ALL
  SELECT collection, doc_id, text, '1' FROM v1
  WHERE NOT EXISTS (SELECT 1 FROM changed c WHERE c.collection = v1.collection AND c.doc_id = v1.doc_id)),
{chunk_sql('final', 'collection, doc_id, loaded_by')}
SELECT collection, doc_id, chunk_no, n_tokens, loaded_by FROM chunks"""

INCREMENTAL_CTE = """loads AS (
  SELECT 1 AS run, 'col_' || lang AS collection, CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents
  UNION ALL
  SELECT 2, 'col_' || lang, CAST(doc_id AS VARCHAR),
         CASE WHEN doc_id % 11 = 0 THEN ' ' || chr(10) || ' ' WHEN doc_id % 3 = 0 THEN text || ' [rev 2]' ELSE text END
  FROM documents WHERE doc_id % 3 = 0 OR doc_id % 5 = 0 OR doc_id % 11 = 0
  UNION ALL
  SELECT 3, 'col_' || lang, CAST(doc_id AS VARCHAR), text || ' [rev 3]' FROM documents WHERE doc_id % 33 = 0
  UNION ALL
  SELECT 3, 'new_' || lang, CAST(doc_id AS VARCHAR), text FROM documents WHERE doc_id % 13 = 0),
versions AS (
  SELECT *, lag(text) OVER (PARTITION BY collection, doc_id ORDER BY run) AS before FROM loads),
newest AS (
  SELECT collection, doc_id, text, CAST(run AS VARCHAR) AS loaded_by FROM versions
  WHERE before IS NULL OR before <> text
  QUALIFY row_number() OVER (PARTITION BY collection, doc_id ORDER BY run DESC) = 1)"""

ORACLE["load_incremental"] = f"""WITH {INCREMENTAL_CTE},
{chunk_sql('newest', 'collection, doc_id, loaded_by')}
SELECT collection, doc_id, chunk_no, sha256(collection || chr(1) || doc_id || chr(1) || CAST(chunk_no AS VARCHAR)) AS node_id,
       n_tokens, chunk_text, loaded_by FROM chunks"""

ORACLE["load_states"] = f"""WITH {INCREMENTAL_CTE}
SELECT collection, doc_id, CASE WHEN text = ' ' || chr(10) || ' ' THEN 'empty' ELSE 'live' END AS state,
       sha256(text || chr(1)) AS content_hash, loaded_by FROM newest"""

ORACLE["summaries_workflow"] = f"""WITH {POINTS_CTE},
req AS (
  SELECT conv_id AS request_id,
         'c' || CAST(conv_id % 5 AS VARCHAR) AS community_id,
         CASE WHEN conv_id % 13 = 0 THEN '' ELSE 'p' || CAST(conv_id % 3 AS VARCHAR) END AS platform_id,
         CASE conv_id % 3 WHEN 0 THEN 'latest' WHEN 1 THEN 'date' ELSE 'range' END AS kind,
         CASE WHEN conv_id % 3 = 1 THEN '2024-01-' || lpad(CAST(conv_id % 31 + 1 AS VARCHAR), 2, '0') END AS one_date,
         make_date(2024, 1, CAST(CASE WHEN conv_id % 17 = 2 THEN conv_id % 28 + 3 ELSE conv_id % 28 + 1 END AS INTEGER)) AS s,
         make_date(2024, 1, CAST(CASE WHEN conv_id % 17 = 2 THEN conv_id % 28 + 1 ELSE conv_id % 28 + 3 END AS INTEGER)) AS e
  FROM (SELECT DISTINCT conv_id FROM conversations)),
r AS (
  SELECT *, community_id || '_' || platform_id || '_summary' AS collection,
         CASE WHEN platform_id = '' THEN 'no_platform'
              WHEN kind = 'range' AND e < s THEN 'end_before_start' END AS reason
  FROM req),
latest AS (SELECT collection, max(date) AS date FROM points GROUP BY collection),
spine AS (
  SELECT request_id, kind, collection, one_date AS date, NULL AS reason FROM r WHERE reason IS NULL AND kind = 'date'
  UNION ALL
  SELECT request_id, kind, collection,
         strftime(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)), '%Y-%m-%d'),
         NULL
  FROM r WHERE reason IS NULL AND kind = 'range'
  UNION ALL
  SELECT r.request_id, r.kind, r.collection, l.date, NULL
  FROM r LEFT JOIN latest l ON r.collection = l.collection WHERE r.reason IS NULL AND r.kind = 'latest'
  UNION ALL
  SELECT request_id, kind, collection, NULL, reason FROM r WHERE reason IS NOT NULL),
{summary_core('points')}
SELECT s.request_id, s.kind, coalesce(s.reason, 'ok') AS status, s.date,
       CASE WHEN s.reason IS NULL THEN coalesce(p.n_summaries, 0) END AS n_summaries,
       CASE WHEN s.reason IS NULL THEN coalesce(p.summaries, '') END AS summaries
FROM spine s LEFT JOIN per_key p ON s.collection = p.collection AND s.date = p.date"""

ORACLE["stored_requests"] = ORACLE["summaries_workflow"]

ORACLE["staged_extracted"] = ORACLE["crawled_pages"]
