"""DuckDB twins of the queries that SQL can express.

The others (tokenizers, fingerprints, trained models) are tested against
brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

# Fixed value: the characters that DuckDB's translate() is to lower.
LOWERED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = "regexp_extract_all(" + LOWERED + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
win AS (
  SELECT item, w[s:s + least(len(w), 13) - 1] AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
wins AS (SELECT DISTINCT item, len(win) AS n, array_to_string(win, ' ') AS win FROM win),
sizes AS (SELECT DISTINCT n FROM wins),
spots AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
hits AS (
  SELECT p.doc_id, p.s, p.n, x.item FROM (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win FROM spots) p
  JOIN wins x ON x.n = p.n AND x.win = p.win),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS pos FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(d.w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Base 32 of the SHA-1 in hex: five hex digits are four symbols.
_SYMBOL = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 5 * g + 1, 5))::BIGINT >> {0}) & 31)::INT + 1, 1)"
WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
last AS (SELECT html, max(page_id) AS last FROM p GROUP BY html)
SELECT page_id, strlen(p.html)::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(8), lambda g: {" || ".join(_SYMBOL.format(n) for n in (15, 10, 5, 0))}), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
FROM p JOIN last ON last.html = p.html
"""

# op6: words are runs without ASCII white space; a line counts once for each distinct text of a host.
LINE_FREQUENCY = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
five AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n
  FROM (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS win
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d))),
repeated AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS pos FROM five WHERE n > 1) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, text, line,
    regexp_replace(array_to_string(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+'), ' '), '[0-9]', '0', 'g') AS norm,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d)),
real AS (SELECT * FROM lines WHERE n > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM real GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT text) AS docs FROM d GROUP BY source),
seen AS (SELECT source, norm, count(DISTINCT text) AS n FROM real GROUP BY source, norm),
above AS (SELECT s.source, s.norm FROM seen s JOIN hosts h ON h.source IS NOT DISTINCT FROM s.source 
  WHERE s.n >= 5 AND (s.n > 20 OR s.n > h.docs * 0.02)),
gone AS (
  SELECT r.doc_id, sum(r.n) AS words, count(DISTINCT r.norm) AS lines
  FROM real r JOIN above a ON a.source IS NOT DISTINCT FROM r.source AND a.norm = r.norm GROUP BY r.doc_id),
m AS (
  SELECT d.doc_id, len(d.w)::BIGINT AS n_words, length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
    coalesce(gone.lines, 0)::BIGINT AS n_lines_removed, (len(d.w) - coalesce(gone.words, 0))::BIGINT AS n_words_left
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words_left >= n_words * 0.3 AS kept
FROM m
"""


def _jump(shards: int) -> str:
    """Jump hash as a reduction over steps; HUGEINT holds the 64-bit product."""
    return f"""list_reduce(list_prepend({{'k': doc_id::HUGEINT, 'b': -1::BIGINT, 'j': 0::BIGINT}},
    list_transform(range({shards}), lambda i: {{'k': 0::HUGEINT, 'b': 0::BIGINT, 'j': 0::BIGINT}})),
    lambda s, x: CASE WHEN s.j < {shards} THEN {{'k': (s.k * 2862933555777941757 + 1) % 18446744073709551616, 'b': s.j,
      'j': floor((s.j + 1) * (2147483648.0::DOUBLE / ((((s.k * 2862933555777941757 + 1) % 18446744073709551616) // 8589934592) + 1)::DOUBLE))::BIGINT}}
    ELSE s END).b::INT"""


SHARDING = f"""
WITH RECURSIVE crc(i, k, v) AS (
  SELECT i, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM crc WHERE k = 8),
d AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
  list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda c: ('0x' || c)::BIGINT) AS bytes FROM documents),
s AS (SELECT doc_id, size::BIGINT AS size,
  xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)::BIGINT AS text_crc32,
  {_jump(8)} AS shard, {_jump(9)} AS grown_shard FROM d, tab)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM s
"""

# op11: counts of every kept term and group, also zero.
DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
o AS (SELECT id, lang, source, unnest(w) AS t FROM d),
kept AS (SELECT lang, t, count(*) AS n FROM o GROUP BY lang, t HAVING count(DISTINCT id) >= 3),
seen AS (SELECT o.lang, source, t, count(*) AS n FROM o SEMI JOIN kept k ON k.lang = o.lang AND k.t = o.t GROUP BY o.lang, source, t),
g AS (
  SELECT x.lang, x.source, coalesce(n, 0) AS n, coalesce(v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) x
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM seen GROUP BY lang, source) s ON s.lang = x.lang AND s.source = x.source
  LEFT JOIN (SELECT lang, count(*) AS v FROM kept GROUP BY lang) l ON l.lang = x.lang),
p AS (
  SELECT g.lang, g.source, k.t, coalesce(s.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(s.n, 0) + 1)) // (g.n + g.v) AS p
  FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.t = k.t),
q AS (
  SELECT k.lang, k.t, 1 + (1000000000::HUGEINT * (k.n + 1)) // (l.n + l.v) AS q
  FROM kept k JOIN (SELECT lang, sum(n) AS n, any_value(v) AS v FROM g GROUP BY lang) l ON l.lang = k.lang),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f, 0) AS value
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS other, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS f
    FROM p x JOIN p y ON y.lang = x.lang AND y.t = x.t AND y.source <> x.source GROUP BY x.lang, x.source, y.source) s
  ON s.lang = a.lang AND s.source = a.source AND s.other = b.source),
terms AS (
  SELECT p.lang, p.source, p.t AS item, ((p.p - q.q) * (p.p - q.q)) // q.q AS value FROM p JOIN q ON q.lang = p.lang AND q.t = p.t WHERE p.n > 0 AND p.p > q.q),
both_parts AS (SELECT 'pair' AS part, * FROM pairs UNION ALL SELECT 'term', * FROM terms),
ranked AS (SELECT *, row_number() OVER (PARTITION BY part, lang, source ORDER BY value DESC, item) AS rank FROM both_parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

# op12: pieces, words, and every phrase's count by itself.
COLLOCATION = r"""
WITH p AS (
  SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
one AS (SELECT lang, w[i] AS x, count(*) AS f FROM s GROUP BY 1, 2),
two AS (SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS f FROM s WHERE i < len(w) GROUP BY 1, 2, 3 HAVING count(*) >= 10),
three AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS f FROM s WHERE i + 1 < len(w) GROUP BY 1, 2, 3, 4 HAVING count(*) >= 10),
longer AS (SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM three UNION ALL SELECT lang, y, z, f FROM three) GROUP BY 1, 2, 3),
cuts AS (
  SELECT t.lang, t.x || ' ' || t.y AS phrase, t.f AS a, 1 AS k, u.f AS l, v.f AS r
  FROM two t JOIN one u ON u.lang = t.lang AND u.x = t.x JOIN one v ON v.lang = t.lang AND v.x = t.y
  LEFT JOIN longer g ON g.lang = t.lang AND g.x = t.x AND g.y = t.y WHERE 100 * coalesce(g.f, 0) < 50 * t.f
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 1, u.f, v.f
  FROM three t JOIN one u ON u.lang = t.lang AND u.x = t.x JOIN two v ON v.lang = t.lang AND v.x = t.y AND v.y = t.z
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 2, u.f, v.f
  FROM three t JOIN two u ON u.lang = t.lang AND u.x = t.x AND u.y = t.y JOIN one v ON v.lang = t.lang AND v.x = t.z),
scored AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cuts),
least_cut AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
n AS (SELECT lang, sum(f) AS n FROM one GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM least_cut JOIN n USING (lang) QUALIFY rank <= 2000
"""

ORACLE = {
    "op2_decontamination": DECONTAMINATION,
    "op3_warc_index": WARC,
    "op6_line_frequency": LINE_FREQUENCY,
    "op10_jump_sharding": SHARDING,
    "op11_source_divergence": DIVERGENCE,
    "op12_collocations": COLLOCATION,
}
