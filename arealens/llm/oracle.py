"""DuckDB statements for the corpus queries that SQL can express."""

from __future__ import annotations

from .secrets import ACCESS, ASSIGN, COMPLETES, ENDPOINT, HEX, IDENT, KINDS, OPAQUE

_QUOTE = "'" * 2


def _kind(order: int, pattern: str, keep: str = "TRUE") -> str:
    """Matches of one pattern with their offsets: pieces between matches add up."""
    p = pattern.replace("'", _QUOTE)
    return f"""
SELECT rid, {order} AS o, pos AS a, pos + length(hit) AS b FROM (
  SELECT rid, hits[i] AS hit,
         list_sum(list_transform(gaps[1:i], lambda x: length(x)))
         + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS pos
  FROM (SELECT rid, gaps, hits, unnest(generate_series(1, len(hits))) AS i
        FROM (SELECT rid, regexp_split_to_array(t, '{p}') AS gaps, regexp_extract_all(t, '{p}', 0) AS hits FROM d))
) WHERE {keep}"""


_ASSIGN = ASSIGN.replace("'", _QUOTE)
_MIXED = "regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[0-9]')"
_COMPLETES = " OR ".join(
    f"(w.o = {KINDS.index(k)} AND p.o IN ({', '.join(str(KINDS.index(c)) for c in kinds)}))"
    for k, kinds in COMPLETES.items())
_NAME = "[" + ", ".join(f"'{k}'" for k in KINDS) + "][o + 1]"
_LINE = f"string_agg({_NAME} || ':' || CAST(CAST(a AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(b AS BIGINT) AS VARCHAR), ',' ORDER BY a, o)"

SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join([
    _kind(0, ASSIGN, f"length(regexp_extract(hit, '{_ASSIGN}', 2)) >= 6"), _kind(1, ACCESS), _kind(2, HEX),
    _kind(3, IDENT), _kind(4, OPAQUE, _MIXED), _kind(5, ENDPOINT)])}),
kept AS (
  SELECT * FROM s WHERE o < 3
  UNION ALL
  SELECT * FROM s w WHERE o >= 3 AND EXISTS (
    SELECT 1 FROM s p WHERE p.rid = w.rid AND p.a <= w.b + 200 AND p.b >= w.a - 200 AND ({_COMPLETES}))),
sums AS (
  SELECT rid, count(*) FILTER (WHERE o = 0) AS n_assign, count(*) FILTER (WHERE o = 1) AS n_access,
         count(*) FILTER (WHERE o = 2) AS n_hex, {_LINE} FILTER (WHERE o < 3) AS base,
         {_LINE} AS spans
  FROM kept GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN sums USING (rid)"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
x AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
             CASE WHEN strlen(html) >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN last IS NULL OR last IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN last IS DISTINCT FROM page_id THEN last END AS refers_to
FROM x"""

_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("text")} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format("text")} AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item, least(len(w), 10) AS m,
         array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS s FROM i WHERE len(w) > 0)),
dw AS (
  SELECT rid, m, s, array_to_string(w[s:s + m - 1], ' ') AS win
  FROM (SELECT rid, w, m, unnest(generate_series(1, len(w) - m + 1)) AS s
        FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m)),
hits AS (SELECT rid, m, s, item FROM dw JOIN iw USING (m, win)),
words AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (
  SELECT rid, unnest(generate_series(s, s + m - 1)) AS pos FROM (SELECT DISTINCT rid, m, s FROM hits)) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN named USING (rid)"""

_SHARE = "1 + (1000000000::HUGEINT * ({0} + 2)) // ({1} + 2 * v)"
_DISTANCE = "(({0}) - ({1})) * (({0}) - ({1})) // (({0}) + ({1}))"

# Counts of every kept term in every group, zeros included, then shares and their distances.
DIVERGENCE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
o AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM (SELECT DISTINCT rid, lang, term FROM o) GROUP BY lang, term HAVING count(*) >= 10),
sized AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
seen AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM o JOIN kept USING (lang, term) GROUP BY ALL),
counts AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c FROM groups g JOIN kept k USING (lang)
           LEFT JOIN seen s ON s.lang = g.lang AND s.source = g.source AND s.term = k.term),
shares AS (SELECT lang, source, term, c, {_SHARE.format("c", "sum(c) OVER (PARTITION BY lang, source)")} AS p
           FROM counts JOIN sized USING (lang)),
whole AS (SELECT lang, term, {_SHARE.format("c", "sum(c) OVER (PARTITION BY lang)")} AS q
          FROM (SELECT lang, term, sum(c) AS c FROM counts GROUP BY ALL) JOIN sized USING (lang)),
far AS (SELECT a.lang, a.source, b.source AS item, sum({_DISTANCE.format("a.p", "b.p")}) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT s.lang, s.source, s.term AS item, {_DISTANCE.format("p", "q")} AS value
          FROM shares s JOIN whole USING (lang, term) WHERE c > 0 AND p > q),
every AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
          UNION ALL SELECT lang, source, 'term', item, value FROM terms),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR r <= 10"""

ORACLES = {"op3_secret_scan": SECRETS, "op5_warc_chunks": WARC, "op8_winnow_decontamination": DECONTAMINATION,
           "op12_source_divergence": DIVERGENCE}
