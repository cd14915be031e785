"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {}

ORACLES["op1_quality_rules"] = rf"""
WITH texts AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ls
  FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(ws[p:p + 7], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS p FROM texts WHERE len(ws) >= 8)),
again AS (SELECT doc_id, p FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM again) GROUP BY doc_id),
measured AS (
  SELECT x.doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM texts x LEFT JOIN covered c ON x.doc_id = c.doc_id),
ruled AS (
  SELECT *, n_words < 20 AS few_words, 100 * n_repeat_words > 30 * n_words AS repeats,
         100 * n_symbols > 10 * word_chars AS symbols, 100 * n_dup_lines > 30 * n_lines AS dup_lines
  FROM measured),
rates AS (
  UNPIVOT (SELECT source, count(*) AS n, count(*) FILTER (few_words) AS few_words, count(*) FILTER (repeats) AS repeats,
                  count(*) FILTER (symbols) AS symbols, count(*) FILTER (dup_lines) AS dup_lines
           FROM ruled GROUP BY source)
  ON few_words, repeats, symbols, dup_lines INTO NAME rule VALUE k),
prior AS (SELECT rule, avg(k / n) AS m, var_pop(k / n) AS v, avg(1 / n) AS inv FROM rates GROUP BY rule),
fitted AS (
  SELECT rule, m, CASE WHEN greatest(v - m * (1 - m) * inv, 0) * 1e6 > m * (1 - m)
                       THEN greatest(m * (1 - m) / greatest(v - m * (1 - m) * inv, 0) - 1, 0) ELSE 1e6 END AS s
  FROM prior),
hosts AS (
  SELECT source, bool_or((k + s * m) / (n + s) > 0.5) AS host_failed FROM rates JOIN fitted USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (few_words OR repeats) AS base_failed,
       NOT (few_words OR repeats) AND NOT host_failed AS kept, host_failed
FROM ruled r JOIN hosts h ON r.source IS NOT DISTINCT FROM h.source
"""

ORACLES["op7_line_dedup"] = rf"""
WITH lines AS (
  SELECT rowid_ AS r, doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS p
  FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents)),
pages AS (SELECT source, count(DISTINCT coalesce(text, '')) AS n FROM documents GROUP BY source),
firsts AS (SELECT min(rowid_) AS r FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents) GROUP BY source, coalesce(text, '')),
common AS (
  SELECT l.source, line FROM (SELECT DISTINCT r, source, line FROM lines SEMI JOIN firsts USING (r) WHERE regexp_matches(line, '{_WORD}')) l
  JOIN pages g ON l.source IS NOT DISTINCT FROM g.source
  GROUP BY l.source, line, n HAVING count(*) > 0.1 * (n + 20))
SELECT any_value(l.doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(c.line)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY p) FILTER (c.line IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN common c ON l.source IS NOT DISTINCT FROM c.source AND l.line = c.line
GROUP BY r
"""

ORACLES["op5_substring_dedup"] = rf"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
windows AS (
  SELECT doc_id, p, md5(array_to_string(ws[p:p + 19], ' ')) AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS p FROM texts WHERE len(ws) >= 20)),
again AS (SELECT doc_id, p FROM windows QUALIFY row_number() OVER (PARTITION BY gram ORDER BY doc_id, p) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM again),
placed AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS q FROM texts),
kept AS (
  SELECT p.doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY q) AS t
  FROM placed p ANTI JOIN gone g USING (doc_id, q) GROUP BY p.doc_id)
SELECT x.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM texts x LEFT JOIN kept USING (doc_id)
"""

ORACLES["op6_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
t AS (SELECT *, max(page_id) OVER (PARTITION BY h, n) AS top FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM t
"""

# Bids of equal weight fall as hashes rise, so the largest hash wins. The checksum goes through the bytes by a table of 256.
_BIDS = "list_transform(range({n}), lambda s: ('0x' || substr(md5(concat(coalesce(doc_id::VARCHAR, ''), '@', s)), 1, 13))::BIGINT)"
ORACLES["op12_sharding"] = f"""
WITH steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS t),
bytes AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
                 list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS b FROM documents),
summed AS (SELECT doc_id, size::BIGINT AS size,
                  xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS text_crc32 FROM bytes, steps),
placed AS (SELECT *, {_BIDS.format(n=8)} AS old, {_BIDS.format(n=9)} AS grown,
                  ('0x' || substr(md5(concat(coalesce(doc_id::VARCHAR, ''), '/', size, '/', text_crc32)), 1, 13))::BIGINT AS o FROM summed),
sharded AS (SELECT *, list_position(old, list_max(old)) - 1 AS shard, list_position(grown, list_max(grown)) - 1 AS grown_shard FROM placed)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY o, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard::INTEGER AS grown_shard
FROM sharded
"""
