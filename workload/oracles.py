"""The same results in DuckDB SQL, worked out from the driver's tables."""

from __future__ import annotations

from workload.queries import (
    ARCHIVE_PAGES,
    BATCH,
    LATEST,
    LINK_RULES,
    NOW,
    REPLAY_SINCE,
    RETENTION_NOW,
    STEP,
)

# The auction site's name, address and URL patterns, written out apart from the engine's.
GRAPH = "https://graph.example.com/n/"
NAME, HOME = "litfund", "https://www.litfund.ru"
ID = "[0-9]+([.s][0-9]+)?"
GROUP, LOT = f"/auction/({ID})/", f"/auction/{ID}/[0-9]+[a-z]?/"
CATALOG = f"/auction/{ID}/([?]|$)"
ENTRY = f"^https?://(www[.])?litfund[.]ru/auction/{ID}/[0-9]+[a-z]?/$"
MONTHS = "['января','февраля','марта','апреля','мая','июня','июля','августа','сентября','октября','ноября','декабря']"

RAW = f"""
raw0 AS (
  SELECT page_id, TIMESTAMP '2024-01-01' + to_minutes(page_id * 37) AS fetched_at, '{NAME}' AS spider,
    CASE page_id % 5 WHEN 0 THEN '{HOME}/auction/' || page_id // 10 || '/'
      WHEN 1 THEN '{HOME}/auction/' || page_id // 10 || '/?page=2'
      WHEN 4 THEN '{HOME}/auction/archives/?page=1'
      ELSE '{HOME}/auction/' || page_id // 10 || '/' || (page_id % 2 + 1) || '/' END AS url,
    CASE WHEN page_id % 11 = 0 THEN 404 WHEN page_id % 17 = 0 THEN 503 ELSE 200 END AS http_status,
    html || CASE WHEN page_id % 3 <> 0 THEN '<b data-lf-microdata="lot-name">Lot ' || page_id || '</b>' ELSE '' END AS whole
  FROM pages),
raw AS (
  SELECT page_id, fetched_at, spider, url, http_status,
    CASE WHEN page_id % 13 = 0 THEN left(whole, 200) ELSE whole END AS body FROM raw0)"""

AUCTIONS = f"""
auction_rec AS (
  SELECT o_orderkey::VARCHAR AS auction_id, '{HOME}/auction/' || o_orderkey || '/' AS url, o_orderdate AS source_fetched_at,
    o_orderdate AS parsed_at, strftime(o_orderdate, '%Y-%m-%d') AS date_iso,
    CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'через 3 дня' ELSE 'unknown' END AS status
  FROM orders
  UNION ALL
  SELECT o_orderkey::VARCHAR, '{HOME}/auction/' || o_orderkey || '/', o_orderdate, o_orderdate + INTERVAL 1 DAY, '', 'unknown'
  FROM orders WHERE o_orderkey % 3 = 0),
auction_roll AS (
  SELECT auction_id,
    CASE WHEN bool_or(status = 'completed') THEN 'completed'
      ELSE arg_max(status, {{'t': parsed_at, 'f': source_fetched_at, 'v': status}}) END AS status,
    coalesce(arg_max(date_iso, {{'t': parsed_at, 'f': source_fetched_at, 'v': date_iso}}) FILTER (WHERE date_iso <> ''), '') AS date_iso,
    arg_max(date_iso, {{'t': parsed_at, 'f': source_fetched_at, 'v': date_iso}}) AS newest_date,
    max(parsed_at) AS last_parsed_at
  FROM auction_rec GROUP BY auction_id)"""

ITEMS = f"""
item_rec AS (
  SELECT l_orderkey::VARCHAR AS auction_id, l_linenumber::VARCHAR AS lot_number, l_shipdate AS parsed_at, l_shipdate AS source_fetched_at,
    'Лот ' || l_linenumber AS lot_index, 'Part ' || l_partkey AS title,
    CASE WHEN l_suppkey % 2 = 0 THEN '' ELSE 'From ' || l_suppkey END AS description,
    l_extendedprice::DECIMAL(18,2)::VARCHAR || ' ₽' AS start_price,
    CASE WHEN l_linestatus = 'O' THEN l_extendedprice::DECIMAL(18,2)::VARCHAR || ' ₽' ELSE '' END AS leading_bid,
    CASE WHEN l_returnflag <> 'N' THEN l_extendedprice::DECIMAL(18,2)::VARCHAR || ' ₽' ELSE '' END AS final_price,
    l_returnflag = 'R' AS reserve_not_met, l_quantity::INT::VARCHAR AS views,
    CASE WHEN l_linenumber % 2 = 0 THEN '/img/' || l_partkey || '.jpg' ELSE '' END AS images,
    '{HOME}/auction/' || l_orderkey || '/' || l_linenumber || '/' AS source_url
  FROM lineitem)"""


def _latest(name: str, when: str | None = None) -> str:
    when = when or f"{name} <> ''"
    return f"coalesce(arg_max({name}, {{'t': parsed_at, 'f': source_fetched_at, 'v': {name}}}) FILTER (WHERE {when}), '') AS {name}"


def _digits(name: str) -> str:
    return f"try_cast(regexp_replace({name}, '[^0-9]', '', 'g') AS BIGINT)"


_FILLED = ("lot_index", "title", "description", "start_price", "leading_bid", "final_price", "views", "images", "source_url")
FACTS = f"""
item_agg AS (
  SELECT auction_id, lot_number, {', '.join(_latest(n) for n in _FILLED)},
    coalesce(arg_max(reserve_not_met, {{'t': parsed_at, 'f': source_fetched_at, 'v': reserve_not_met}}) FILTER (WHERE final_price <> ''), false) AS reserve_not_met,
    max(parsed_at) AS last_parsed_at
  FROM item_rec GROUP BY auction_id, lot_number),
facts AS (
  SELECT i.auction_id, lot_number, lot_index, title, description, {_digits('start_price')} AS start_price,
    {_digits('leading_bid')} AS leading_bid, {_digits('final_price')} AS final_price, reserve_not_met,
    {_digits('views')} AS views, images, source_url, try_cast(nullif(a.newest_date, '') AS DATE) AS auction_date,
    i.last_parsed_at, i.last_parsed_at AS last_source_fetched_at,
    try_cast(regexp_extract(i.auction_id, '^[0-9]+') AS BIGINT) AS auction_id_num, final_price <> '' AS has_final,
    {_digits('final_price')}::DOUBLE / nullif({_digits('start_price')}, 0)::DOUBLE AS final_to_start_ratio
  FROM item_agg i LEFT JOIN auction_roll a USING (auction_id))"""

FETCHES = f"""
fetch_roll AS (
  SELECT regexp_extract(url, '{GROUP}', 1) AS auction_id, count(*) AS pages_fetched,
    count_if(http_status <> 200)::BIGINT AS http_errors, max(fetched_at) AS last_fetched_at
  FROM raw WHERE regexp_matches(url, '{GROUP}') GROUP BY 1)"""
LOTS = "lot_roll AS (SELECT auction_id, count(DISTINCT lot_number) AS lots_parsed FROM item_rec GROUP BY 1)"
COVERAGE = """
cover AS (
  SELECT a.auction_id, a.status, a.date_iso, try_cast(nullif(a.date_iso, '') AS DATE) AS auction_date,
    coalesce(l.lots_parsed, 0) AS lots_parsed, a.last_parsed_at, coalesce(f.pages_fetched, 0) AS pages_fetched,
    coalesce(f.http_errors, 0) AS http_errors, f.last_fetched_at,
    coalesce(l.lots_parsed, 0) = 36 AND coalesce(f.pages_fetched, 0) <= 1 AS likely_truncated
  FROM auction_roll a LEFT JOIN lot_roll l USING (auction_id) LEFT JOIN fetch_roll f USING (auction_id))"""
TYPED = f"""
typed AS (
  SELECT *, CASE WHEN regexp_matches(url, '{LOT}') THEN 'lot' WHEN regexp_matches(url, '{CATALOG}') THEN 'catalog'
    ELSE 'other' END AS page_type, nullif(regexp_extract(url, '{GROUP}', 1), '') AS auction_id FROM raw)"""
COUNTS = """count_if(http_status = 200)::BIGINT AS ok_200, count_if(http_status <> 200)::BIGINT AS errors,
  round_even(count_if(http_status <> 200) / count(*), 4) AS error_rate, count_if(page_type = 'lot')::BIGINT AS lots,
  count_if(page_type = 'catalog')::BIGINT AS catalogs, count_if(page_type = 'other')::BIGINT AS archive_other"""
GATE = f"""
gate AS (
  SELECT *, CASE WHEN http_status NOT BETWEEN 200 AND 299 THEN NULL
      WHEN strlen(body) < 500 THEN 'empty/short body (' || strlen(body) || ' bytes)'
      WHEN regexp_matches(url, '{LOT}') AND NOT contains(body, 'data-lf-microdata') THEN 'lot page missing lot microdata'
    END AS reason,
    CASE WHEN http_status NOT BETWEEN 200 AND 299 THEN NULL WHEN strlen(body) < 500 THEN true
      WHEN regexp_matches(url, '{LOT}') AND NOT contains(body, 'data-lf-microdata') THEN false END AS retryable
  FROM raw)"""
GOOD_LOT = "page_id % 5 IN (2, 3) AND page_id % 3 <> 0 AND page_id % 13 <> 0"
LOT_FIELDS = (
    """'{"auction_id":"' || page_id // 10 || '","description":"","images":[],"lot_index":"","lot_number":"' || (page_id % 2 + 1)"""
    """ || '","source_url":"' || url || '","start_price":"","title":"Lot ' || page_id || '","type":"item","views":""}'"""
)
AUCTION_FIELDS = (
    """'{"auction_id":"' || auction_id || '","date_iso":"' || date_iso || '","status":"' || status || '","type":"auction"}'"""
)
EDGES = """
hrefs AS (
  SELECT page_id, url AS src_url, unnest(l) AS href, generate_subscripts(l, 1) AS i
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages)),
edges AS (
  SELECT page_id, src_url, min(i) AS i,
    regexp_extract(src_url, '^(https?://[^/]+)', 1) || replace(replace(url_encode(href), '%2F', '/'), '%2C', ',') AS dst_url
  FROM hrefs GROUP BY ALL)"""
_EDGE_GROUP = EDGES.replace("GROUP BY ALL", "GROUP BY page_id, src_url, href")
EVENTS = """
ev AS (SELECT event_type AS spider, 'https://example.org/e/' || event_id AS url, props AS body,
  date_trunc('hour', ts) AS fetched_at FROM events)"""
ARCHIVE = """
arch AS (
  SELECT o_orderkey // 36 + 1 AS page, o_orderkey AS key,
    (CASE WHEN (o_orderkey // 36 + 1) % 997 = 0 THEN o_orderkey - 36 ELSE o_orderkey END)::VARCHAR AS shown FROM orders),
placed AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY key) - 1 AS pos FROM arch)"""
CANDIDATES = f"""{ARCHIVE},
first_seen AS (SELECT shown AS auction_id, min(page * 4294967296 + pos) AS place FROM placed GROUP BY 1),
stop AS (SELECT coalesce(min(p), {ARCHIVE_PAGES + 1}) AS s FROM range(1, {ARCHIVE_PAGES + 1}) t(p)
  WHERE p NOT IN (SELECT place // 4294967296 FROM first_seen)),
cand AS (
  SELECT row_number() OVER (ORDER BY place)::INT AS rank, auction_id FROM first_seen, stop
  WHERE place < s * 4294967296 ORDER BY place LIMIT {LATEST})"""
LINKS = f"""
crawl AS (
  SELECT '{HOME}/p/' || page_id AS src_url, u.i AS pos, u.d AS dst_url FROM pages, LATERAL (VALUES
    (0, '{HOME}/auction/' || page_id // 10 || '/' || (page_id % 4 + 1) || '/'),
    (1, '{HOME}/auction/' || page_id // 10 || '/?page=' || (page_id % 3 + 1)),
    (2, '{HOME}/auction/' || page_id // 10 || '/'),
    (3, 'https://other.example.org/auction/' || page_id // 10 || '/'),
    (4, '{HOME}/auction/rules/')) u(i, d))"""
STORED = f"""
good AS (SELECT DISTINCT url FROM raw WHERE http_status = 200 AND contains(body, 'data-lf-microdata')
  AND regexp_matches(url, '{ENTRY}')),
heal AS (SELECT url FROM raw WHERE regexp_matches(url, '{ENTRY}') GROUP BY url
  HAVING NOT bool_or(contains(body, 'data-lf-microdata')))"""
PARSED_LOTS = f"""SELECT '{NAME}' AS spider, url, fetched_at AS source_fetched_at, 'item' AS record_type,
  date_trunc('month', fetched_at)::DATE AS source_month, {LOT_FIELDS} AS fields FROM raw WHERE {GOOD_LOT}"""
LANDED = f"""WITH {RAW} SELECT fetched_at, spider, url, http_status, contains(body, 'data-lf-microdata') AS has_marker,
  strlen(body)::INT AS body_bytes, date_trunc('month', fetched_at)::DATE AS fetch_month FROM raw"""

REFETCHED = f"""
fetched AS (
  SELECT c_custkey, v, TIMESTAMP '2024-01-10' + to_days((v * 25)::INT) AS fetched_at,
    ['Z old', 'M mid', 'A new'][v + 1] || ' ' || c_custkey AS title, ['900', '1200', '1000'][v + 1] AS start_price
  FROM customer, range(3) r(v))"""

# RE2 spells Unicode whitespace out; the four separators are whitespace to the engine as well.
SPACE = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]"

QUOTE_RECORDS = """SELECT 'https://quotes.toscrape.com/page/' || conv_id || '/?turn=' || turn AS url, trim(line) AS text,
      role AS author, role || ',turn&' || turn AS tags FROM (SELECT *, unnest(string_split(text, chr(10))) AS line FROM conversations)
      UNION ALL SELECT 'https://quotes.toscrape.com/page/' || conv_id || '/?turn=' || turn, '', '', '' FROM conversations"""

ORACLES: dict[str, str] = {
    "item_facts": f"WITH {AUCTIONS}, {ITEMS}, {FACTS} SELECT * FROM facts",
    "overview": f"""WITH {AUCTIONS}, {ITEMS}, {LOTS},
      j AS (SELECT a.auction_id, a.status, coalesce(l.lots_parsed, 0) AS n FROM auction_roll a LEFT JOIN lot_roll l USING (auction_id))
      SELECT count(*) AS total_auctions, count_if(status = 'completed')::BIGINT AS completed_auctions,
        count_if(status <> 'completed')::BIGINT AS upcoming_auctions, sum(n)::BIGINT AS total_lots,
        round_even(avg(n), 1) AS avg_lots_per_auction, max(n) AS max_lots_per_auction,
        count_if(n > 0)::BIGINT AS auctions_with_lots, count_if(n = 0)::BIGINT AS auctions_without_lots,
        round_even(avg(n) * count(*), 0)::BIGINT AS estimated_total_lots,
        (SELECT max(p) FROM (SELECT max(parsed_at) AS p FROM auction_rec UNION ALL SELECT max(parsed_at) FROM item_rec)) AS last_parsed_at
      FROM j""",
    "auction_status_sticky": f"WITH {AUCTIONS} SELECT auction_id, status, date_iso, last_parsed_at FROM auction_roll",
    "lots_per_auction": f"WITH {ITEMS}, {LOTS} SELECT * FROM lot_roll",
    "auction_coverage": f"WITH {RAW}, {AUCTIONS}, {ITEMS}, {LOTS}, {FETCHES}, {COVERAGE} SELECT * FROM cover",
    "truncation_flag": f"""WITH {RAW}, {FETCHES} SELECT o_orderkey::VARCHAR AS auction_id, o_orderkey % 3 + 35 AS lots_parsed,
      coalesce(pages_fetched, 0) AS pages_fetched, o_orderkey % 3 = 1 AND coalesce(pages_fetched, 0) <= 1 AS likely_truncated
      FROM orders LEFT JOIN fetch_roll ON auction_id = o_orderkey::VARCHAR""",
    "fetch_rollup": f"WITH {RAW}, {FETCHES} SELECT * FROM fetch_roll",
    "page_type": f"WITH {RAW}, {TYPED} SELECT url, fetched_at, page_type, auction_id FROM typed",
    "health_daily": f"""WITH {RAW}, {TYPED} SELECT fetched_at::DATE AS fetch_date, count(*) AS pages_fetched, {COUNTS},
      count(DISTINCT auction_id) AS distinct_auctions_touched FROM typed GROUP BY 1""",
    "health_overall": f"""WITH {RAW}, {TYPED} SELECT count(*) AS total_pages, {COUNTS}, min(fetched_at) AS first_fetched_at,
      max(fetched_at) AS last_fetched_at FROM typed""",
    "view_sql": f"""WITH {RAW}, {AUCTIONS}, {ITEMS}, {LOTS}, {FETCHES}, {COVERAGE}, {FACTS}
      SELECT c.status, count(*) AS lots, count_if(i.has_final)::BIGINT AS sold, sum(i.final_price)::BIGINT AS final_total,
        count(DISTINCT i.auction_id) AS auctions FROM facts i JOIN cover c USING (auction_id) GROUP BY c.status""",
    "jsonl_coerce": f"""SELECT CASE page_id % 4 WHEN 3 THEN TIMESTAMP '{NOW}'
        ELSE TIMESTAMP '2024-01-01' + to_minutes(page_id * 37) - to_hours(CASE page_id % 4 WHEN 0 THEN 3 ELSE 0 END) END AS fetched_at,
      CASE WHEN page_id % 5 < 2 THEN 'fallback' ELSE 'shop' END AS spider, CASE WHEN page_id % 6 <> 0 THEN url ELSE '' END AS url,
      CASE WHEN page_id % 7 <> 0 THEN page_id % 3 * 100 + 200 ELSE 0 END::INT AS http_status,
      CASE WHEN page_id % 3 <> 0 THEN 'text/html' ELSE '' END AS content_type,
      CASE WHEN page_id % 3 <> 0 THEN 1 ELSE 0 END::INT AS headers,
      md5(CASE WHEN page_id % 8 <> 0 THEN html ELSE '' END) AS body_md5,
      CASE WHEN page_id % 9 <> 0 THEN '{{"id":' || page_id || '}}' ELSE '{{}}' END AS payload FROM pages""",
    "jsonl_export": f"WITH {RAW} SELECT fetched_at, spider, url, http_status, md5(body) AS body_md5, '{{}}' AS payload FROM raw",
    "raw_landing": LANDED,
    "stream_landing": LANDED,
    "header_first_value": f"WITH {RAW} SELECT url, fetched_at, 'text/html' AS content_type, md5(body) AS body_md5 FROM raw",
    "time_normaliser": f"""SELECT o_orderkey, CASE o_orderkey % 5
        WHEN 0 THEN date_trunc('day', o_orderdate) + INTERVAL '10:20:30' HOUR TO SECOND
        WHEN 1 THEN date_trunc('day', o_orderdate) + INTERVAL '04:50:30' HOUR TO SECOND
        WHEN 2 THEN date_trunc('day', o_orderdate) + INTERVAL '10:20:30.25' HOUR TO SECOND
        ELSE TIMESTAMP '{NOW}' END AS utc FROM orders""".replace(" HOUR TO SECOND", ""),
    "latest_version": f"""WITH {AUCTIONS} SELECT date_trunc('month', source_fetched_at)::DATE AS source_month, url,
      'auction' AS record_type, parsed_at + INTERVAL 1 HOUR AS parsed_at, source_fetched_at, {AUCTION_FIELDS} AS fields
      FROM auction_rec""",
    "content_key": f"""WITH {AUCTIONS} SELECT url, 2 * count(*) AS rows, count(DISTINCT {AUCTION_FIELDS}) AS contents
      FROM auction_rec GROUP BY url""",
    "canonical_record": f"WITH {AUCTIONS} SELECT url, parsed_at, {AUCTION_FIELDS} AS fields FROM auction_rec",
    "month_partitions": """SELECT date_trunc('month', l_shipdate)::DATE AS source_month, 'item' AS record_type,
      count(*) AS rows FROM lineitem GROUP BY 1""",
    "retention": f"WITH {RAW} SELECT url, fetched_at FROM raw WHERE fetched_at + INTERVAL 6 MONTH > TIMESTAMP '{RETENTION_NOW}'",
    "page_gate": f"WITH {RAW}, {GATE} SELECT page_id, url, reason, retryable FROM gate",
    "disposition": f"""WITH {RAW}, {GATE} SELECT page_id, CASE WHEN http_status NOT BETWEEN 200 AND 299 THEN 'pass'
      WHEN reason IS NULL THEN 'accept' WHEN retryable AND page_id % 7 < 5 THEN 'retry' ELSE 'drop' END AS disposition FROM gate""",
    "routed_landing": f"""WITH {RAW},
      sent AS (SELECT * REPLACE (CASE WHEN page_id % 19 = 7 THEN '{HOME}/robots.txt' ELSE url END AS url,
        CASE WHEN page_id % 19 = 7 THEN left(body, 100) ELSE body END AS body) FROM raw),
      r AS (SELECT *, CASE WHEN http_status NOT BETWEEN 200 AND 299 THEN 'pass' WHEN url LIKE '%/robots.txt' THEN 'accept'
        WHEN strlen(body) < 500 AND page_id % 7 < 5 THEN 'retry' WHEN strlen(body) < 500 THEN 'drop'
        WHEN regexp_matches(url, '{LOT}') AND NOT contains(body, 'data-lf-microdata') THEN 'drop' ELSE 'accept' END AS disposition FROM sent)
      SELECT disposition, date_trunc('month', fetched_at)::DATE AS fetch_month, contains(body, 'data-lf-microdata') AS has_marker,
        count(*) AS pages, sum(strlen(body))::BIGINT AS bytes FROM r GROUP BY ALL""",
    "bad_sample": f"""WITH {RAW}, {GATE} SELECT fetched_at, url, reason, 'text/html' AS content_type, strlen(body)::INT AS body_bytes,
      left(hex(encode(body)), 600) AS head_hex,
      left(trim(regexp_replace(url, '[^A-Za-z0-9]+', '_', 'g'), '_'), 120) || '__' ||
      left(trim(regexp_replace(reason, '[^A-Za-z0-9]+', '_', 'g'), '_'), 60) AS sample_name
      FROM gate WHERE reason IS NOT NULL ORDER BY fetched_at, url, reason LIMIT 20""",
    "quarantine_report": f"""WITH {RAW}, {GATE} SELECT reason, retryable, count(*) AS pages FROM gate
      WHERE reason IS NOT NULL GROUP BY ALL""",
    "inflate_bodies": f"""WITH {RAW} SELECT page_id, md5(body) AS body_md5, CASE page_id % 5 WHEN 0 THEN 2 ELSE 1 END::INT AS headers
      FROM raw WHERE http_status BETWEEN 200 AND 299""",
    "page_records": f"""WITH {RAW} SELECT url, 'item' AS type, (page_id // 10)::VARCHAR AS auction_id,
      (page_id % 2 + 1)::VARCHAR AS lot_number, 'Lot ' || page_id AS title, '' AS start_price, '' AS views, '' AS images
      FROM raw WHERE {GOOD_LOT}""",
    "parsed_rows": f"""WITH {RAW} SELECT *, TIMESTAMP '{NOW}' AS parsed_at FROM ({PARSED_LOTS})""",
    "site_routing": """SELECT 'quotes' AS spider, DATE '2024-01-01' AS source_month,
        sum(len(string_split(text, chr(10))) + 1)::BIGINT AS records, count(DISTINCT (conv_id, turn)) AS pages FROM conversations
      UNION ALL SELECT 'books', DATE '2024-01-01', sum(p_size % 3 + 1)::BIGINT, count(*) FROM part""",
    "zero_yield": f"WITH {RAW} SELECT url, fetched_at, CASE WHEN {GOOD_LOT} THEN 1 ELSE 0 END::INT AS records FROM raw",
    "quote_records": QUOTE_RECORDS,
    "quote_records_sql": QUOTE_RECORDS,
    "book_records": """SELECT 'https://books.toscrape.com/catalogue/page-' || p_partkey || '.html' AS url, p_name || ' & ' || i AS title,
      '£' || p_retailprice::DECIMAL(18,2) AS price, CASE WHEN i % 2 = 0 THEN 'In' END AS availability,
      ['One', 'Two', 'Three', 'Four', 'Five'][(p_size + i) % 5 + 1] AS rating
      FROM (SELECT *, unnest(range(1, p_size % 3 + 2)) AS i FROM part)""",
    "catalog_records": f"""WITH o AS (SELECT *, o_orderkey AS k, '{HOME}/auction/' || o_orderkey || '/?page=1' AS url
        FROM orders WHERE o_orderkey % 7 <> 0),
      c AS (SELECT *, unnest(range(1, k % 6 + 1)) AS i FROM o)
      SELECT url, 'auction' AS type, k::VARCHAR AS auction_id, NULL AS lot_number, NULL AS lot_index, k::VARCHAR AS number,
        day(o_orderdate) || ' ' || {MONTHS}[month(o_orderdate)] || ' ' || year(o_orderdate) || ' года' AS date,
        strftime(o_orderdate, '%Y-%m-%d') AS date_iso,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'Через ' || k % 30 || ' дней' ELSE 'unknown' END AS status,
        'Серия ' || o_orderpriority AS title, 'Описание ' || k AS description, NULL AS start_price, NULL AS leading_bid,
        NULL AS final_price, NULL::BOOLEAN AS reserve_not_met, NULL AS views, NULL AS images, url AS source_url FROM o
      UNION ALL
      SELECT url, 'item', k::VARCHAR, i || CASE WHEN i = 5 THEN 'a' ELSE '' END, 'Лот ' || i, NULL, NULL, NULL, NULL,
        'Книга № ' || i, NULL, (k + i * 1000) || ' руб', CASE o_orderstatus WHEN 'O' THEN (k + i * 1500)::VARCHAR END,
        CASE o_orderstatus WHEN 'F' THEN (k + i * 2000)::VARCHAR END, CASE o_orderstatus WHEN 'F' THEN i % 2 = 0 END,
        (i * 7)::VARCHAR, '/i/' || k || '-' || i || '.jpg',
        '{HOME}/auction/' || k || '/' || i || CASE WHEN i = 5 THEN 'a' ELSE '' END || '/' FROM c""",
    "lot_records": f"""SELECT '{HOME}/auction/' || l_orderkey || '/' || l_linenumber || '/' AS url, 'item' AS type,
      l_orderkey || 's1' AS auction_id, l_linenumber || 'b' AS lot_number, 'Лот ' || l_linenumber AS lot_index,
      CASE WHEN l_suppkey % 5 = 0 THEN 'Лот части ' || l_partkey ELSE 'Книга «' || l_partkey || '»' END AS title,
      CASE WHEN l_linestatus = 'O' THEN 'Том ' || l_linenumber || ' Вторая строка текста' ELSE 'Кратко ' || l_partkey END AS description,
      l_partkey || ' 000' AS start_price, CASE WHEN l_returnflag <> 'N' THEN l_partkey || ' 500' END AS final_price,
      l_quantity::INT::VARCHAR AS views,
      CASE WHEN l_linenumber % 2 = 0 THEN '/i/' || l_partkey || '.jpg' ELSE '/og/' || l_partkey || '.png' END AS images,
      '{HOME}/auction/' || l_orderkey || '/' || l_linenumber || '/' AS source_url FROM lineitem WHERE l_partkey % 10 <> 0""",
    "ru_date": """SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS iso FROM orders""",
    "text_clean": f"""SELECT doc_id, md5(trim(regexp_replace('  ' || replace(text, ', ', ',  ' || chr(9)) || chr(13) || chr(10),
      '{SPACE}+', ' ', 'g'))) AS clean_md5 FROM documents""",
    "url_ids": """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN o_orderkey::VARCHAR WHEN 1 THEN o_orderkey || 's1'
        WHEN 2 THEN o_orderkey || '.2' END AS auction_id,
      CASE o_orderkey % 6 WHEN 1 THEN '84a' WHEN 2 THEN o_orderkey::VARCHAR END AS lot_number FROM orders""",
    "watermark_read": """WITH p AS (SELECT event_type AS spider, ts AS watermark,
        date_trunc('day', ts) + to_hours(json_extract_string(props, '$.k')::INT) AS updated_at FROM events)
      SELECT s.spider, coalesce(arg_max(p.watermark, {'t': p.updated_at, 'v': p.watermark}), TIMESTAMP '1970-01-01') AS watermark
      FROM (VALUES ('click'), ('view'), ('never')) s(spider) LEFT JOIN p USING (spider) GROUP BY s.spider""",
    "incremental_batch": f"""WITH {EVENTS} SELECT spider, url, body, fetched_at FROM (
        SELECT *, rank() OVER (ORDER BY fetched_at) AS r FROM ev WHERE spider = 'click' AND fetched_at > TIMESTAMP '{REPLAY_SINCE}')
      WHERE r <= {BATCH}""",
    "incremental_exact": f"""WITH {EVENTS} SELECT spider, url, body, fetched_at FROM ev
      WHERE spider = 'view' AND fetched_at > TIMESTAMP '{REPLAY_SINCE}' ORDER BY fetched_at, url LIMIT {BATCH}""",
    "replay_since": f"""WITH {EVENTS} SELECT spider, url, body, fetched_at FROM ev
      WHERE spider = 'click' AND fetched_at > TIMESTAMP '{REPLAY_SINCE}'""",
    "batch_drain": f"WITH {RAW} {PARSED_LOTS}",
    "stream_drain": f"WITH {RAW} {PARSED_LOTS}",
    "poisoned_drain": f"""WITH {RAW} SELECT url, fetched_at AS source_fetched_at, {LOT_FIELDS} AS fields, NULL AS error
      FROM raw WHERE {GOOD_LOT} AND page_id % 23 <> 5
      UNION ALL SELECT url, fetched_at, NULL, 'ValueError' FROM raw WHERE page_id % 23 = 5""",
    "page_links": f"""WITH {_EDGE_GROUP} SELECT src_url, (row_number() OVER (PARTITION BY page_id ORDER BY i) - 1)::INT AS pos, dst_url
      FROM edges""",
    "rule_links": f"""WITH {_EDGE_GROUP} SELECT src_url, (row_number() OVER (PARTITION BY page_id ORDER BY i) - 1)::INT AS pos, dst_url
      FROM edges WHERE regexp_matches(dst_url, '{LINK_RULES.allow[0]}') AND NOT regexp_matches(dst_url, '{"|".join(LINK_RULES.deny)}')
      AND regexp_matches(dst_url, '^https?://([^/]*[.])?example[.](com|net)/')""",
    "next_links": """SELECT 'https://quotes.toscrape.com/page/' || conv_id || '/?turn=' || turn AS src_url, 0::INT AS pos,
      'https://quotes.toscrape.com/page/2/' AS dst_url FROM conversations""",
    "domain_filter": """SELECT page_id, url FROM pages
      WHERE regexp_matches(url, '^https?://(([^/?#]*[.])?example[.]org|([^/?#]*[.])?m[.]ththth[.]example[.]net)([/?#]|$)')""",
    "scoped_links": f"""WITH {LINKS} SELECT * FROM crawl WHERE pos < 3
      AND regexp_extract(dst_url, '/auction/([0-9]+)/', 1)::INT % 2 = 0""",
    "skip_existing": f"""WITH {RAW}, {STORED}, {LINKS} SELECT DISTINCT dst_url AS url FROM crawl WHERE pos <> 3
      AND dst_url NOT IN (SELECT url FROM good)""",
    "good_entries": f"WITH {RAW}, {STORED} SELECT url FROM good",
    "heal_set": f"WITH {RAW}, {STORED} SELECT url FROM heal",
    "heal_set_indexed": f"WITH {RAW}, {STORED} SELECT url FROM heal",
    "skip_existing_indexed": f"""WITH {RAW}, {STORED}, {LINKS} SELECT DISTINCT dst_url AS url FROM crawl WHERE pos <> 3
      AND dst_url NOT IN (SELECT url FROM good)""",
    "heal_set_scoped": f"""WITH {RAW}, {STORED} SELECT url FROM heal
      WHERE regexp_extract(url, '/auction/([0-9]+)/', 1) IN (SELECT o_orderkey::VARCHAR FROM orders WHERE o_orderkey % 2 = 1)""",
    "heal_outcome": f"""WITH {RAW}, {STORED},
      t AS (SELECT url FROM raw WHERE page_id % 4 <> 3 AND regexp_matches(url, '{ENTRY}') GROUP BY url
        HAVING NOT bool_or(contains(body, 'data-lf-microdata')))
      SELECT count(*) AS targeted, count(g.url) AS fetched_ok, count(*) - count(g.url) AS still_missing
      FROM t LEFT JOIN good g USING (url)""",
    "distinct_ids": f"WITH {ARCHIVE} SELECT page, string_agg(shown, ',' ORDER BY key) AS ids FROM placed GROUP BY page",
    "latest_n": f"WITH {CANDIDATES} SELECT * FROM cand",
    "stored_ids": f"WITH {AUCTIONS} SELECT DISTINCT auction_id FROM auction_rec WHERE status = 'completed'",
    "stored_ids_any": f"WITH {AUCTIONS} SELECT DISTINCT auction_id FROM auction_rec",
    "work_plan": f"""WITH {CANDIDATES}, {AUCTIONS} SELECT rank, auction_id FROM cand
      WHERE auction_id NOT IN (SELECT auction_id FROM auction_rec WHERE status = 'completed')""",
    "work_plan_skipped": f"""WITH {CANDIDATES}, {AUCTIONS} SELECT rank, auction_id FROM cand
      WHERE auction_id IN (SELECT auction_id FROM auction_rec WHERE status = 'completed')""",
    "seeds": f"SELECT o_orderkey::VARCHAR AS auction_id, '{HOME}/auction/' || o_orderkey || '/' AS url FROM orders",
    "frontier_step": f"""WITH {_EDGE_GROUP} SELECT DISTINCT dst_url AS url FROM edges
      WHERE regexp_matches(dst_url, '/[a-z]+$') AND dst_url NOT IN (SELECT split_part(url, '#', 1) FROM pages)
      AND NOT regexp_matches(dst_url, '^https?://[^/]+/(the|la|of)$')""",
    "request_dedup": """WITH u AS (SELECT split_part(url, '#', 1) AS bare FROM pages),
      c AS (SELECT regexp_replace(split_part(bare, '?', 1), '^https?://[^/]*', '') AS path,
          lower(regexp_extract(bare, '^https?://[^/]*')) AS head, list_sort(string_split(split_part(bare, '?', 2), '&')) AS args,
          contains(bare, '?') AS asked FROM u)
      SELECT head || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN asked THEN '?' || array_to_string(args, '&') ELSE '' END
        AS canonical_url, 2 * count(*) AS requests FROM c GROUP BY 1""",
    "mixed_drain": f"WITH {RAW} {PARSED_LOTS}",
    "drain_metrics": f"""WITH {RAW} SELECT page_id // {STEP} AS batch, count(*) AS pages, count_if({GOOD_LOT})::BIGINT AS records,
      max(fetched_at) AS watermark FROM raw GROUP BY 1""",
    "drained_facts": f"""WITH {REFETCHED} SELECT c_custkey::VARCHAR AS auction_id, '1' AS lot_number, title, start_price::BIGINT AS start_price,
      fetched_at AS last_source_fetched_at FROM fetched WHERE v = 2""",
    "drained_status": f"""WITH {REFETCHED}, n AS (SELECT c_custkey, max(CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END) AS done FROM fetched GROUP BY 1)
      SELECT c_custkey::VARCHAR AS auction_id, CASE WHEN done = 1 THEN 'completed' ELSE 'Через 1 дней' END AS status,
      '2024-05-06' AS date_iso, 1::BIGINT AS lots_parsed FROM n""",
    "compacted": f"""WITH {AUCTIONS} SELECT date_trunc('month', source_fetched_at)::DATE AS source_month, url,
      parsed_at + INTERVAL 1 HOUR AS parsed_at, {AUCTION_FIELDS} AS fields FROM auction_rec""",
    "expired": f"WITH {RAW} SELECT url, fetched_at FROM raw WHERE fetched_at + INTERVAL 6 MONTH > TIMESTAMP '{RETENTION_NOW}'",
    "site_rules": f"""SELECT 'https://quotes.toscrape.com/page/' || conv_id || '/?turn=' || turn AS src_url, u.i::INT AS pos,
        'https://quotes.toscrape.com' || u.d AS dst_url
        FROM conversations, LATERAL (VALUES (0, '/tag/a/page/1/'), (1, '/tag/b/page/1/'), (2, '/page/2/')) u(i, d)
      UNION ALL SELECT 'https://books.toscrape.com/catalogue/page-' || p_partkey || '.html', 0,
        'https://books.toscrape.com/catalogue/catalogue/b_' || p_partkey || '/index.html' FROM part
      UNION ALL SELECT '{HOME}/auction/' || o_orderkey || '/?page=1', (i - 1)::INT,
        '{HOME}/auction/' || o_orderkey || '/' || i || '/'
        FROM (SELECT o_orderkey, unnest(range(1, least(o_orderkey % 6, 4) + 1)) AS i FROM orders WHERE o_orderkey % 7 <> 0)""",
    "expired_stream": f"""WITH {RAW} SELECT url, fetched_at AS at, 'page' AS kind FROM raw WHERE fetched_at + INTERVAL 6 MONTH > TIMESTAMP '{RETENTION_NOW}'
      UNION ALL SELECT url, fetched_at, 'record' FROM raw WHERE {GOOD_LOT}""",
    "landed_twice": f"""WITH {RAW}, {TYPED} SELECT fetched_at::DATE AS fetch_date, count(*) AS pages_fetched, {COUNTS},
      count(DISTINCT auction_id) AS distinct_auctions_touched FROM typed GROUP BY 1""",
    "item_facts_kept": f"WITH {AUCTIONS}, {ITEMS}, {FACTS} SELECT * FROM facts",
    "health_rollup": f"""WITH {RAW}, {TYPED} SELECT CASE WHEN grouping(d) = 1 THEN 'total' ELSE 'day' END AS level, d AS fetch_date, count(*) AS pages_fetched,
      {COUNTS}, count(DISTINCT auction_id) AS distinct_auctions_touched, min(fetched_at) AS first_fetched_at, max(fetched_at) AS last_fetched_at
      FROM (SELECT *, fetched_at::DATE AS d FROM typed) GROUP BY GROUPING SETS ((d), ())""",
    "health_stream": f"""WITH {RAW}, {TYPED} SELECT fetched_at::DATE AS fetch_date, count(*) AS pages_fetched, {COUNTS} FROM typed GROUP BY 1""",
    "crawl": f"""WITH RECURSIVE walk(k, depth) AS (
      SELECT 1::BIGINT, 0::BIGINT UNION SELECT d.k, depth + 1 FROM walk JOIN part ON p_partkey = walk.k, LATERAL (VALUES (2 * walk.k), (2 * walk.k + 1)) d(k)),
      up AS (SELECT k, depth FROM walk UNION ALL SELECT 0, 1)
      SELECT '{GRAPH}' || k AS canonical_url, min(depth) AS depth FROM up GROUP BY k""",
}
ORACLES["request_dedup_stream"] = f"SELECT canonical_url FROM ({ORACLES['request_dedup']})"
