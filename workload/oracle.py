"""The SQL counterpart of each query, for an independent engine on the same tables."""

from __future__ import annotations

from marketweave.functions import urls
from marketweave.schemas import CLEAN, PRIORITY

from .inputs import RUN_DATE, SHOP
from .queries import BLOCKED_ENDS, BLOCKED_HOSTS, LINE_ORDER

WS = r"\s\x1c-\x1f\x85\p{Z}"


def clean(x: str) -> str:
    kept = rf"lower(regexp_replace({x}, '[^\p{{L}}\p{{N}}_{WS}]+', '', 'g'))"
    return f"trim(regexp_replace({kept}, '[{WS}]+', ' ', 'g'))"


def safe(x: str) -> str:
    return rf"regexp_replace({x}, '[^\p{{L}}\p{{N}}_]+', '_', 'g')"


def form(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def search(base: str, query: str) -> str:
    return f"{base} || '/s?k=' || {form(query)} || '&ref=nb_sb_noss'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def decode(x: str) -> str:
    for name, char in [("&lt", "<"), ("&gt", ">"), ("&quot", '"'), ("&#39", "''"), ("&nbsp", "\u00a0"),
                       ("&copy", "©"), ("&middot", "·"), ("&amp", "&")]:
        x = f"regexp_replace({x}, '{name};?', '{char}', 'g')"
    return x


def plain(x: str) -> str:
    code = r"(?s)<!--.*?-->|<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>"
    nodes = f"regexp_split_to_array(regexp_replace({x}, '{code}', '<>', 'g'), '<[^>]*>')"
    return f"array_to_string(list_transform({nodes}, lambda t: {strip(decode('t'))}), '')"


def double(x: str) -> str:
    number = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    return f"CASE WHEN regexp_matches({x}, '{number}') THEN TRY_CAST({x} AS DOUBLE) END"


def first_number(x: str, chars: str) -> str:
    found = f"replace(nullif(regexp_extract({x}, '([{chars}]+)', 1), ''), ',', '')"
    return double(found)


PRIORITY_DIGIT = "substr(o_orderpriority, 1, 1)"

PRICED = """
  SELECT *, CASE l_linenumber WHEN 1 THEN 'AED ' || n WHEN 2 THEN n WHEN 3 THEN 'AED 1,' || n WHEN 4 THEN 'AED' || n
    WHEN 5 THEN 'From AED ' || n WHEN 6 THEN ' AED' || chr(160) || n || '  ' ELSE n || 'd' END AS price_text
  FROM (SELECT *, CAST(l_extendedprice AS VARCHAR) AS n FROM lineitem)
"""

GAPPY = """
  SELECT event_id, user_id, nullif(event_type, 'error') AS event_type,
    CASE WHEN value < 10 THEN 'nan'::DOUBLE WHEN value < 60 THEN value END AS value,
    CASE WHEN event_type = 'view' THEN '' ELSE props END AS props
  FROM events
"""

LINKS = """
  SELECT page_id, url, unnest(hrefs) AS href, unnest(generate_series(1, len(hrefs))) AS pos
  FROM (SELECT page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS hrefs FROM pages)
"""

LISTINGS = f"""
  SELECT marketplace, url, category, subcategory, query, {search('url', 'query')} AS page_url,
    replace({clean("marketplace || ' ' || category || ' ' || subcategory")}, ' ', '_') AS slug,
    {safe('category')} AS category_key, {safe('subcategory')} AS subcategory_key
  FROM (
    SELECT c.c_name AS marketplace, 'https://m' || c.c_custkey || '.example.com' AS url, c.c_mktsegment AS category,
      o.n_name AS subcategory, {clean("c.c_mktsegment || ' ' || o.n_name")} AS query
    FROM customer c
    JOIN (SELECT DISTINCT c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey) o
      ON c.c_mktsegment = o.c_mktsegment)
"""

# What the order pages and customer pages hold, stated directly.
PRODUCTS = f"""
  SELECT page_no, pos, name, price, currency, image_url, product_detail_url,
    {search(f"'{SHOP}'", 'query')} AS page_url, 'shop' AS marketplace, lower(c_mktsegment) AS category,
    lower(n_name) AS subcategory, '{RUN_DATE}' AS date_collected, '{SHOP}' AS url
  FROM (
    SELECT o_orderkey AS page_no, 1 AS pos, 'item' || lower(o_orderstatus) || '& ' || {PRIORITY_DIGIT} AS name,
      CASE WHEN {PRIORITY_DIGIT} IN ('1', '2', '3') THEN CAST(o_custkey || '.50' AS DOUBLE)
           WHEN {PRIORITY_DIGIT} = '5' AND o_orderstatus = 'P' THEN 9.99 END AS price,
      CASE WHEN {PRIORITY_DIGIT} IN ('1', '3') THEN 'AED' WHEN {PRIORITY_DIGIT} = '2' THEN ''
           WHEN {PRIORITY_DIGIT} = '5' AND o_orderstatus = 'P' THEN 'USD' END AS currency,
      '/i/' || o_custkey || '.png' AS image_url, '{SHOP}/dp/' || o_custkey AS product_detail_url, o_custkey
    FROM orders
    UNION ALL
    SELECT o_orderkey, 2, 'inner', 9.99, 'USD', NULL, 'https://o.example.org/p/' || o_custkey || '?a=1&b=2', o_custkey
    FROM orders WHERE o_orderstatus = 'P')
  JOIN (SELECT *, {clean("c_mktsegment || ' ' || n_name")} AS query FROM customer JOIN nation ON c_nationkey = n_nationkey)
    ON o_custkey = c_custkey
"""

DETAILS = f"""
  SELECT '{SHOP}/dp/' || c_custkey AS product_detail_url,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN lower(c_mktsegment) END AS brand,
    lower(c_name || chr(10) || 'Nation' || n_name || chr(10) || 'From & for ' || c_mktsegment) AS description,
    CAST('1' || c_custkey AS DOUBLE) AS total_reviews, CAST('4.' || c_nationkey AS DOUBLE) AS review_score
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 0
"""

DETAILS_WITH_SCORE = DETAILS.replace("CAST('4.' || c_nationkey AS DOUBLE) AS review_score", "'4.' || c_nationkey AS score")


def listing_run(limit: int | None) -> str:
    within = f"WHERE rn <= {limit}" if limit else ""
    present = " AND ".join(f"{c} IS NOT NULL" for c in PRIORITY if c != "review_score")
    return f"""
      WITH products AS ({PRODUCTS}), details AS ({DETAILS}),
      limited AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category, subcategory ORDER BY page_no, pos)
        AS rn FROM products) {within}),
      rich AS (SELECT p.*, d.brand, d.description, d.total_reviews, d.review_score
        FROM limited p LEFT JOIN details d USING (product_detail_url)),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(PRIORITY)} ORDER BY page_no, pos) AS k
        FROM rich WHERE {present})
      SELECT {', '.join(CLEAN.names)} FROM ranked WHERE k = 1"""


CLEAN_DOCUMENTS = """
  SELECT source AS name, CAST(n_chars AS DOUBLE) AS price, lang AS category, '/d/' || doc_id AS product_detail_url FROM documents
"""

_LISTED = f"SELECT * FROM ({PRODUCTS}) WHERE subcategory <> 'nation_7'"


def run_profile() -> str:
    rich = f"""SELECT p.*, d.brand, d.description, d.total_reviews, d.review_score FROM (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category, subcategory ORDER BY page_no, pos) AS rn
        FROM ({_LISTED})) WHERE rn <= 5) p LEFT JOIN ({DETAILS}) d USING (product_detail_url)"""
    parts = [
        f"SELECT {i} AS position, '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing_count FROM rich"
        for i, c in enumerate(CLEAN.names)
    ]
    return f"WITH rich AS ({rich}) " + " UNION ALL ".join(parts)


def run_summary() -> str:
    return f"""
      WITH o AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
      p AS ({_LISTED}),
      r AS (SELECT row_number() OVER (PARTITION BY category, subcategory ORDER BY page_no, pos) AS rn FROM p)
      SELECT (SELECT count(*) + count(*) FILTER (WHERE o_orderstatus IN ('F', 'P')) FROM o) AS cards,
        (SELECT count(*) FROM o WHERE o_orderstatus = 'F') AS malformed,
        (SELECT count(*) + count(*) FILTER (WHERE o_orderstatus IN ('F', 'P')) FROM o WHERE n_name = 'NATION_7') AS without_listing,
        (SELECT count(DISTINCT page_no) FROM p) AS pages, (SELECT count(*) FROM p) AS products,
        (SELECT count(DISTINCT product_detail_url) FROM p) AS distinct_products,
        (SELECT count(*) FROM r WHERE rn <= 5) AS chosen"""


def blocked_url(url: str, ends: list[str]) -> str:
    return " OR ".join([f"{url} LIKE '%{e}'" for e in ends] + [f"contains({url}, '{d}')" for d in BLOCKED_HOSTS])


def blocked() -> str:
    return "resource_type IN ('media', 'audio') OR " + blocked_url("url", BLOCKED_ENDS)


def profile() -> str:
    parts = []
    for i, c in enumerate(["event_id", "user_id", "event_type", "value", "props"]):
        test = f"{c} IS NULL OR isnan({c})" if c == "value" else f"{c} IS NULL"
        parts.append(f"SELECT {i} AS position, '{c}' AS \"column\", count(*) FILTER (WHERE {test}) AS missing_count FROM g")
    return f"WITH g AS ({GAPPY}) " + " UNION ALL ".join(parts)


_ABSENT = [c for c in PRIORITY if c not in ("category", "subcategory", "price")]

# Counterpart of the URL resolution for the references the menus hold: each starts with "/".
_ORIGIN = "regexp_extract(url, '^(https?://[^/?#]*)', 1)"

_SNAPSHOTS = """
  SELECT 'final_x_' || strftime(o_orderdate, '%d%m%Y') || '_000000.csv' AS name FROM orders
  UNION ALL SELECT 'notes_' || o_orderstatus || '.csv' FROM orders
"""

_TOKENS = f"list_filter(regexp_split_to_array(price_text, '[{WS}]+'), lambda t: t <> '')"

ORACLE: dict[str, str] = {
    "q_slug": f"SELECT doc_id, replace({clean('text')}, ' ', '_') AS slug FROM documents",
    "q_normalize_query": f"""SELECT doc_id, {clean("source || ' ' || text")} AS query FROM documents""",
    "q_safe_key": f"SELECT doc_id, {safe('text')} AS safe_key FROM documents",
    "q_search_url": f"""SELECT doc_id, {search("'https://' || source", 'text')} AS search_url FROM documents""",
    "q_page_frontier": """
      SELECT page_id, n::INTEGER AS page_no, url || '&n=' || n AS frontier_url FROM pages, generate_series(1, 3) t(n)""",
    "q_page_links": f"SELECT page_id, pos::INTEGER AS pos, {decode('href')} AS href FROM ({LINKS}) WHERE href <> ''",
    "q_resolve_url": f"SELECT page_id, pos::INTEGER AS pos, {_ORIGIN} || {decode('href')} AS resolved FROM ({LINKS})",
    "q_block_filter": f"""
      SELECT * FROM (SELECT page_id, url, CASE WHEN starts_with(url, 'https') THEN 'document' ELSE 'media' END
        AS resource_type FROM pages) WHERE NOT ({blocked()})""",
    "q_parse_price": f"""
      SELECT l_orderkey, l_partkey, l_linenumber, price_text, price, CASE WHEN price IS NOT NULL THEN currency END AS currency
      FROM (SELECT *, {double('p')} AS price FROM (
        SELECT *, CASE WHEN len(t) = 2 THEN t[2] ELSE t[1] END AS p, CASE WHEN len(t) = 2 THEN t[1] ELSE '' END AS currency
        FROM (SELECT *, {_TOKENS} AS t FROM ({PRICED}))))""",
    "q_parse_reviews": f"""
      SELECT o_orderkey, {first_number('w', '0-9,')} AS total_reviews FROM (SELECT o_orderkey, CASE {PRIORITY_DIGIT}
        WHEN '1' THEN '1,' || o_orderkey || ' ratings' WHEN '2' THEN '(' || o_orderkey || ')' WHEN '3' THEN 'no ratings'
        WHEN '4' THEN ',' ELSE o_orderkey || ' of 7' END AS w FROM orders)""",
    "q_parse_score": f"""
      SELECT o_orderkey, {first_number('w', '0-9.')} AS review_score FROM (SELECT o_orderkey, CASE {PRIORITY_DIGIT}
        WHEN '1' THEN '4.' || o_custkey || ' out of 5' WHEN '2' THEN 'score ' || o_custkey WHEN '3' THEN 'no score'
        WHEN '4' THEN '.' ELSE '.' || o_custkey || '/10' END AS w FROM orders)""",
    "q_compose_description": f"""
      SELECT doc_id, {strip("lower(CASE WHEN lang <> 'en' THEN ' ' || lang ELSE '' END || chr(10) || text)")}
        AS description FROM documents""",
    "q_resolve_references": """
      SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN b || '/c' || k WHEN 1 THEN 'https://shop.example.com/a/d' || k
        WHEN 2 THEN 'https://other.example.org/e' || k WHEN 3 THEN b || '/page?f=' || k WHEN 4 THEN b || '/h' || k
        WHEN 5 THEN 'http://x.example.net/i' || k || '#j' ELSE b || '/page?q=1' END AS resolved
      FROM (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS k, 'https://shop.example.com/a/b' || o_custkey AS b FROM orders)""",
    "q_block_links": f"""
      SELECT * FROM (SELECT page_id, pos::INTEGER AS pos, {_ORIGIN} || {decode('href')} AS resolved FROM ({LINKS}))
      WHERE NOT ({blocked_url('resolved', [*BLOCKED_ENDS, '.'])})""",
    "q_awkward_markup": """
      SELECT p_partkey, 'é' || chr(39) || p_size || ' < 90c<' || p_partkey || '>' AS text,
        '/dp/' || p_partkey || '?a=1&b=2&region=us&copy=2&x=é' AS href FROM part""",
    "q_strip_text": f"SELECT page_id, {plain('html')} AS text FROM pages",
    "q_parse_date": f"""
      SELECT o_orderkey, strftime(try_strptime(w, ['%Y-%m-%d', '%d/%m/%Y', '%Y/%m/%d']), '%Y-%m-%d') AS date_collected
      FROM (SELECT o_orderkey, CASE {PRIORITY_DIGIT} WHEN '1' THEN strftime(o_orderdate, '%Y-%m-%d')
        WHEN '2' THEN strftime(o_orderdate, '%-d/%-m/%Y') WHEN '3' THEN strftime(o_orderdate, '%Y/%m/%d')
        WHEN '4' THEN strftime(o_orderdate, '%Y%m%d') ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS w
      FROM orders)""",
    "q_coerce_numeric": f"""
      SELECT l_orderkey, l_partkey, l_linenumber, {double('trim(price_text)')} AS price FROM ({PRICED})""",
    "q_decimal_cast": """
      SELECT l_orderkey, l_partkey, l_linenumber,
        CAST(CAST(CAST(l_extendedprice * (1 - l_discount) AS VARCHAR) AS DECIMAL(10, 2)) AS VARCHAR) AS net_price FROM lineitem""",
    "q_catalog_expand": LISTINGS,
    "q_catalog_lookup": f"""
      SELECT marketplace, page_url FROM ({LISTINGS}) WHERE category = 'BUILDING' AND subcategory = 'NATION_7'""",
    "q_page_region": rf"""
      SELECT page_id, {plain("regexp_extract(html, '(?s)<article>.*?<h1>(.*?)</h1>', 1)")} AS title FROM pages""",
    "q_page_cards": f"""
      SELECT page_id, pos::INTEGER AS pos, href, {strip(decode('label'))} AS label FROM (
        SELECT page_id, unnest(hrefs) AS href, unnest(labels) AS label, unnest(generate_series(1, len(hrefs))) AS pos
        FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS hrefs,
          regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)<', 1) AS labels FROM pages)) WHERE href <> ''""",
    "q_page_detail": rf"""
      SELECT page_id, {plain("regexp_extract(html, '(?s)<div class=\"ad\">(.*?)</div>', 1)")} AS ad,
        array_to_string(list_transform(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)<', 1),
          lambda t: {strip(decode('t'))}), chr(10)) AS menu, TRUE AS absent FROM pages""",
    "q_product_details": DETAILS,
    "q_card_project": PRODUCTS,
    "q_skip_malformed": """
      SELECT o_orderkey AS page_no, 2 AS pos, '/dp/x' AS href FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE o_orderstatus = 'F'""",
    "q_page_chain": """
      WITH RECURSIVE l AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 10 <> 9 THEN c_custkey + 1
          WHEN (c_custkey // 10) % 7 = 3 THEN c_custkey - 9 END AS following FROM customer),
        r AS (SELECT k, k AS first, 1 AS n FROM l WHERE k NOT IN (SELECT following FROM l WHERE following IS NOT NULL)
          UNION ALL SELECT b.k, r.first, r.n + 1 FROM r JOIN l a ON a.k = r.k JOIN l b ON b.k = a.following)
      SELECT l.k AS c_custkey, 'https://shop.example.com/c/' || r.first AS first_url, r.n::BIGINT AS page_no FROM l LEFT JOIN r USING (k)""",
    "q_upsert_by_parts": """
      SELECT source AS name, CAST(CAST(n_chars AS DECIMAL(10, 2)) AS VARCHAR) AS price, '/d/' || doc_id AS product_detail_url FROM documents""",
    "q_listing_emptied": """
      SELECT CASE WHEN lang = 'fr' THEN text ELSE CAST(length(text) AS VARCHAR) END AS name, lang AS category, source AS subcategory
      FROM documents WHERE lang <> 'de'""",
    "q_listing_manifest": r"""
      SELECT regexp_replace(lang, '[^\p{L}\p{N}_]+', '_', 'g') AS category_key, regexp_replace(source, '[^\p{L}\p{N}_]+', '_', 'g') AS subcategory_key,
        CASE lang WHEN 'de' THEN 0 ELSE count(*) END AS products, CASE lang WHEN 'de' THEN 'emptied' WHEN 'fr' THEN 'kept' ELSE 'written' END AS state
      FROM documents GROUP BY lang, source""",
    "q_page_errors": f"""
      SELECT page_id, pos::INTEGER AS pos, href, {strip(decode('label'))} AS label, NULL AS error FROM (
        SELECT page_id, unnest(hrefs) AS href, unnest(labels) AS label, unnest(generate_series(1, len(hrefs))) AS pos
        FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS hrefs,
          regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)<', 1) AS labels FROM pages WHERE page_id % 7 <> 3)) WHERE href <> ''
      UNION ALL SELECT page_id, NULL, NULL, NULL, 'UnicodeDecodeError' FROM pages WHERE page_id % 7 = 3""",
    "q_card_project_jvm": PRODUCTS,
    "q_product_details_jvm": DETAILS,
    "q_skip_malformed_jvm": """
      SELECT o_orderkey AS page_no, 2 AS pos, '/dp/x' AS href FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE o_orderstatus = 'F'""",
    "q_enrich_left": """
      SELECT doc_id, lang, CASE WHEN l.doc_id IS NOT NULL THEN l.quality ELSE n_chars END AS quality, CAST(toxic AS DOUBLE) AS toxic
      FROM documents LEFT JOIN labels l USING (doc_id)""",
    "q_enrich_pages": f"""
      SELECT page_no, pos, product_detail_url, brand, description, total_reviews, review_score
      FROM ({PRODUCTS}) LEFT JOIN ({DETAILS}) USING (product_detail_url)""",
    "q_enrich_recollected": f"""
      SELECT page_no, pos, product_detail_url, brand, description, total_reviews, CAST(score || '7' AS DOUBLE) AS review_score
      FROM ({PRODUCTS}) LEFT JOIN ({DETAILS_WITH_SCORE}) USING (product_detail_url)""",
    "q_enrich_stored_pages": f"""
      SELECT page_no, pos, product_detail_url, brand, description, total_reviews, CAST(score || '7' AS DOUBLE) AS review_score
      FROM (SELECT *, row_number() OVER (PARTITION BY marketplace, category, subcategory ORDER BY page_no, pos) AS rn FROM ({PRODUCTS}))
      LEFT JOIN ({DETAILS_WITH_SCORE}) USING (product_detail_url) WHERE rn <= 5""",
    "q_enrich_hot": """
      WITH l AS (SELECT *, CASE l_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN l_partkey END AS key FROM lineitem)
      SELECT key, l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand FROM l LEFT JOIN part ON key = p_partkey""",
    "q_first_n_huge": """
      SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 5000""",
    "q_first_n": """
      SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 5""",
    "q_first_n_large": """
      SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 500""",
    "q_preview": f"SELECT * FROM lineitem ORDER BY {', '.join(LINE_ORDER)} LIMIT 3",
    "q_missing_profile": profile(),
    "q_missing_columns": f"""
      SELECT category, rows_without, unnest([{', '.join(repr(c) for c in _ABSENT)}]) AS "column"
      FROM (SELECT l_returnflag AS category, count(*) AS rows_without FROM lineitem GROUP BY 1)""",
    "q_dropna_subset": f"""
      SELECT * FROM ({GAPPY}) WHERE event_type IS NOT NULL AND value IS NOT NULL AND NOT isnan(value) AND props IS NOT NULL""",
    "q_select_priority": "SELECT p_type, p_brand, p_name, p_partkey, p_retailprice, p_size FROM part",
    "q_dedupe_keep_first": f"""
      SELECT {', '.join(LINE_ORDER)} FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_returnflag
        ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1""",
    "q_dedupe_missing_equal": f"""
      SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type,
        CASE WHEN isnan(value) THEN NULL ELSE value END ORDER BY event_id) AS rn FROM ({GAPPY})) WHERE rn = 1""",
    "q_run_counts": f"""
      SELECT count(DISTINCT page_id) AS pages, count(href) AS products, count(DISTINCT href) AS distinct_products
      FROM ({LINKS})""",
    "q_scan_json": """
      SELECT text AS name, CASE WHEN lang <> 'de' THEN lang END AS currency, source AS category,
        CAST(n_chars AS DOUBLE) AS price FROM documents""",
    "q_json_partitions": f"""
      SELECT {safe('source')} AS category_key, count(*) AS products, sum(CAST(n_chars AS DOUBLE)) AS price_sum
      FROM documents GROUP BY 1""",
    "q_scan_csv": """
      SELECT nullif(text, '') AS name, CASE WHEN lang <> 'de' THEN lang END AS currency, source AS category,
        CAST(n_chars AS DOUBLE) AS price FROM documents""",
    "q_scan_csv_ranges": """
      SELECT nullif(text, '') AS name, CASE WHEN lang <> 'de' THEN lang END AS currency, source AS category,
        CAST(n_chars AS DOUBLE) AS price FROM documents""",
    "q_latest_snapshot_lex": f"""
      WITH s AS ({_SNAPSHOTS}), k AS (SELECT name, array_to_string(regexp_extract_all(name, '([0-9]+)', 1), '_') AS key
        FROM s WHERE regexp_matches(name, '[0-9]')), top AS (SELECT max(key) AS key FROM k)
      SELECT min(name) AS name, max(top.key) AS snapshot_key FROM k, top WHERE contains(name, top.key)""",
    "q_latest_snapshot_time": f"""
      WITH s AS (SELECT name, try_strptime(nullif(regexp_extract(name, '([0-9]{{8}}_[0-9]{{6}})', 1), ''), '%d%m%Y_%H%M%S')
        AS t FROM ({_SNAPSHOTS}))
      SELECT min(name) AS name, strftime(max(t), '%Y-%m-%d %H:%M:%S') AS snapshot_key FROM s
      WHERE t = (SELECT max(t) FROM s)""",
    "q_conform_schema": """
      SELECT l_orderkey || '-' || l_partkey || '-' || l_linenumber AS name,
        CAST(CAST(CAST(l_extendedprice * (1 - l_discount) AS VARCHAR) AS DECIMAL(10, 2)) AS VARCHAR) AS price,
        nullif(l_returnflag, 'N') AS currency, '' AS image_url, '' AS product_detail_url, '' AS page_url,
        '' AS marketplace_name, strftime(l_shipdate, '%Y-%m-%d 00:00:00') AS date_collected, l_linestatus AS category,
        '' AS subcategory, '' AS amazon_category,
        CAST(CAST(CAST(l_tax AS VARCHAR) AS DECIMAL(10, 2)) AS VARCHAR) AS review_score, '0.00' AS total_reviews,
        '' AS brand, '' AS about, '' AS description FROM lineitem""",
    "q_upsert_insert_only": """
      WITH b AS (SELECT doc_id, source, CASE WHEN lang <> 'de' THEN text END AS k FROM documents),
      t AS (SELECT DISTINCT k FROM b JOIN labels USING (doc_id) WHERE k IS NOT NULL)
      SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS rn FROM b)
      WHERE k IS NULL OR (rn = 1 AND k NOT IN (SELECT k FROM t))""",
    "q_constraint_check": """
      WITH d AS (SELECT CASE WHEN lang <> 'fr' THEN source END AS name, CASE WHEN n_chars > 100 THEN n_chars END AS price,
        CASE WHEN lang <> 'de' THEN text END AS k FROM documents)
      SELECT 'name not null' AS "constraint", count(*) FILTER (WHERE name IS NULL) AS violations FROM d
      UNION ALL SELECT 'price not null', count(*) FILTER (WHERE price IS NULL) FROM d
      UNION ALL SELECT 'product_detail_url unique', count(k) - count(DISTINCT k) FROM d""",
    "q_json_two_listings": """
      SELECT CASE lang WHEN 'de' THEN CAST(length(text) AS VARCHAR) ELSE text END AS name, lang AS category,
        source AS subcategory FROM documents WHERE lang IN ('de', 'fr')""",
    "q_scan_latest": f"SELECT name, price, category, product_detail_url FROM ({CLEAN_DOCUMENTS})",
    "q_insert_twice": f"""
      WITH d AS (SELECT *, CASE WHEN price < 3000 THEN 0 ELSE 1 END AS turn, category = 'de' AS keyless FROM ({CLEAN_DOCUMENTS})),
      r AS (SELECT category, turn FROM d UNION ALL SELECT category, 1 FROM d WHERE keyless AND turn = 0)
      SELECT 'turn ' || turn AS currency, category, count(*) AS rows_in, count(*) AS ids FROM r GROUP BY turn, category
      UNION ALL SELECT 'all', 'all', count(*), count(*) FROM r""",
    "q_write_products_db": f"""
      SELECT name, CAST(CAST(price AS DECIMAL(10, 2)) AS VARCHAR) AS price, product_detail_url FROM ({CLEAN_DOCUMENTS})""",
    "q_write_products_dir": f"SELECT name, price, product_detail_url FROM ({CLEAN_DOCUMENTS})",
    "q_run_profile": run_profile(),
    "q_run_summary": run_summary(),
    "q_run_quarantine": """
      SELECT o_orderkey AS page_no, 2 AS pos, '/dp/x' AS href FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE o_orderstatus = 'F'""",
    "q_listing_run": listing_run(5),
    "q_listing_run_all": listing_run(None),
}

assert urls.SEARCH_PATH == "/s?k="
