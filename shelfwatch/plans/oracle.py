"""The same queries as plain SQL, to check results against another engine."""

from __future__ import annotations

SP = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NOT_SP_TAG = r"[^0-9.,\x09-\x0d\x1c-\x20\x{85}\x{a0}]"

_OBS = """obs AS (
  SELECT event_id, date_diff('day', DATE '2023-12-31', ts::DATE)::BIGINT AS run_id,
    'Item ' || user_id AS name,
    'https://shop.example/catalogue/item_' || user_id || '/index.html' AS url,
    CASE WHEN event_type <> 'error' THEN value END AS price,
    CASE WHEN event_type <> 'signup' THEN 'GBP' END AS currency,
    event_type AS category,
    CASE event_type WHEN 'view' THEN 'In stock' WHEN 'click' THEN 'Out of stock'
      WHEN 'purchase' THEN ' instock ' END AS availability,
    CASE WHEN event_type <> 'click' THEN round_even(value / 100, 0) END AS rating,
    NULL::VARCHAR AS image_url, 'item_' || user_id AS source_product_id, ts AS seen_at
  FROM events)"""

_CAT = """cat AS (
  SELECT *, CASE availability WHEN 'In Stock' THEN 'Available' WHEN 'Out of Stock' THEN 'Unavailable'
    ELSE 'Unknown' END AS availability_status
  FROM (
    SELECT p_name AS name, 'https://shop.example/part/' || p_partkey AS url,
      l_extendedprice / l_quantity / 100 AS price,
      CASE WHEN p_brand = 'Brand#7' THEN 'EUR' WHEN p_brand <> 'Brand#9' THEN 'GBP' END AS currency,
      CASE WHEN p_brand <> 'Brand#13' THEN p_type END AS category,
      CASE l_returnflag WHEN 'A' THEN 'In Stock' WHEN 'R' THEN 'Out of Stock' END AS availability,
      l_quantity / 10 AS rating
    FROM lineitem JOIN part ON l_partkey = p_partkey))"""

_TXT = """txt AS (
  SELECT o_orderkey, CASE o_orderpriority
      WHEN '1-URGENT' THEN '£' || amount WHEN '2-HIGH' THEN '$  ' || amount
      WHEN '3-MEDIUM' THEN amount || ' €'
      WHEN '4-NOT SPECIFIED' THEN CASE o_orderstatus WHEN 'F' THEN 'not-a-price' WHEN 'O' THEN '1.2.3'
        ELSE 'Price: ₹' || amount END
      ELSE CASE WHEN o_orderstatus <> 'P' THEN '-' || amount END END AS raw
  FROM (SELECT *, format('{:,.2f}', o_totalprice) AS amount FROM orders))"""

_DIRTY = """dirty AS (
  SELECT event_id,
    CASE WHEN k < 5 THEN NULL WHEN k < 10 THEN '   ' ELSE chr(9) || ' Item  ' || user_id || ' ' END AS name,
    CASE WHEN k BETWEEN 10 AND 14 THEN NULL WHEN k BETWEEN 15 AND 19 THEN 'ftp://shop.example/' || user_id
      WHEN k BETWEEN 20 AND 24 THEN 'not a url'
      ELSE '  https://shop.example/catalogue/item_' || user_id || '/index.html#top ' END AS url,
    CASE WHEN k BETWEEN 25 AND 29 THEN NULL WHEN k BETWEEN 30 AND 34 THEN -value ELSE value END AS price,
    CASE WHEN k < 50 THEN 'GBP' WHEN k < 55 THEN ' ' WHEN k >= 60 THEN ' EUR ' END AS currency,
    event_type AS category,
    CASE WHEN k < 30 THEN ' In   stock' WHEN k < 60 THEN 'OUT OF STOCK' WHEN k < 90 THEN 'ships later' END
      AS availability,
    CASE WHEN k BETWEEN 35 AND 39 THEN NULL WHEN k BETWEEN 40 AND 44 THEN value ELSE value / 100 END AS rating,
    CASE WHEN k < 70 THEN 'https://img.example/' || user_id || '.jpg#x' WHEN k < 75 THEN 'img/none.jpg'
      WHEN k >= 80 THEN ' ' END AS image_url,
    CASE WHEN k < 90 THEN ' item_' || user_id WHEN k < 95 THEN ' ' END AS source_product_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS scraped_at, user_id, k
  FROM (SELECT *, regexp_extract(props, '[0-9]+')::INT AS k FROM events))"""

# Which rules each dirty record breaks, one row per issue, numbered in rule order.
_ISSUES = """issues AS (
  SELECT event_id, 1 AS nr, 'missing_required' AS issue_type, 'name' AS field_name FROM dirty WHERE k < 10
  UNION ALL SELECT event_id, 2, 'missing_required', 'url' FROM dirty WHERE url IS NULL
  UNION ALL SELECT event_id, 2, 'invalid_value', 'url' FROM dirty WHERE k BETWEEN 15 AND 24
  UNION ALL SELECT event_id, 3, CASE WHEN price IS NULL THEN 'missing_optional' ELSE 'invalid_value' END, 'price'
    FROM dirty WHERE price IS NULL OR price < 0
  UNION ALL SELECT event_id, 4, CASE WHEN rating IS NULL THEN 'missing_optional' ELSE 'invalid_value' END, 'rating'
    FROM dirty WHERE rating IS NULL OR rating NOT BETWEEN 0 AND 5
  UNION ALL SELECT event_id, 5, CASE WHEN currency IS NULL THEN 'missing_optional' ELSE 'invalid_value' END,
    'currency' FROM dirty WHERE currency IS NULL OR currency = ' '
  UNION ALL SELECT event_id, 7, 'missing_optional', 'availability' FROM dirty WHERE availability IS NULL
  UNION ALL SELECT event_id, 8, CASE WHEN image_url IS NULL THEN 'missing_optional' ELSE 'invalid_value' END,
    'image_url' FROM dirty WHERE image_url IS NULL OR k >= 80 OR image_url = 'img/none.jpg'
  UNION ALL SELECT event_id, 9, 'warning', 'source_product_id' FROM dirty WHERE source_product_id IS NULL)"""

_VALID = """valid AS (
  SELECT event_id,
    CASE WHEN trim(name, chr(9) || ' ') = '' THEN name ELSE trim(name, chr(9) || ' ') END AS name,
    CASE WHEN k BETWEEN 15 AND 24 THEN url ELSE trim(url) END AS url,
    CASE WHEN price >= 0 THEN price END AS price, nullif(trim(currency), '') AS currency, category,
    trim(availability) AS availability, CASE WHEN rating BETWEEN 0 AND 5 THEN rating END AS rating,
    CASE WHEN k < 70 THEN image_url END AS image_url,
    nullif(trim(source_product_id), '') AS source_product_id, scraped_at, k >= 25 AS is_valid
  FROM dirty)"""

_TAGS = """tags AS (
  SELECT * REPLACE (CASE WHEN price < 0 THEN 'on request'
      WHEN price > 250 THEN '€' || format('{:,.2f}', price * 100)
      ELSE '£ ' || format('{:,.2f}', price) END AS price)
  FROM dirty)"""

_STANDARD = """standard AS (
  SELECT event_id, nullif(trim(regexp_replace(name, '\\s+', ' ', 'g')), '') AS name,
    nullif(split_part(trim(url), '#', 1), '') AS url,
    TRY_CAST(replace(nullif(regexp_extract(price, '[0-9.,]+'), ''), ',', '') AS DOUBLE) AS price,
    coalesce(nullif(trim(currency), ''), CASE left(price, 1) WHEN '£' THEN 'GBP' WHEN '€' THEN 'EUR'
      WHEN 'o' THEN 'on' END) AS currency,
    category,
    CASE WHEN k < 30 THEN 'In Stock' WHEN k < 60 THEN 'Out of Stock' ELSE availability END AS availability,
    CASE WHEN rating BETWEEN 0 AND 5 THEN rating END AS rating,
    nullif(split_part(trim(image_url), '#', 1), '') AS image_url,
    nullif(trim(source_product_id), '') AS source_product_id,
    replace(scraped_at, 'T', ' ') AS scraped_at, price AS raw_price, k, rating AS raw_rating
  FROM tags)"""

_SUMMARY = """agg AS (
  SELECT category, count(*) AS product_count,
    count(*) FILTER (availability_status = 'Available') AS in_stock, format('{:.2f}', avg(price))::DOUBLE AS avg_price,
    format('{:.2f}', min(price))::DOUBLE AS min_price, format('{:.2f}', max(price))::DOUBLE AS max_price, format('{:.2f}', avg(rating))::DOUBLE AS avg_rating
  FROM cat GROUP BY category)"""

_KPIS = """kpi AS (
  SELECT count(*) AS total_products, count(DISTINCT url) AS unique_products,
    count(DISTINCT category) AS categories,
    (SELECT currency FROM cat WHERE currency IS NOT NULL GROUP BY currency
      ORDER BY count(*) DESC, currency LIMIT 1) AS currency,
    format('{:.2f}', avg(price))::DOUBLE AS avg_price, format('{:.2f}', median(price))::DOUBLE AS median_price,
    format('{:.2f}', min(price))::DOUBLE AS min_price, format('{:.2f}', max(price))::DOUBLE AS max_price, format('{:.2f}', avg(rating))::DOUBLE AS avg_rating,
    count(*) FILTER (availability_status = 'Available') AS in_stock,
    count(*) FILTER (availability_status = 'Unavailable') AS out_of_stock,
    format('{:.2f}', max(price) - min(price))::DOUBLE AS price_span
  FROM cat)"""

_BAND = """CASE WHEN {0} >= 0 AND {0} < 10 THEN '0-10' WHEN {0} >= 10 AND {0} < 20 THEN '10-20'
    WHEN {0} >= 20 AND {0} < 30 THEN '20-30' WHEN {0} >= 30 AND {0} < 40 THEN '30-40'
    WHEN {0} >= 40 AND {0} < 50 THEN '40-50' WHEN {0} >= 50 THEN '50+' END"""

_STATUS = """CASE WHEN lower({0}) LIKE '%in stock%' OR lower({0}) LIKE '%instock%' THEN 'Available'
    WHEN lower({0}) LIKE '%out of stock%' OR lower({0}) LIKE '%outofstock%' THEN 'Unavailable'
    ELSE 'Unknown' END"""

_LAST = "(SELECT max(run_id) FROM obs)"

_PREVIOUS = f"""prev AS (
  SELECT arg_max(source_product_id, event_id) AS source_product_id, url,
    arg_max(price, event_id) AS previous_price
  FROM obs WHERE run_id < {_LAST} AND price IS NOT NULL GROUP BY url)"""

_SNAPSHOT = f"""old AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY event_id DESC) AS rn FROM obs
    WHERE run_id < {_LAST}) WHERE rn = 1),
new AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY event_id DESC) AS rn FROM obs
    WHERE run_id = {_LAST}) WHERE rn = 1),
newest AS (
  SELECT url, arg_max(price, event_id) AS price, arg_max(source_product_id, event_id) AS id
  FROM obs WHERE run_id = {_LAST} AND price IS NOT NULL GROUP BY url),
snap AS (
  SELECT coalesce(n.source_product_id, o.source_product_id) AS source_product_id,
    coalesce(n.name, o.name) AS name, coalesce(n.url, o.url) AS url,
    CASE WHEN n.url IS NOT NULL THEN n.price ELSE o.price END AS price,
    CASE WHEN n.url IS NOT NULL THEN n.currency ELSE o.currency END AS currency,
    CASE WHEN n.url IS NOT NULL THEN n.category ELSE o.category END AS category,
    CASE WHEN n.url IS NOT NULL THEN n.availability ELSE o.availability END AS availability,
    CASE WHEN n.url IS NOT NULL THEN n.rating ELSE o.rating END AS rating,
    NULL::VARCHAR AS image_url,
    CASE WHEN o.url IS NOT NULL THEN {{0}} ELSE {{1}} END AS first_seen_at,
    CASE WHEN n.url IS NOT NULL THEN {{1}} ELSE {{0}} END AS last_seen_at,
    CASE WHEN n.url IS NOT NULL THEN {_LAST} ELSE {_LAST} - 1 END AS touched_run,
    coalesce(w.price, p.previous_price) AS known_price,
    CASE WHEN w.url IS NOT NULL THEN w.id ELSE p.source_product_id END AS known_price_id,
    CASE WHEN n.url IS NOT NULL THEN p.previous_price END AS prior_price,
    CASE WHEN n.url IS NOT NULL THEN p.source_product_id END AS prior_price_id
  FROM old o FULL JOIN new n ON o.url = n.url
    LEFT JOIN prev p ON p.url = coalesce(n.url, o.url)
    LEFT JOIN newest w ON w.url = coalesce(n.url, o.url))"""

# Observations stored in groups, one commit after the other: {0} gives a row its commit,
# {1} the run that commit belongs to.
_STORED = """placed AS (SELECT *, ({0})::BIGINT AS g FROM obs),
latest AS (
  SELECT *, {1} AS run FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY g DESC, event_id DESC) AS rn FROM placed) WHERE rn = 1),
stored AS (
  SELECT l.url, any_value(l.name) AS name, any_value(l.price) AS price, any_value(l.run)::BIGINT AS touched_run,
    arg_max(p.price, (p.g, p.event_id)) FILTER (p.price IS NOT NULL) AS known_price,
    arg_max(p.price, (p.g, p.event_id)) FILTER (p.price IS NOT NULL AND p.g < l.g) AS prior_price
  FROM latest l JOIN (SELECT url, price, g AS g, event_id FROM placed) p ON p.url = l.url GROUP BY l.url)"""

_DAILY = _STORED.format(f"greatest(run_id - {_LAST} + 4, 1)", "g")

_CHANGES = f"""SELECT c.name, c.category, p.previous_price, c.price AS current_price,
    round_even((c.price - p.previous_price) * 100, 0) / 100 AS change
  FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY event_id) AS rn FROM obs
      WHERE run_id = {_LAST}) WHERE rn = 1 AND price IS NOT NULL) c JOIN prev p ON p.url = c.url"""

# A run cleans its batch first, so the earlier run knows one price per page: that of
# its first row, if it has one.
_RUN_CHANGES = f"""WITH {_OBS}, firsts AS (
    SELECT *, row_number() OVER (PARTITION BY url, run_id = {_LAST} ORDER BY event_id) AS rn FROM obs)
  SELECT c.name, c.category, p.price AS previous_price, c.price AS current_price,
    round_even((c.price - p.price) * 100, 0) / 100 AS change
  FROM firsts c JOIN firsts p ON p.url = c.url
  WHERE c.rn = 1 AND p.rn = 1 AND c.run_id = {_LAST} AND p.run_id < {_LAST}
    AND c.price IS NOT NULL AND p.price IS NOT NULL"""

_CARDS = """made AS (
  SELECT p_partkey, p_partkey // 20 AS page_no, p_brand, p_size, p_name, p_retailprice,
    count(*) OVER (PARTITION BY p_partkey // 20) AS card_total,
    row_number() OVER (PARTITION BY p_partkey // 20 ORDER BY p_partkey) AS card_pos
  FROM part),
card AS (
  SELECT page_no, 'https://shop.example/list/page-' || page_no || '.html' AS page_url,
    card_pos, card_total,
    CASE p_brand WHEN 'Brand#5' THEN NULL WHEN 'Brand#3' THEN p_name ELSE p_name || ' & co' END AS name,
    'https://shop.example/item_' || p_partkey || '/index.html' AS url,
    CASE WHEN p_brand <> 'Brand#8' THEN round(p_retailprice, 2) END AS price,
    CASE WHEN p_brand <> 'Brand#8' THEN 'GBP' END AS currency,
    CASE WHEN p_size < 25 THEN 'In stock' ELSE 'Out of stock' END AS availability,
    (p_size % 5 + 1)::DOUBLE AS rating,
    'https://shop.example/media/' || p_partkey || '.jpg' AS image_url,
    'item_' || p_partkey AS source_product_id,
    CASE WHEN p_brand = 'Brand#5' THEN 'Failed to parse product card ' || card_pos || '/' || card_total ||
      ': product is missing a title or a link' END AS error
  FROM made)"""

_LIMITED = """ordered AS (
  SELECT *, row_number() OVER (ORDER BY page_no % 10, page_no // 10, card_pos) AS rn FROM card
  WHERE error IS NULL AND page_no % 10 < 4 AND page_no // 10 < 2)"""

_LOGGED = f"""logged AS (
  SELECT CASE WHEN run_id = {_LAST} THEN 2 ELSE 1 END::BIGINT AS id, count(*) AS found,
    count(*) FILTER (category <> 'error') AS good FROM obs GROUP BY 1
  UNION ALL SELECT 3, 0, 0)"""

_WALK = """links AS (
  SELECT page_id, 'https://shop.example/walk/' || page_id AS page, page_id // 25 AS listing,
    CASE WHEN page_id % 25 <> 24 THEN 'https://shop.example/walk/' || (page_id + 1)
      WHEN (page_id // 25) % 4 = 1 THEN 'https://shop.example/walk/' || (page_id - 24) || '#top'
      WHEN (page_id // 25) % 4 = 2 THEN 'https://shop.example/walk/gone/' || page_id
      WHEN (page_id // 25) % 4 = 3 THEN 'https://shop.example/walk/' || (page_id - 10) END AS next_url
  FROM pages),
walk AS (
  SELECT listing AS seed, 0 AS depth, 'https://shop.example/walk/' || min(page_id) AS url,
    ['https://shop.example/walk/' || min(page_id)] AS seen
  FROM links GROUP BY listing
  UNION ALL
  SELECT w.seed, w.depth + 1, l.next_url, list_append(w.seen, split_part(l.next_url, '#', 1))
  FROM walk w JOIN links l ON l.page = split_part(w.url, '#', 1)
    JOIN links n ON n.page = split_part(l.next_url, '#', 1)
  WHERE NOT list_contains(w.seen, split_part(l.next_url, '#', 1)))"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _band(column: str) -> str:
    return _BAND.format(column)


def _shelf(rows: str) -> str:
    """The rows of a table of products as the analytics read them."""
    return f"cat AS (SELECT *, {_STATUS.format('availability')} AS availability_status FROM {rows})"


def _labels(pairs: list[tuple[str, str]], source: str) -> str:
    rows = [
        f"SELECT {pos}::BIGINT AS pos, '{label}' AS label, {value} AS value FROM {source}"
        for pos, (label, value) in enumerate(pairs, start=1)
    ]
    return "\nUNION ALL ".join(rows)


def _currency(symbol: str) -> str:
    return (
        f"CASE {symbol} WHEN '£' THEN 'GBP' WHEN '$' THEN 'USD' WHEN '€' THEN 'EUR' "
        f"WHEN '₹' THEN 'INR' WHEN '¥' THEN 'JPY' ELSE nullif({symbol}, '') END"
    )


def _band_counts(source: str) -> str:
    labels = ", ".join(f"('{b}')" for b in ("0-10", "10-20", "20-30", "30-40", "40-50", "50+"))
    return (
        f"SELECT price_bucket, count(price) AS product_count FROM (VALUES {labels}) l(price_bucket) "
        f"LEFT JOIN (SELECT price, {_band('price')} AS b FROM {source}) ON b = price_bucket GROUP BY 1"
    )


_TAGGED = rf"({_NOT_SP_TAG}*?)\s*([0-9.,]+)"
_FIRST = "(SELECT min(card_pos) FROM card)"

ORACLE: dict[str, str] = {
    "price_parse": _with(_TXT)
    + f"""SELECT o_orderkey, raw, amount, CASE WHEN amount IS NOT NULL THEN {_currency('symbol')} END AS currency
FROM (SELECT *, TRY_CAST(replace(regexp_extract(raw, '{_TAGGED}', 2), ',', '') AS DOUBLE) AS amount,
  regexp_extract(raw, '{_TAGGED}', 1) AS symbol FROM txt)""",
    "price_clean_currency": _with(_TXT)
    + f"""SELECT o_orderkey, raw AS raw_price,
  TRY_CAST(replace(regexp_extract(raw, '[0-9.,]+'), ',', '') AS DOUBLE) AS price,
  {_currency(f"regexp_extract(raw, '{_NOT_SP_TAG}+')")} AS currency FROM txt""",
    "rating_parse": r"""SELECT o_orderkey, css_class, CASE WHEN regexp_matches(css_class, '\bone\b', 'i') THEN 1
  WHEN regexp_matches(css_class, '\btwo\b', 'i') THEN 2 WHEN regexp_matches(css_class, '\bthree\b', 'i') THEN 3
  WHEN regexp_matches(css_class, '\bfour\b', 'i') THEN 4 WHEN regexp_matches(css_class, '\bfive\b', 'i') THEN 5
  END::BIGINT AS rating
FROM (SELECT o_orderkey, 'star-rating ' || CASE left(o_orderpriority, 1) WHEN '1' THEN 'One' WHEN '2' THEN 'TWO'
  WHEN '3' THEN 'three' WHEN '4' THEN 'Four Two' ELSE 'Fiveish' END ||
  CASE WHEN o_orderstatus = 'P' THEN ' five' ELSE '' END AS css_class FROM orders)""",
    "availability_labels": _with(_DIRTY)
    + f"""SELECT availability, canonical, {_STATUS.format('canonical')} AS status, count(*) AS n
FROM (SELECT availability, CASE lower(trim(regexp_replace(availability, '\\s+', ' ', 'g')))
  WHEN 'in stock' THEN 'In Stock' WHEN 'instock' THEN 'In Stock' WHEN 'available' THEN 'In Stock'
  WHEN 'out of stock' THEN 'Out of Stock' WHEN 'outofstock' THEN 'Out of Stock'
  WHEN 'unavailable' THEN 'Out of Stock' ELSE nullif(trim(regexp_replace(availability, '\\s+', ' ', 'g')), '')
  END AS canonical FROM dirty) GROUP BY ALL""",
    "derived_bands": _with(_OBS)
    + f"""SELECT event_id, price, {_band('price')} AS price_bucket, rating,
  CASE WHEN rating IS NULL THEN NULL WHEN rating < 3 THEN 'Low (1-2)' WHEN rating < 4 THEN 'Medium (3)'
    ELSE 'High (4-5)' END AS rating_band, {_STATUS.format('availability')} AS availability_status
FROM (SELECT * REPLACE (price - 5 AS price) FROM obs)""",
    "clean_texts": f"""SELECT doc_id, md5(tidy) AS text_md5, length(tidy)::BIGINT AS n_chars
FROM (SELECT doc_id, coalesce(trim(regexp_replace(text, '{SP}+', ' ', 'g')), '') AS tidy FROM documents)""",
    "url_normalise": r"""SELECT page_id, nullif(split_part(trim(url), '#', 1), '') AS clean_url,
  split_part(url, '#', 1) AS page_key, regexp_matches(trim(url), '^https?://[^\s]+$', 'i') AS is_listing_url
FROM pages""",
    "source_ids": """SELECT page_id, url, CASE WHEN len(p) < 2 THEN NULL WHEN starts_with(p[-1], 'index') THEN p[-2]
  ELSE p[-1] END AS source_product_id
FROM (SELECT page_id, url, list_filter(string_split(url, '/'), lambda x: x <> '') AS p FROM pages)""",
    "header_normalise": """SELECT p_partkey AS part_key, p_name AS name, NULL::VARCHAR AS url, p_retailprice AS price,
  NULL::VARCHAR AS currency, p_type AS category, NULL::VARCHAR AS availability, NULL::DOUBLE AS rating,
  NULL::VARCHAR AS image_url, p_brand AS source_product_id, NULL::VARCHAR AS scraped_at FROM part""",
    "records_from_csv": _with(_OBS)
    + """SELECT name, url, price, currency, category, availability, rating, image_url,
  source_product_id, strftime(seen_at, '%Y-%m-%dT%H:%M:%S') AS scraped_at FROM obs""",
    "validate_mixed_json": """SELECT 'Item ' || event_id AS name,
  CASE WHEN event_type = 'view' THEN value END AS price,
  CASE WHEN event_type <> 'view' THEN 'GBP' END AS currency,
  CASE event_type WHEN 'click' THEN 'invalid_value:price: not a number: "£' || value || '"; '
    WHEN 'error' THEN 'invalid_value:price: not a number: true; '
    WHEN 'view' THEN 'invalid_value:currency: empty or not text: 826; ' ELSE '' END ||
    'warning:source_product_id: absent, URL is the only key' AS summary, true AS is_valid
FROM events""",
    "link_extract": r"""WITH nav AS (
  SELECT url AS page_url, regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1),
    '<a href="[^"]*">[^<]*</a>') AS tags FROM pages),
link AS (SELECT page_url, unnest(tags) AS tag, generate_subscripts(tags, 1) AS nr FROM nav),
parts AS (SELECT page_url, nr, regexp_extract(tag, '>([^<]*)<', 1) AS name,
  regexp_extract(page_url, '^https?://[^/]+') || regexp_extract(tag, 'href="([^"]*)"', 1) AS url FROM link),
kept AS (SELECT page_url, url, min(nr) AS nr, arg_min(trim(name), nr) AS name FROM parts
  WHERE name <> '' AND NOT regexp_matches(url, '/the$') GROUP BY page_url, url)
SELECT page_url, row_number() OVER (PARTITION BY page_url ORDER BY nr) AS pos, name, url FROM kept""",
    "link_resolve": r"""WITH parts AS (
  SELECT page_id, url, regexp_extract(url, '^https?://[^/]+') AS host,
    regexp_replace(regexp_extract(url, '^https?://[^/]+([^?#]*)', 1), '[^/]*$', '') AS folder FROM pages)
SELECT page_id, host || '/top/z' AS rooted, 'https://other.example/q' AS absolute,
  host || regexp_replace(folder, '[^/]+/$', '') || 'x/y' AS upward,
  regexp_extract(url, '^[^?#]*') || '?p=2' AS queried FROM parts""",
    "link_resolve_hrefs": r"""WITH hrefs AS (
  SELECT page_id, regexp_extract(url, '^https?://[^/]+') AS host,
    regexp_replace(regexp_extract(url, '^https?://[^/]+([^?#]*)', 1), '[^/]*$', '') AS folder,
    regexp_extract_all(html, 'href="([^"]*)"', 1) AS found FROM pages),
each AS (SELECT page_id, host, folder, unnest(found) AS href, generate_subscripts(found, 1) - 1 AS nr FROM hrefs)
SELECT page_id, nr, CASE WHEN href LIKE '/%' THEN host || href WHEN href LIKE 'http%' THEN href
    ELSE host || folder || href END AS target,
  host || folder || 'b' || href AS below FROM each""",
    "product_extract": _with(_CARDS)
    + """SELECT page_url, card_pos, card_total, name, url, price, currency, availability, rating, image_url,
  source_product_id, error FROM card""",
    "next_page_links": _with(_CARDS)
    + """SELECT page_url AS url, CASE WHEN more THEN 'page-' || (page_no + 10) || '.html' END AS next_href,
  CASE WHEN more THEN 'https://shop.example/list/page-' || (page_no + 10) || '.html' END AS next_url
FROM (SELECT DISTINCT page_no, page_url, page_no + 10 <= (SELECT max(page_no) FROM card) AS more FROM card)
UNION ALL SELECT 'https://shop.example/index.html', NULL, NULL""",
    "collect_catalogue": _with(_CARDS)
    + """SELECT name, url, price, currency, 'Listing ' || (page_no % 10) AS category, availability, rating, image_url,
  source_product_id, '2024-05-01T00:00:00+00:00' AS scraped_at FROM card WHERE error IS NULL""",
    "collect_stats": _with(_CARDS)
    + """SELECT 10::BIGINT AS categories_found, 10::BIGINT AS categories_scraped,
  count(DISTINCT page_no) AS pages_visited,
  greatest(10 - count(DISTINCT page_no), 0) AS pages_failed, count(error) AS parser_errors,
  0::BIGINT AS duplicates_in_run, count(*) - count(error) AS records_scraped FROM card""",
    "collect_shared": _with(_CARDS)
    + """SELECT 12::BIGINT AS categories_found, 12::BIGINT AS categories_scraped,
  count(DISTINCT page_no) + count(DISTINCT page_no) FILTER (page_no % 10 = 0) AS pages_visited,
  1 + greatest(10 - count(DISTINCT page_no), 0) AS pages_failed,
  count(error) + count(error) FILTER (page_no % 10 = 0) AS parser_errors,
  count(*) FILTER (page_no % 10 = 0 AND error IS NULL) AS duplicates_in_run,
  count(*) - count(error) AS records_scraped FROM card""",
    "collect_limited": _with(_CARDS, _LIMITED)
    + "SELECT 'Listing ' || (page_no % 10) AS category, url, price, rating FROM ordered WHERE rn <= 45",
    "collect_limited_walks": _with(_CARDS, _LIMITED)
    + """SELECT listing + 1 AS seed,
  CASE WHEN listing = at_listing THEN at_depth + 1 ELSE least(pages, 2) END AS pages_visited,
  0::BIGINT AS pages_failed, NULL::VARCHAR AS failed_url, 0::BIGINT AS duplicates_detected,
  coalesce(listing = at_listing, false) OR pages > 2 AS stopped_early, false AS stopped_on_failure
FROM (SELECT page_no % 10 AS listing, count(DISTINCT page_no) AS pages FROM card GROUP BY 1)
  LEFT JOIN (SELECT page_no % 10 AS at_listing, page_no // 10 AS at_depth FROM ordered WHERE rn = 45) ON true
WHERE listing < 4 AND (at_listing IS NULL OR listing <= at_listing)""",
    "listing_walk": "WITH RECURSIVE "
    + _WALK
    + """,
ends AS (SELECT seed, count(*) AS n, arg_max(split_part(url, '#', 1), depth) AS page FROM walk GROUP BY seed)
SELECT seed, n AS pages_visited, (l.next_url IS NOT NULL AND x.page IS NULL)::BIGINT AS pages_failed,
  CASE WHEN x.page IS NULL THEN l.next_url END AS failed_url, (x.page IS NOT NULL)::BIGINT AS duplicates_detected,
  false AS stopped_early, (l.next_url IS NOT NULL AND x.page IS NULL) AS stopped_on_failure
FROM ends e JOIN links l ON l.page = e.page LEFT JOIN links x ON x.page = split_part(l.next_url, '#', 1)""",
    "listing_walk_visits": "WITH RECURSIVE "
    + _WALK
    + "\nSELECT seed, depth::BIGINT AS depth, url FROM walk WHERE depth < 20",
    "dedup_two_key": """WITH RECURSIVE arrivals AS MATERIALIZED (
  SELECT event_id, row_number() OVER (ORDER BY event_id) AS nr,
    'https://shop.example/u/' || user_id || '#' || event_type AS url, 'https://shop.example/u/' || user_id AS page,
    CASE WHEN event_type = 'signup' THEN '' ELSE 'k' || regexp_extract(props, '[0-9]+') END AS source_product_id
  FROM events),
seen AS (
  SELECT 0::BIGINT AS nr, []::VARCHAR[] AS pages, []::VARCHAR[] AS ids, false AS kept
  UNION ALL
  SELECT nr, CASE WHEN fresh THEN list_append(pages, page) ELSE pages END,
    CASE WHEN fresh AND source_product_id <> '' THEN list_append(ids, source_product_id) ELSE ids END, fresh
  FROM (SELECT a.nr, a.page, a.source_product_id, s.pages, s.ids, NOT list_contains(s.pages, a.page)
      AND NOT (a.source_product_id <> '' AND list_contains(s.ids, a.source_product_id)) AS fresh
    FROM seen s JOIN arrivals a ON a.nr = s.nr + 1))
SELECT event_id, url, source_product_id FROM arrivals JOIN seen USING (nr) WHERE kept""",
    "dedup_chain": """SELECT event_id, 'https://shop.example/c/' || (event_id // 2) AS url,
  CASE WHEN event_id % 64 <> 0 THEN 'k' || ((event_id + 1) // 2) END AS source_product_id
FROM events WHERE event_id % 2 = 0""",
    "dedup_in_run": _with(_OBS)
    + """SELECT event_id, url, source_product_id FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY event_id) AS rn FROM obs) WHERE rn = 1""",
    "validate_records": _with(_DIRTY, _VALID) + "SELECT * FROM valid",
    "validate_split": _with(_DIRTY, _VALID)
    + """SELECT CASE WHEN is_valid THEN 'accepted' ELSE 'rejected' END AS part, count(*) AS n,
  count(price) AS priced, count(rating) AS rated FROM valid GROUP BY is_valid""",
    "validate_issues": _with(_DIRTY, _ISSUES)
    + "SELECT issue_type, field_name, count(*) AS n FROM issues GROUP BY ALL",
    "reject_summary": _with(_DIRTY, _ISSUES)
    + """SELECT event_id, string_agg(issue_type || ':' || field_name, '; ' ORDER BY nr) AS errors FROM issues
WHERE issue_type <> 'missing_optional' AND event_id IN (SELECT event_id FROM dirty WHERE k < 25)
GROUP BY event_id""",
    "clean_records": _with(_DIRTY, _TAGS, _STANDARD)
    + """SELECT * EXCLUDE (k, raw_rating, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY event_id) AS rn FROM standard)
WHERE rn = 1 AND name IS NOT NULL AND url IS NOT NULL""",
    "quality_counters": _with(_DIRTY, _TAGS, _STANDARD)
    + """SELECT count(*) AS rows_in, count(*) FILTER (rn = 1 AND name IS NOT NULL AND url IS NOT NULL) AS rows_out,
  count(*) FILTER (rn > 1) AS duplicates_removed,
  count(*) FILTER (raw_price IS NOT NULL AND price IS NULL) AS invalid_prices,
  count(*) FILTER (raw_rating < 0 OR raw_rating > 5) AS invalid_ratings,
  count(*) FILTER (k < 60) AS normalised_availability
FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY event_id) AS rn FROM standard)""",
    "dedup_first": _with(_OBS)
    + """SELECT event_id, url, name, price, category FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY event_id) AS rn FROM obs) WHERE rn = 1""",
    "category_analysis": _with(_CAT, _SUMMARY) + "SELECT * FROM agg",
    "catalog_kpis": _with(_CAT, _KPIS) + "SELECT * FROM kpi",
    "availability_breakdown": _with(_CAT)
    + "SELECT availability_status AS availability, count(*) AS product_count FROM cat GROUP BY 1",
    "availability_raw": _with(_CAT)
    + """SELECT coalesce(availability, 'Unknown') AS availability, n AS product_count
FROM (SELECT availability, count(*) AS n FROM cat GROUP BY 1)""",
    "rating_distribution": _with(_CAT)
    + """SELECT round_even(rating, 0)::BIGINT || ' star' AS rating, count(*) AS product_count FROM cat
WHERE rating IS NOT NULL GROUP BY round_even(rating, 0)""",
    "price_distribution": _with(_CAT) + _band_counts("cat"),
    "price_distribution_observed": _with(_OBS) + _band_counts("obs"),
    "top_rated": _with(_OBS)
    + """SELECT name, category, rating, price, url FROM obs WHERE rating IS NOT NULL
ORDER BY rating DESC, price ASC NULLS LAST, event_id LIMIT 10""",
    "cheapest": _with(_OBS)
    + """SELECT name, category, price, rating, url FROM obs WHERE price IS NOT NULL
ORDER BY price, event_id LIMIT 10""",
    "price_changes": _with(_OBS, _PREVIOUS) + _CHANGES,
    "previous_prices_asof": _with(_OBS, _PREVIOUS.replace("arg_max(source_product_id, event_id)", "arg_max(source_product_id, (run_id, event_id))").replace("arg_max(price, event_id)", "arg_max(price, (run_id, event_id))"))
    + "SELECT * FROM prev",
    "upsert_snapshot": _with(_OBS, _PREVIOUS, _SNAPSHOT.format("'2024-02-01 00:00:00'", "'2024-02-02 00:00:00'"))
    + "SELECT * FROM snap",
    "constraint_check": """SELECT 'required' AS "constraint", 'name' AS key, count(*) AS n FROM events
WHERE event_type = 'signup' HAVING count(*) > 0
UNION ALL SELECT 'unique source_product_id', user_id::VARCHAR, count(*) FROM events WHERE event_type <> 'error'
GROUP BY user_id HAVING count(*) > 1""",
    "late_run": _with(_OBS, _STORED.format(f"CASE WHEN run_id < {_LAST} THEN 2 ELSE 1 END", "3 - g")) + "SELECT * FROM stored",
    "late_run_prices": _with(_OBS, _STORED.format(f"CASE WHEN run_id < {_LAST} THEN 2 ELSE 1 END", "3 - g"))
    + """SELECT category, count(*) AS n, format('{:.2f}', sum(change))::DOUBLE AS total FROM (
  SELECT n.category, round_even((s.price - s.prior_price) * 100, 0) / 100 AS change FROM stored s JOIN (
    SELECT url, arg_max(category, event_id) AS category FROM placed WHERE g = 2 GROUP BY url) n USING (url)
  WHERE s.touched_run = 1 AND s.price IS NOT NULL AND s.prior_price IS NOT NULL) GROUP BY category
UNION ALL SELECT 'known before', count(*), format('{:.2f}', sum(price))::DOUBLE FROM (
  SELECT arg_max(price, event_id) AS price FROM placed WHERE g = 1 AND price IS NOT NULL GROUP BY url)""",
    "small_batches": _with(_OBS, _DAILY) + "SELECT * FROM stored",
    "store_kpis": _with(_OBS, _DAILY, _shelf("latest"), _KPIS) + "SELECT * FROM kpi",
    "store_categories": _with(_OBS, _DAILY, _shelf("latest"), _SUMMARY) + "SELECT * FROM agg",
    "store_distributions": _with(_OBS, _DAILY)
    + "\nUNION ALL ".join(
        f"""SELECT '{at}' AS at, * FROM (
  WITH {_shelf(rows)}
  SELECT 'availability' AS "table", availability_status AS label, count(*) AS n FROM cat GROUP BY ALL
  UNION ALL SELECT 'rating', round_even(rating, 0)::BIGINT || ' star', count(*) FROM cat
    WHERE rating IS NOT NULL GROUP BY round_even(rating, 0)
  UNION ALL SELECT 'price', band, n FROM (
    SELECT price_bucket AS band, product_count AS n FROM ({_band_counts("cat")})))"""
        for at, rows in (
            ("before", """(SELECT * FROM (SELECT * EXCLUDE rn, row_number() OVER (
    PARTITION BY url ORDER BY g DESC, event_id DESC) AS rn FROM (SELECT *, 0 AS rn FROM placed WHERE g < 4)) WHERE rn = 1)"""),
            ("after", "latest"),
        )
    ),
    "run_clock": _with(_OBS)
    + f"""SELECT run_id, t AS started, t AS first, t AS last, t AS touched, n FROM (
  SELECT run_id, '2024-05-0' || run_id || ' 12:34:56' AS t, n FROM (
    SELECT CASE WHEN run_id = {_LAST} THEN 2 ELSE 1 END::BIGINT AS run_id, count(DISTINCT url) AS n FROM obs GROUP BY 1))""",
    "id_clashes": _with(_OBS)
    + """SELECT 'unique source_product_id' AS "constraint", source_product_id AS key, 2::BIGINT AS n FROM obs
WHERE category = 'error' GROUP BY source_product_id""",
    "history_append": _with(_OBS)
    + f"""SELECT CASE WHEN run_id = {_LAST} THEN 2 ELSE 1 END::BIGINT AS run_id, count(*) AS n, count(price) AS priced,
  count(DISTINCT url) AS urls, format('{{:.2f}}', sum(price))::DOUBLE AS total,
  CASE WHEN run_id = {_LAST} THEN '2024-02-02 00:00:00' ELSE '2024-02-01 00:00:00' END AS captured_at
FROM obs GROUP BY ALL""",
    "snapshot_ordered": _with(_OBS, _PREVIOUS, _SNAPSHOT.format("'2024-02-01 00:00:00'", "'2024-02-02 00:00:00'"))
    + """SELECT source_product_id, name, url, price, currency, category, availability, rating, image_url,
  first_seen_at, last_seen_at FROM snap ORDER BY category NULLS FIRST, name""",
    "previous_prices_snapshot": _with(_OBS, _PREVIOUS) + "SELECT * FROM prev",
    "store_runs": _with(_OBS, _LOGGED)
    + """SELECT id, '2024-02-0' || id || ' 00:00:00' AS started_at,
  CASE WHEN id < 3 THEN '2024-02-0' || id || ' 00:00:00' END AS finished_at,
  CASE WHEN id = 3 THEN 'running' WHEN good = 0 THEN 'no_data' WHEN found > good THEN 'partial'
    ELSE 'success' END AS status,
  0::BIGINT AS categories, 0::BIGINT AS pages_visited, 0::BIGINT AS pages_failed,
  found AS records_found, good AS records_accepted, found - good AS records_rejected FROM logged""",
    "run_by_id": _with(_OBS, _LOGGED)
    + """SELECT id, '2024-02-02 00:00:00' AS started_at,
  CASE WHEN good = 0 THEN 'no_data' WHEN found > good THEN 'partial' ELSE 'success' END AS status
FROM logged WHERE id = 2""",
    "history_rows": _with(_OBS)
    + f"""SELECT event_id AS seq, source_product_id, name, url, price, currency,
  CASE WHEN run_id = {_LAST} THEN '2024-02-02 00:00:00' ELSE '2024-02-01 00:00:00' END AS captured_at,
  CASE WHEN run_id = {_LAST} THEN 2 ELSE 1 END::BIGINT AS run_id FROM obs""",
    "snapshot_count": _with(_OBS) + "SELECT count(DISTINCT url) AS products FROM obs",
    "analysis_bundle": _with(_OBS, _PREVIOUS)
    + f"""SELECT 'kpi total_products' AS "table", 'all' AS label, count(*)::DOUBLE AS value FROM obs
UNION ALL SELECT 'kpi unique_products', 'all', count(DISTINCT url) FROM obs
UNION ALL SELECT 'kpi avg_price', 'all', format('{{:.2f}}', avg(price))::DOUBLE FROM obs
UNION ALL SELECT 'kpi median_price', 'all', format('{{:.2f}}', median(price))::DOUBLE FROM obs
UNION ALL SELECT 'category', category, format('{{:.2f}}', avg(price))::DOUBLE FROM obs GROUP BY category
UNION ALL SELECT 'availability', {_STATUS.format("availability")}, count(*) FROM obs GROUP BY 2
UNION ALL SELECT 'rating', round_even(rating, 0)::BIGINT || ' star', count(*) FROM obs
  WHERE rating IS NOT NULL GROUP BY 2
UNION ALL SELECT 'price', price_bucket, product_count FROM ({_band_counts("obs")})
UNION ALL SELECT * FROM (SELECT 'top', url, rating FROM obs WHERE rating IS NOT NULL
  ORDER BY rating DESC, price ASC NULLS LAST, event_id LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'cheapest', url, price FROM obs WHERE price IS NOT NULL
  ORDER BY price, event_id LIMIT 10)
UNION ALL SELECT 'changes', name, change FROM ({_CHANGES})""",
    "report_sizes": _with(_OBS)
    + f""", cleaned AS (
  SELECT * FROM (SELECT *, CASE WHEN run_id = {_LAST} THEN 2 ELSE 1 END::BIGINT AS run,
    row_number() OVER (PARTITION BY url, run_id = {_LAST} ORDER BY event_id) AS rn FROM obs) WHERE rn = 1),
changed AS (SELECT count(*) AS n FROM cleaned c JOIN cleaned p ON p.url = c.url AND p.run = 1 AND c.run = 2
  WHERE c.price IS NOT NULL AND p.price IS NOT NULL),
sizes AS (SELECT run, count(*) AS n, count(DISTINCT coalesce(category, '')) AS groups,
    count(DISTINCT {_STATUS.format("availability")}) AS states, count(DISTINCT round_even(rating, 0)) AS stars,
    count(rating) AS rated, count(price) AS priced FROM cleaned GROUP BY run)
SELECT run AS run_id, t.name AS "table", CASE t.name WHEN 'dashboard' THEN 10 WHEN 'product_data' THEN n
    WHEN 'category_analysis' THEN groups WHEN 'chart_categories' THEN least(groups, 10)
    WHEN 'chart_availability' THEN states WHEN 'chart_price' THEN 6 WHEN 'rating_distribution' THEN stars
    WHEN 'top_rated' THEN least(rated, 10) WHEN 'cheapest' THEN least(priced, 10) ELSE 9 END::BIGINT AS n
FROM sizes, (VALUES ('dashboard'), ('product_data'), ('category_analysis'), ('chart_categories'),
  ('chart_availability'), ('chart_price'), ('rating_distribution'), ('top_rated'), ('cheapest'), ('metadata')) t(name)
UNION ALL SELECT 2, 'price_changes', n FROM changed WHERE n > 0""",
    "run_log": _with(_OBS)
    + """SELECT run_id AS id, min(seen_at) AS started_at, max(seen_at) AS finished_at,
  CASE WHEN count(*) FILTER (category <> 'error') = 0 THEN 'no_data'
    WHEN count(*) FILTER (category = 'error') > 0 THEN 'partial' ELSE 'success' END AS status,
  0::BIGINT AS categories, 0::BIGINT AS pages_visited, 0::BIGINT AS pages_failed, count(*) AS records_found,
  count(*) FILTER (category <> 'error') AS records_accepted,
  count(*) FILTER (category = 'error') AS records_rejected
FROM obs GROUP BY run_id""",
    "dashboard_kpis": _with(_CAT, _KPIS)
    + _labels(
        [
            (label, f"coalesce({name}::VARCHAR, 'n/a')")
            for label, name in [
                ("Total products", "total_products"),
                ("Unique products", "unique_products"),
                ("Categories", "categories"),
                ("In stock", "in_stock"),
                ("Out of stock", "out_of_stock"),
                ("Average price", "avg_price"),
                ("Median price", "median_price"),
                ("Min price", "min_price"),
                ("Max price", "max_price"),
                ("Average rating", "avg_rating"),
            ]
        ],
        "kpi",
    ),
    "report_metadata": _with(_CAT, _KPIS)
    + _labels(
        [
            ("Generated at (UTC)", "'2024-05-01 12:30:00 UTC'"),
            ("Data source", "'https://shop.example'"),
            ("Total rows in dataset", "total_products::VARCHAR"),
            ("Report includes price data", "(avg_price IS NOT NULL)::VARCHAR"),
            ("Report includes rating data", "(avg_rating IS NOT NULL)::VARCHAR"),
            ("duplicates_removed_in_cleaning", "'5'"),
            ("records_rejected", "'2'"),
            ("run_id", "'7'"),
        ],
        "kpi",
    ),
    "chart_categories": _with(_CAT, _SUMMARY)
    + """SELECT category, product_count, avg_price FROM agg
ORDER BY product_count DESC, category NULLS LAST LIMIT 10""",
    "product_sheet": _with(_OBS)
    + f"""SELECT name, price, currency, category, availability, {_STATUS.format('availability')} AS availability_status,
  rating, CASE WHEN rating IS NULL THEN NULL WHEN rating < 3 THEN 'Low (1-2)' WHEN rating < 4 THEN 'Medium (3)'
    ELSE 'High (4-5)' END AS rating_band, {_band('price')} AS price_bucket, url, image_url, source_product_id
FROM obs""",
    "csv_roundtrip": _with(_OBS)
    + f"""SELECT name, url, price, currency, category, availability,
  {_STATUS.format('availability')} AS availability_status, rating,
  CASE WHEN rating IS NULL THEN NULL WHEN rating < 3 THEN 'Low (1-2)' WHEN rating < 4 THEN 'Medium (3)'
    ELSE 'High (4-5)' END AS rating_band, {_band('price')} AS price_bucket, image_url, source_product_id, event_id
FROM obs""",
    "monitor_batches": _RUN_CHANGES,
    "monitor_stream": _RUN_CHANGES,
    "monitor_restart": _RUN_CHANGES,
    "moves_stream": _RUN_CHANGES,
    "monitor_limited": _with(_OBS)
    + f"""SELECT 1::BIGINT AS id, 'success' AS status, count(*) AS records_found, count(*) AS records_accepted,
  count(DISTINCT url) AS products FROM obs WHERE run_id < {_LAST}""",
}
