"""DuckDB twins of the registered queries: one chain of common table expressions and a final select for each."""

from __future__ import annotations

#: Fixed values, written out here so that the twins share nothing with the code they check: agents of the adapter, crawlers, segments that stand for ids.
AGENTS = (
    "'Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X) Mobile/15E148', 'Mozilla/5.0 (Linux; Android 14; Pixel 8) Mobile Safari/537.36', 'Mozilla/5.0 (Linux; Android 14; SM-X200) Safari/537.36', "
    "'Mozilla/5.0 (iPad; CPU OS 17_0 like Mac OS X) Safari/604.1', 'Mozilla/5.0 (X11; Linux x86_64) Chrome/120.0', 'Mozilla/5.0 (compatible; Googlebot/2.1)', NULL"
)
BOTS = "googlebot|bingbot|ahrefsbot|semrushbot|mj12bot|petalbot|yandexbot|bytespider|duckduckbot|baiduspider|applebot|curl/|wget/|python-requests|scrapy|headlesschrome|phantomjs|selenium|puppeteer|playwright"
DYNAMIC = "^([0-9]+|[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}|[0-9a-f]{16,})$"


def uuid(identity: str, opener: str) -> str:
    """A session's id from its visitor and its first event: the name-based UUID (version 5) over SHA-1."""
    h = f"sha1(unhex('9d0c5a1e52b75f4e8c317a60d2f4b815') || encode(concat_ws('|', {identity}, {opener})))"
    return f"(SELECT concat(h[1:8], '-', h[9:12], '-5', h[14:16], '-', translate(h[17], '0123456789abcdef', '89ab89ab89ab89ab'), h[18:20], '-', h[21:32]) FROM (SELECT {h} AS h))"


def base(timeout_s: int, minimum: int, only: str = "true") -> str:
    """Events (those for which ``only`` holds), sessions and scored sessions as named expressions."""
    return f"""
WITH RECURSIVE e0 AS (SELECT ev.*, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k, event_id % (SELECT greatest(count(*), 1) FROM pages) AS pid FROM events ev),
e1 AS (SELECT e0.*, p.url AS page_url FROM e0 LEFT JOIN pages p ON p.page_id = e0.pid),
e2 AS (SELECT *, CASE WHEN event_type = 'view' AND event_id % 2 = 0 THEN 'page_viewed' WHEN event_type = 'view' THEN 'product_viewed' WHEN event_type = 'click' THEN 'click'
  WHEN event_type = 'signup' THEN 'product_added_to_cart' WHEN event_type = 'purchase' THEN 'checkout_started' ELSE 'scroll_depth' END AS event_name FROM e1),
act AS (SELECT 'e' || event_id AS event_id, event_id AS seq, event_name,
  CASE WHEN event_id % 97 = 0 OR event_id % 101 = 0 THEN NULL ELSE 'u' || user_id END AS actor_id,
  CASE WHEN event_id % 101 = 0 THEN NULL ELSE 'c' || user_id END AS client_id,
  CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 83 = 0 THEN '' WHEN event_id % 10 = 0 THEN 'https://shop.example/'
    WHEN event_id % 10 = 1 THEN 'https://shop.example/Products/' || pid || '?utm_source=mail&x=1' WHEN event_id % 10 = 2 THEN 'https://shop.example/products/' || pid || '/'
    WHEN event_id % 10 = 3 THEN 'https://shop.example/collections/' || k || '/all' WHEN event_id % 10 = 4 THEN '/checkout/' || k || '#pay' ELSE page_url END AS url,
  [{AGENTS}][user_id % 7 + 1] AS user_agent,
  CASE WHEN event_name IN ('product_viewed', 'product_added_to_cart') THEN k || CASE WHEN event_id % 5 = 0 THEN '.0' ELSE '' END
    WHEN event_name = 'checkout_started' THEN '[' || k || '.0, ' || (k + 1) || '.0' || CASE WHEN event_id % 11 = 0 THEN '' ELSE ']' END END AS product_id,
  CASE WHEN event_name IN ('product_viewed', 'product_added_to_cart') AND event_id % 7 <> 0 THEN 'Title ' || k WHEN event_name = 'checkout_started' AND event_id % 4 <> 0 THEN '[''Title ' || k || ''', ''Title ' || (k + 1) || ''']' END AS product_title,
  CASE event_id % 4 WHEN 0 THEN 'button' WHEN 1 THEN 'a' WHEN 2 THEN 'input' ELSE '' END AS tag, CASE WHEN event_id % 5 < 2 THEN 'btn-' || k ELSE '' END AS eid, CASE WHEN event_id % 6 = 0 THEN 'buy' ELSE '' END AS ename, CASE WHEN event_id % 4 = 2 THEN 'text' ELSE '' END AS etype,
  CASE WHEN event_id % 4 = 2 THEN '' ELSE left(trim('add to ' || event_type || ' ' || repeat('x', (event_id % 3 * 40)::INT)), 60) END AS evalue,
  CASE WHEN event_name = 'click' THEN CASE event_id % 3 WHEN 0 THEN 'useful_click' WHEN 1 THEN 'dead_click' END END AS click_bucket,
  CASE WHEN event_name = 'scroll_depth' THEN least(value, 100.0) END AS scroll_percent, ts AS client_time,
  CASE WHEN event_id % 53 = 0 THEN ts - INTERVAL 600 SECOND ELSE ts + INTERVAL 90 SECOND END AS received_at FROM e2 WHERE {only}),
r0 AS (SELECT *, CASE WHEN client_time > received_at + INTERVAL 300 SECOND THEN received_at ELSE client_time END AS occurred_at, coalesce(actor_id, client_id) AS identity,
  split_part(split_part(url, '?', 1), '#', 1) AS raw, regexp_replace(split_part(split_part(trim(url), '?', 1), '#', 1), '^.*?://[^/]*', '') AS p0 FROM act),
r1 AS (SELECT *, regexp_replace(lower(CASE WHEN starts_with(p0, '/') THEN p0 ELSE '/' || p0 END), '/+$', '') AS p1 FROM r0),
r2 AS (SELECT *, array_to_string(list_transform(string_split(p1, '/'), lambda s: CASE WHEN regexp_matches(s, '{DYNAMIC}') THEN ':id' ELSE s END), '/') AS p2 FROM r1),
rw AS (SELECT *, CAST(occurred_at AS DATE) AS day, CASE WHEN url IS NULL OR url = '' THEN '(unknown)' WHEN p2 = '' THEN '/' ELSE left(p2, 255) END AS path,
  CASE WHEN user_agent ILIKE '%ipad%' OR user_agent ILIKE '%tablet%' OR (user_agent ILIKE '%android%' AND user_agent NOT ILIKE '%mobile%') THEN 'tablet'
    WHEN user_agent ILIKE '%iphone%' OR user_agent ILIKE '%android%' OR user_agent ILIKE '%mobile%' THEN 'mobile' ELSE 'desktop' END AS device FROM r2),
rt AS (SELECT *, CASE WHEN path = '/' THEN 'home' WHEN starts_with(path, '/products/') THEN 'pdp' WHEN starts_with(path, '/collections/') THEN 'collection' WHEN starts_with(path, '/checkout') THEN 'checkout' ELSE 'other' END AS ptype,
  nullif(trim(replace(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '+', ' ')), '') AS utm FROM rw),
o0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY identity ORDER BY occurred_at, received_at, event_name = 'click', seq) AS rn, CASE WHEN event_name = 'product_added_to_cart' THEN lower(product_id) END AS cl FROM rt WHERE identity IS NOT NULL),
g1 AS (SELECT *, sum(CASE WHEN prev IS NULL OR date_diff('microsecond', prev, occurred_at) > {timeout_s * 1_000_000} THEN 1 ELSE 0 END) OVER (PARTITION BY identity ORDER BY rn ROWS UNBOUNDED PRECEDING)::BIGINT AS session_no FROM (SELECT *, lag(occurred_at) OVER (PARTITION BY identity ORDER BY rn) AS prev FROM o0)),
fo AS (SELECT identity, rn, 1::BIGINT AS session_no, occurred_at AS last, CASE WHEN cl IS NULL THEN []::VARCHAR[] ELSE [cl] END AS claims, true AS counts FROM o0 WHERE rn = 1
  UNION ALL SELECT identity, rn, CASE WHEN fresh THEN session_no + 1 ELSE session_no END, CASE WHEN again THEN last ELSE occurred_at END,
    CASE WHEN again THEN claims WHEN fresh THEN CASE WHEN cl IS NULL THEN []::VARCHAR[] ELSE [cl] END WHEN cl IS NULL THEN claims ELSE list_append(claims, cl) END, NOT again
  FROM (SELECT *, cl IS NOT NULL AND NOT fresh AND list_contains(claims, cl) AS again FROM (SELECT o0.identity, o0.rn, o0.cl, o0.occurred_at, fo.session_no, fo.last, fo.claims, date_diff('microsecond', fo.last, o0.occurred_at) > {timeout_s * 1_000_000} AS fresh FROM fo JOIN o0 ON o0.identity = fo.identity AND o0.rn = fo.rn + 1))),
g2 AS MATERIALIZED (SELECT * EXCLUDE (opener), {uuid('identity', 'opener')} AS session_id FROM (SELECT o0.*, fo.session_no, fo.counts, first_value(o0.event_id) OVER (PARTITION BY o0.identity, fo.session_no ORDER BY o0.rn) AS opener FROM o0 JOIN fo USING (identity, rn))),
ins AS (SELECT * EXCLUDE (rn, cl, counts) FROM g2 WHERE counts),
ev AS (SELECT * FROM ins UNION ALL BY NAME SELECT *, NULL::BIGINT AS session_no, sha1(event_id) AS session_id FROM rt WHERE identity IS NULL),
ss AS (SELECT identity, session_no, session_id, min(occurred_at) AS session_start, max(occurred_at) AS session_end, count(*) AS event_count,
  count(*) FILTER (event_name = 'page_viewed') AS page_view_count, count(*) FILTER (event_name = 'product_viewed') AS product_view_count, count(*) FILTER (event_name = 'click') AS click_count,
  count(*) FILTER (event_name = 'product_added_to_cart') AS add_to_cart_count, count(*) FILTER (event_name = 'checkout_started') AS checkout_started_count, count(*) FILTER (event_name = 'scroll_depth') AS scroll_count,
  count(*) FILTER (click_bucket = 'useful_click') AS useful_click_count, count(*) FILTER (click_bucket = 'dead_click') AS dead_click_count,
  last(client_id ORDER BY occurred_at, seq) FILTER (client_id IS NOT NULL) AS client_id, first(utm ORDER BY occurred_at, seq) FILTER (utm IS NOT NULL) AS first_utm_source,
  list(event_name ORDER BY occurred_at, seq, event_name) AS names, date_diff('microsecond', min(occurred_at), max(occurred_at)) // 1000 AS ms, CAST(min(occurred_at) AS DATE) AS sday FROM ins GROUP BY ALL),
sw AS (SELECT *, session_no < max(session_no) OVER (PARTITION BY identity) OR session_end < (SELECT max(session_end) FROM ss) - INTERVAL {timeout_s + 60} SECOND AS closed FROM ss),
en AS (SELECT session_id, coalesce(first(ptype ORDER BY occurred_at, seq) FILTER (event_name = 'page_viewed' AND url <> ''), 'other') AS entry_page_type,
  coalesce(max(list_position(['other', 'home', 'collection', 'pdp', 'checkout'], ptype)) FILTER (event_name = 'page_viewed' AND url <> ''), 1) AS page_rank,
  coalesce(max(user_agent) FILTER (event_name = 'page_viewed' AND url <> ''), max(user_agent) FILTER (event_name = 'click')) AS ua FROM ev GROUP BY ALL),
p9 AS (SELECT sday, list_sort(list(dead_click_count / click_count))[CAST(round_even(0.9 * (count(*) - 1), 0) AS BIGINT) + 1] AS p90 FROM ss WHERE click_count >= 10 GROUP BY ALL),
sc0 AS (SELECT ss.*, en.entry_page_type, en.page_rank, en.ua, p9.p90,
  CASE WHEN coalesce(regexp_matches(lower(ua), '{BOTS}') OR regexp_matches(lower(ua), '\\bbot\\b'), false) THEN 'bot'
    WHEN event_count <= 1 AND ms < 1000 AND click_count = 0 AND scroll_count = 0 THEN 'zero_signal' ELSE 'scored' END AS status,
  CASE WHEN (product_view_count >= 2 AND page_view_count >= 2) OR useful_click_count >= 2 OR scroll_count >= 2 OR ms >= 30000 THEN 2
    WHEN product_view_count >= 2 OR page_view_count >= 2 OR useful_click_count >= 1 OR scroll_count >= 1 OR ms >= 10000 THEN 1 ELSE 0 END AS stage
  FROM ss LEFT JOIN en USING (session_id) LEFT JOIN p9 USING (sday)),
sc1 AS (SELECT *, [0.70::DOUBLE, 0.85, 0.95, 1.05, 1.15][page_rank] AS modifier, CASE WHEN click_count >= 10 AND dead_click_count / click_count > p90 THEN -12.0::DOUBLE ELSE 0.0::DOUBLE END AS stuck,
  0.0::DOUBLE + least(product_view_count::DOUBLE, 4.0::DOUBLE) * 11.0::DOUBLE + least(useful_click_count::DOUBLE, 12.0::DOUBLE) * 2.2::DOUBLE + least(ms / 60000.0::DOUBLE, 6.0::DOUBLE) * 4.5::DOUBLE + least(scroll_count::DOUBLE, 8.0::DOUBLE) * 1.8::DOUBLE + least(page_view_count::DOUBLE, 6.0::DOUBLE) * 1.5::DOUBLE AS raw1,
  0.0::DOUBLE + least(product_view_count::DOUBLE, 4.0::DOUBLE) * 8.0::DOUBLE + least(page_view_count::DOUBLE, 6.0::DOUBLE) * 3.0::DOUBLE + least(useful_click_count::DOUBLE, 12.0::DOUBLE) * 4.0::DOUBLE + least(ms / 60000.0::DOUBLE, 6.0::DOUBLE) * 4.0::DOUBLE + least(scroll_count::DOUBLE, 8.0::DOUBLE) * 1.0::DOUBLE
    + 5.0::DOUBLE * ((page_view_count >= 2)::INT + (product_view_count >= 2)::INT + (useful_click_count >= 2)::INT + (useful_click_count >= 5)::INT + (product_view_count >= 2 AND page_view_count >= 2)::INT) AS raw3,
  (event_count <= 2)::INT + (ms < 5000)::INT AS short FROM sc0),
sc2 AS (SELECT *, {_score("raw1", "stuck", -20, -20)} AS v1, {_score("raw1", "stuck", -5, -2)} AS v2, {_score("raw3", "0.0::DOUBLE", -2, -1)} AS v3 FROM sc1),
sc AS (SELECT *, CASE WHEN status = 'scored' THEN v1 END AS score FROM sc2),
ca0 AS (SELECT sday, count(*) AS scored, count(*) FILTER (stage >= 1 AND score > 0) AS population, list_sort(list(score) FILTER (stage >= 1 AND score > 0)) AS l FROM sc WHERE status = 'scored' GROUP BY ALL),
ca AS (SELECT sday, scored, population, CASE WHEN population >= {minimum} THEN {_pick("l", "population", 0.35)} ELSE 25.0::DOUBLE END AS p35, CASE WHEN population >= {minimum} THEN {_pick("l", "population", 0.72)} ELSE 55.0::DOUBLE END AS p72,
  CASE WHEN population >= {minimum} THEN 'percentile' ELSE 'fixed_fallback' END AS basis FROM ca0),
aso AS (SELECT d.sday, t.sday AS from_day, coalesce(t.p35, 25.0::DOUBLE) AS p35, coalesce(t.p72, 55.0::DOUBLE) AS p72, q.p90 FROM (SELECT DISTINCT sday FROM sc) d ASOF LEFT JOIN (SELECT * FROM ca WHERE day(sday) % 3 <> 1) t ON d.sday >= t.sday LEFT JOIN p9 q ON q.sday = t.sday),
bk0 AS (SELECT sc.*, ca.p35, ca.p72, CASE WHEN status = 'scored' THEN CASE WHEN score <= 0 OR score < p35 OR stage = 0 THEN 'low' WHEN score < p72 OR stage < 2 THEN 'medium' ELSE 'high' END END AS bucket FROM sc LEFT JOIN ca USING (sday)),
bk AS (SELECT *, CASE WHEN status = 'scored' THEN CASE WHEN entry_page_type = 'checkout' OR checkout_started_count > 0 OR add_to_cart_count > 0 THEN 'high' ELSE bucket END END AS operational_bucket FROM bk0),
lv AS (SELECT ev.*, CASE WHEN s.session_id IS NULL OR s.status = 'bot' THEN 'unclassified' WHEN s.ms < 5000 OR (s.click_count = 0 AND s.scroll_count = 0) THEN 'low'
  WHEN s.click_count > 0 AND (s.add_to_cart_count > 0 OR s.checkout_started_count > 0) THEN 'high' ELSE 'medium' END AS behavior_level,
  coalesce(CASE WHEN s.status = 'scored' THEN s.bucket ELSE 'unclassified' END, 'unclassified') AS score_level FROM ev LEFT JOIN bk s USING (session_id)),
vl0 AS (SELECT session_id, identity, stage, p90, event_count, page_view_count, product_view_count, click_count, useful_click_count, dead_click_count, scroll_count, ms, add_to_cart_count, checkout_started_count,
  unnest([{{'version': 'V1', 'score': v1, 'raw': raw1, 'bo': CASE WHEN short > 0 THEN -20 ELSE 0 END, 'own': false, 'floor': false, 'hf': 0}}, {{'version': 'V2', 'score': v2, 'raw': raw1, 'bo': CASE short WHEN 2 THEN -5 WHEN 1 THEN -2 ELSE 0 END, 'own': false, 'floor': true, 'hf': 0}}, {{'version': 'V3', 'score': v3, 'raw': raw3, 'bo': CASE short WHEN 2 THEN -2 WHEN 1 THEN -1 ELSE 0 END, 'own': false, 'floor': true, 'hf': 0}},
    {{'version': 'V4', 'score': v2, 'raw': raw1, 'bo': CASE short WHEN 2 THEN -5 WHEN 1 THEN -2 ELSE 0 END, 'own': true, 'floor': true, 'hf': 0}}, {{'version': 'V5', 'score': v3, 'raw': raw3, 'bo': CASE short WHEN 2 THEN -2 WHEN 1 THEN -1 ELSE 0 END, 'own': true, 'floor': true, 'hf': 2}}, {{'version': 'V1C', 'score': v1, 'raw': raw1, 'bo': CASE WHEN short > 0 THEN -20 ELSE 0 END, 'own': true, 'floor': true, 'hf': 2}}, {{'version': 'V6', 'score': v2, 'raw': raw1, 'bo': CASE short WHEN 2 THEN -5 WHEN 1 THEN -2 ELSE 0 END, 'own': true, 'floor': true, 'hf': 2}}], recursive := true)
  FROM sc WHERE status = 'scored'),
vc0 AS (SELECT version, count(*) FILTER (score > 0 AND (NOT own OR stage >= 1)) AS n, list_sort(list(score) FILTER (score > 0 AND (NOT own OR stage >= 1))) AS l FROM vl0 GROUP BY ALL),
vc AS (SELECT version, n, coalesce({_pick("l", "n", 0.35)}, 0.0::DOUBLE) AS p35, coalesce({_pick("l", "n", 0.72)}, 0.0::DOUBLE) AS p72 FROM vc0),
vl1 AS (SELECT vl0.*, p35, p72, n AS population, CASE WHEN score <= 0 OR score < p35 THEN 'low' WHEN score < p72 THEN 'medium' ELSE 'high' END AS free FROM vl0 LEFT JOIN vc USING (version)),
vl AS MATERIALIZED (SELECT *, CASE WHEN floor AND stage = 0 THEN 'low' WHEN free = 'high' AND stage < hf THEN 'medium' ELSE free END AS bucket FROM vl1),
pr1 AS (SELECT *, CASE WHEN starts_with(product_id, '[') THEN list_filter(list_transform(CASE WHEN ends_with(product_id, ']') THEN string_split(product_id[2:-2], ',') ELSE string_split(product_id[2:], ',')[:-2] END,
  lambda x: regexp_replace(trim(x), '\\.0$', '')), lambda x: regexp_matches(x, '^[0-9]+$')) END AS ids, string_split(replace(replace(product_title, '[''', ''), ''']', ''), ''', ''') AS names FROM lv),
pr0 AS (SELECT *, list_distinct(ids) AS cart FROM pr1)
"""


def _round(x: str, digits: int) -> str:
    """x to some decimals by its exact binary value, ties to even, as Python rounds: the product's error is found by splitting x in halves."""
    s, half = f"{10**digits}::DOUBLE", "(134217729::DOUBLE * v - (134217729::DOUBLE * v - v))"
    over = f"((v * {s} - floor(v * {s}) - 0.5::DOUBLE) + (({half} * {s} - v * {s}) + (v - {half}) * {s}))"
    return f"list_transform([({x})::DOUBLE], lambda v: (floor(v * {s}) + CASE WHEN {over} > 0 THEN 1::DOUBLE WHEN {over} < 0 THEN 0::DOUBLE ELSE floor(v * {s}) % 2::DOUBLE END) / {s})[1]"


def _score(raw: str, stuck: str, both: float, either: float) -> str:
    return _round(f"greatest(0.0::DOUBLE, least(({raw} + {stuck} + CASE short WHEN 2 THEN {both}.0::DOUBLE WHEN 1 THEN {either}.0::DOUBLE ELSE 0.0::DOUBLE END) * modifier, 100.0::DOUBLE))", 2)


def _pick(values: str, n: str, p: float) -> str:
    return f"{values}[CAST(round_even({p}::DOUBLE * ({n} - 1), 0) AS BIGINT) + 1]"


def _ratio(n: str, d: str) -> str:
    return _round(f"({n}) / nullif({d}, 0)", 4)


def _pct(n: str, d: str) -> str:
    return f"coalesce({_round(f'100.0::DOUBLE * ({n}) / nullif({d}, 0)', 2)}, 0.0::DOUBLE)"


DAY, START, END = "CAST(day AS VARCHAR) AS summary_date", "strftime(session_start, '%Y-%m-%d %H:%M:%S') AS session_start", "strftime(session_end, '%Y-%m-%d %H:%M:%S') AS session_end"
SDAY = "CAST(sday AS VARCHAR) AS summary_date"
COUNTS = "event_count, page_view_count, product_view_count, click_count, useful_click_count, dead_click_count, add_to_cart_count, checkout_started_count, scroll_count"
PRODUCTS = "sum(v)::BIGINT AS product_views, sum(vv)::BIGINT AS unique_viewers, sum(vs)::BIGINT AS unique_sessions, sum(a)::BIGINT AS add_to_cart_count, sum(c)::BIGINT AS checkout_started_count, min(ti) AS product_title"


#: The items of a cart as {i: id, t: title}: the first of each id, titles only if there is one for each.
CART = "list_filter(list_transform(ids, lambda x, j: {'i': x, 't': CASE WHEN len(names) = len(ids) THEN names[j] END, 'f': list_position(ids, x) = j}), lambda y: y.f)"


def _products(keys: str, sep: str) -> str:
    return f"""(SELECT day, {keys}{sep} regexp_replace(product_id, '\\.0$', '') AS product_id, v, vv, vs, a, c, ti FROM (SELECT day, {keys}{sep} product_id, min(nullif(trim(product_title), '')) AS ti, count(*) FILTER (event_name = 'product_viewed') AS v, count(DISTINCT actor_id) FILTER (event_name = 'product_viewed') AS vv,
  count(DISTINCT session_id) FILTER (event_name = 'product_viewed') AS vs, count(*) FILTER (event_name = 'product_added_to_cart') AS a, count(*) FILTER (event_name = 'checkout_started') AS c FROM pr0 WHERE product_id <> '' AND NOT starts_with(product_id, '[') GROUP BY ALL)
  UNION ALL SELECT day, {keys}{sep} it.i AS product_id, 0, 0, 0, 0, count(*), min(nullif(trim(it.t), '')) FROM (SELECT day, {keys}{sep} unnest({CART}) AS it FROM pr0 WHERE event_name = 'checkout_started') GROUP BY ALL)"""


HOUR, LONG = (1800, 500), (86400, 20)
HIGH = "count(*) FILTER (operational_bucket = 'high')"
VERSIONS = ("V1", "V2", "V3", "V4", "V5", "V1C", "V6")
COUNTED = "count(*) AS n, count(*) FILTER (add_to_cart_count > 0) AS atc, count(*) FILTER (checkout_started_count > 0) AS checkout, count(*) FILTER (add_to_cart_count > 0 OR checkout_started_count > 0) AS either"


def _outcome_sql(keys: str, rest: str, rows: str) -> str:
    rates = ", ".join(f"{_pct(m, 'n')} AS {m}_rate, {_pct(f'sum({m}) OVER w', 'sum(n) OVER w')} AS all_{m}" for m in ("atc", "checkout", "either"))
    lifts = ", ".join(f"{_round(f'{m}_rate / nullif(all_{m}, 0)', 3)} AS {m}_lift" for m in ("atc", "checkout", "either"))
    return f"SELECT * EXCLUDE (all_atc, all_checkout, all_either), {lifts}, n < 30 AS too_small FROM (SELECT *, {rates} FROM (SELECT {keys}, {COUNTED} FROM {rows} GROUP BY ALL) WINDOW w AS (PARTITION BY {rest}))"


def _monotonic_sql(keys: str, rows: str) -> str:
    kinds = {"atc": "add_to_cart_count > 0", "checkout": "checkout_started_count > 0", "either": "(add_to_cart_count > 0 OR checkout_started_count > 0)"}
    buckets = ("low", "medium", "high")
    of = {(b, m): _pct(f"count(*) FILTER (bucket = '{b}' AND {c})", f"count(*) FILTER (bucket = '{b}')") for b in buckets for m, c in kinds.items()}
    counts = ", ".join(f"{x} AS {b}_{m}_rate" for (b, m), x in of.items()) + ", " + ", ".join(f"count(*) FILTER (bucket = '{b}') AS n_{b}" for b in buckets)
    verdicts = ", ".join(f"CASE WHEN n_low > 0 AND n_medium > 0 AND n_high > 0 AND low_{m}_rate < medium_{m}_rate AND medium_{m}_rate < high_{m}_rate THEN 'PASS' ELSE 'FAIL' END AS {m}_monotonic" for m in kinds)
    return f"SELECT * EXCLUDE (n_low, n_medium, n_high), {verdicts} FROM (SELECT {keys}, {counts} FROM {rows} GROUP BY {keys})"


#: (timeout and percentile minimum, final select, more named expressions if it needs them) by query name.
SELECTS: dict[str, tuple] = {
    "sess_window_builtin": (HOUR, f"SELECT identity, {START}, {END}, n AS event_count FROM (SELECT identity, session_no, min(occurred_at) AS session_start, max(occurred_at) AS session_end, count(*) AS n FROM g1 GROUP BY ALL)"),
    "sess_closed_rows": (HOUR, f"SELECT identity, session_no, session_id, {START}, {END}, {COUNTS}, client_id, ms AS session_time_spent_ms FROM ss"),
    "sess_idle_sweep": (HOUR, "SELECT identity, session_no, session_id, closed FROM sw"),
    "sess_fragments_lag": ((600, 500), "SELECT identity, session_id, gap_s FROM (SELECT *, date_diff('microsecond', lag(session_end) OVER (PARTITION BY identity ORDER BY session_start, session_no), session_start) // 1000000 AS gap_s FROM ss) WHERE gap_s BETWEEN 0 AND 1800"),
    "sess_first_utm": (LONG, "SELECT session_id, first_utm_source FROM ss"),
    "evt_atc_keep_first": (LONG, "SELECT event_id, session_id, product_id FROM ins WHERE event_name = 'product_added_to_cart'"),
    "evt_dedup": (HOUR, "SELECT event_id, event_name FROM act"),
    "evt_future_clock": (HOUR, "SELECT CAST(CAST(client_time AS DATE) AS VARCHAR) AS day, count(*) AS events, count(*) FILTER (occurred_at <> client_time) AS corrected FROM r0 GROUP BY 1"),
    "fn_page_path": (HOUR, "SELECT event_id, path AS page_path FROM rw"),
    "fn_page_type": (HOUR, "SELECT ptype AS page_type, count(*) AS n FROM rt GROUP BY ALL"),
    "fn_utm": (HOUR, "SELECT event_id, utm AS utm_source FROM rt"),
    "fn_device": (HOUR, "SELECT device AS device_type, count(*) AS n FROM rw GROUP BY ALL"),
    "fn_cart_explode": (LONG, "SELECT event_id, unnest(cart) AS product_id FROM pr0"),
    "fn_sequence_path": (LONG, "SELECT session_id, sq AS sequence, sha1(sq) AS sequence_hash FROM @SEQ"),
    "ru_incremental_pages": (LONG, "@PAGES"),
    "snk_score_update": (LONG, "SELECT session_id, event_count, CASE WHEN status = 'scored' THEN score END AS score, CASE WHEN status = 'scored' THEN bucket ELSE 'pending' END AS bucket FROM bk"),
    "ru_page_behavior": (LONG, "@PAGES"),
    "ru_page_behavior_exact": (LONG, "SELECT summary_date, page_path, page_views, x.ua AS unique_actors, x.us AS unique_sessions, clicks FROM (@PAGES) p JOIN (SELECT CAST(day AS VARCHAR) AS d, path, count(DISTINCT actor_id) AS ua, count(DISTINCT session_id) AS us FROM ev WHERE event_name <> 'click' AND url <> '' GROUP BY ALL) x ON x.d = p.summary_date AND x.path = p.page_path"),
    "ru_product_behavior": (LONG, f"SELECT *, unique_sessions AS sessions_with_product_view, least({_ratio('add_to_cart_count', 'product_views')}, 99.9999 + 0 * product_views / nullif(product_views, 0)) AS view_to_atc_rate, least({_ratio('checkout_started_count', 'product_views')}, 99.9999 + 0 * product_views / nullif(product_views, 0)) AS view_to_checkout_rate FROM (SELECT {DAY}, product_id, {PRODUCTS} FROM {_products('', '')} GROUP BY day, product_id)"),
    "ru_product_intent": (LONG, f"SELECT {DAY}, b.basis AS basis, b.level AS level, product_id, {PRODUCTS} FROM (SELECT *, unnest([{{'basis': 'behavior', 'level': behavior_level}}, {{'basis': 'score', 'level': score_level}}]) AS b FROM {_products('behavior_level, score_level', ',')}) GROUP BY day, b.basis, b.level, product_id"),
    "ru_path_daily": (LONG, f"SELECT *, {_ratio('sessions_with_atc', 'session_count')} AS conversion_to_atc, {_ratio('sessions_with_checkout', 'session_count')} AS conversion_to_checkout, left(split_part(sequence, '>', 1), 100) AS first_event FROM (SELECT {SDAY}, sha1(sq) AS sequence_hash, sq AS sequence, count(*) AS session_count, count(DISTINCT identity) AS unique_actor_count, count(*) FILTER (add_to_cart_count > 0) AS sessions_with_atc, count(*) FILTER (checkout_started_count > 0) AS sessions_with_checkout FROM @SEQ GROUP BY sday, sq)"),
    "ru_heatmap_stored_days": (LONG, f"SELECT {DAY}, path AS page_path, device AS device_type, sum(n)::BIGINT AS page_views, sum(s)::BIGINT AS sessions, sum(h)::BIGINT AS high_sessions, sum(m)::BIGINT AS medium_sessions, sum(l)::BIGINT AS low_sessions FROM (SELECT day, raw, path, device, count(*) AS n, count(DISTINCT session_id) AS s, count(DISTINCT session_id) FILTER (behavior_level = 'high') AS h, count(DISTINCT session_id) FILTER (behavior_level = 'medium') AS m, count(DISTINCT session_id) FILTER (behavior_level = 'low') AS l FROM lv WHERE day BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' AND event_name = 'page_viewed' AND url <> '' GROUP BY ALL) WHERE path <> '(unknown)' GROUP BY day, path, device"),
    "ru_heatmap": (LONG, f"SELECT {DAY}, path AS page_path, device AS device_type, sum(n)::BIGINT AS page_views, sum(s)::BIGINT AS sessions, sum(h)::BIGINT AS high_sessions, sum(m)::BIGINT AS medium_sessions, sum(l)::BIGINT AS low_sessions FROM (SELECT day, raw, path, device, count(*) AS n, count(DISTINCT session_id) AS s, count(DISTINCT session_id) FILTER (behavior_level = 'high') AS h, count(DISTINCT session_id) FILTER (behavior_level = 'medium') AS m, count(DISTINCT session_id) FILTER (behavior_level = 'low') AS l FROM lv WHERE event_name = 'page_viewed' AND url <> '' GROUP BY ALL) WHERE path <> '(unknown)' GROUP BY day, path, device"),
    "ru_affected_dates": (HOUR, "SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS summary_date FROM (SELECT unnest(generate_series(greatest(CAST(min(received_at) - INTERVAL 3600 SECOND AS DATE), CAST(max(occurred_at) AS DATE) - 30), CAST(max(occurred_at) AS DATE), INTERVAL 1 DAY)) AS d FROM r0)"),
    "sc_enrichment": (LONG, "SELECT session_id, entry_page_type, page_rank, ua AS user_agent FROM en"),
    "sc_exclusions": (LONG, "SELECT status, stage, count(*) AS sessions FROM sc GROUP BY ALL"),
    "sc_scores": (LONG, "SELECT session_id, status, stage, score FROM sc"),
    "sc_dead_click_p90": (LONG, "SELECT CAST(sday AS VARCHAR) AS day, p90 FROM p9"),
    "sc_buckets": (LONG, "SELECT session_id, score, bucket, operational_bucket FROM bk"),
    "sc_actor_best": (LONG, "SELECT identity, CASE WHEN n > 0 THEN session_id END AS best_session, score AS best_score, bucket AS best_bucket, n AS scored_sessions FROM (SELECT *, count(score) OVER (PARTITION BY identity) AS n, row_number() OVER (PARTITION BY identity ORDER BY score DESC NULLS LAST, session_id) AS k FROM bk) WHERE k = 1"),
    "ev_versions_long": (LONG, "SELECT session_id, version, score, stage, bucket FROM vl"),
    "ev_score_bands": (LONG, "SELECT version, band, count(*) AS n, count(*) FILTER (add_to_cart_count > 0) AS atc, min(score) AS lo, max(score) AS hi FROM (SELECT vl.*, (e1 <= score)::INT + (e2 <= score)::INT + (e3 <= score)::INT + (e4 <= score)::INT AS band FROM vl JOIN (SELECT version, " + ", ".join(f"{_pick('list_sort(list(score))', 'count(*)', p)} AS e{i}" for i, p in enumerate((0.2, 0.4, 0.6, 0.8), 1)) + " FROM vl WHERE score > 0 GROUP BY ALL) USING (version) WHERE score > 0) GROUP BY ALL"),
    "ev_landing_cohort": (LONG, "SELECT version, landing, count(*) AS n, count(*) FILTER (bucket <> 'low') AS promoted, count(*) FILTER (add_to_cart_count > 0) AS atc, landing AND count(*) FILTER (bucket <> 'low') * 20 > count(*) AS failure FROM (SELECT *, page_view_count = 1 AND product_view_count <= 1 AND useful_click_count = 0 AND scroll_count = 0 AND event_count <= 2 AS landing FROM vl) GROUP BY version, landing"),
    "ev_stage_crosstab": (LONG, "SELECT version, stage, count(*) FILTER (bucket = 'low') AS low, count(*) FILTER (bucket = 'medium') AS medium, count(*) FILTER (bucket = 'high') AS high FROM vl GROUP BY ALL"),
    "dq_reconciliation": (LONG, "SELECT status, count(*) AS sessions, count(DISTINCT session_id) AS distinct_sessions, count(DISTINCT identity) AS actors, sum(event_count)::BIGINT AS events FROM bk GROUP BY ALL"),
    "dq_levels": (LONG, "SELECT CASE WHEN status = 'bot' THEN 'unclassified' WHEN lo THEN 'low' WHEN click_count > 0 AND ct THEN 'high' ELSE 'medium' END AS level, CASE WHEN status = 'bot' THEN 'bot' WHEN lo THEN 'low' WHEN click_count > 0 AND (ct OR product_view_count > 0) THEN 'high' ELSE 'medium' END AS report_level, count(*) AS sessions FROM (SELECT *, ms < 5000 OR (click_count = 0 AND scroll_count = 0) AS lo, add_to_cart_count > 0 OR checkout_started_count > 0 AS ct FROM bk) GROUP BY 1, 2"),
    "dq_histogram": (LONG, "SELECT b AS bin, count(score) AS n FROM range(10) r(b) LEFT JOIN bk ON status = 'scored' AND least(floor(score / 10), 9)::BIGINT = b GROUP BY b"),
    "dq_engagement_cohorts": (LONG, f"SELECT cohort, n, atc, checkout, {_ratio('atc', 'n')} AS atc_share FROM (SELECT cohort, count(*) AS n, count(*) FILTER (add_to_cart_count > 0) AS atc, count(*) FILTER (checkout_started_count > 0) AS checkout FROM (SELECT *, unnest([CASE WHEN click_count > 0 THEN 'any_click' END, CASE WHEN useful_click_count > 0 THEN 'useful_click' END, CASE WHEN scroll_count > 0 THEN 'scrolled' END, CASE WHEN page_view_count >= 2 THEN 'two_pages' END, CASE WHEN product_view_count > 0 THEN 'product' END, CASE WHEN event_count <= 2 OR ms < 5000 THEN 'bounce' END]) AS cohort FROM bk WHERE status <> 'bot') WHERE cohort IS NOT NULL GROUP BY cohort)"),
    "dq_bounce_top": (LONG, "SELECT page_view_count, product_view_count, click_count, scroll_count, add_to_cart_count, checkout_started_count, count(*) AS n FROM bk WHERE event_count <= 2 OR ms < 5000 GROUP BY ALL ORDER BY n DESC, page_view_count, product_view_count, click_count, scroll_count, add_to_cart_count, checkout_started_count LIMIT 10"),
    "dq_page_types": (LONG, "SELECT entry_page_type, count(*) AS n, count(*) FILTER (bucket <> operational_bucket) AS overridden, count(*) FILTER (operational_bucket = 'high') AS operational_high FROM bk WHERE status = 'scored' GROUP BY ALL"),
    "dq_view_duplication": (LONG, "SELECT count(*) AS pairs, coalesce(sum(n - 1), 0)::BIGINT AS extra_views, count(*) FILTER (span <= 5) AS rapid FROM (SELECT session_id, product_id, count(*) AS n, date_diff('microsecond', min(occurred_at), max(occurred_at)) // 1000000 AS span FROM ev WHERE event_name = 'product_viewed' AND product_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1)"),
    "dq_event_census": (LONG, "SELECT event_name, count(*) AS events, count(DISTINCT session_id) AS sessions, count(DISTINCT actor_id) AS actors, count(scroll_percent) AS with_percent FROM ev GROUP BY ALL"),
    "dq_backlog": (LONG, "SELECT CAST(sday AS VARCHAR) AS day, count(*) AS sessions, count(*) FILTER (NOT closed) AS open FROM sw GROUP BY sday"),
    "dq_anti_sessions": (LONG, "SELECT CAST(sday AS VARCHAR) AS day, count(*) AS sessions FROM ss WHERE session_id NOT IN (SELECT session_id FROM ev WHERE event_name <> 'click') GROUP BY sday"),
    "dq_dead_clicks": (LONG, "SELECT CASE WHEN click_count = 0 THEN 'none' WHEN dead_click_count = 0 THEN 'zero' WHEN dead_click_count / click_count <= 0.5 THEN 'up_to_half' WHEN dead_click_count < click_count THEN 'most' ELSE 'all' END AS band, count(*) AS sessions, sum(click_count)::BIGINT AS clicks, sum(dead_click_count)::BIGINT AS dead FROM bk GROUP BY 1"),
    "sess_gap_lag": (HOUR, f"SELECT event_id, identity, session_no, {uuid('identity', 'opener')} AS session_id FROM (SELECT *, first_value(event_id) OVER (PARTITION BY identity, session_no ORDER BY rn) AS opener FROM g1)"),
    "sess_reconstruct": (HOUR, "SELECT event_id, identity, session_no, counts FROM g2"),
    "sess_reconstruct_days": (LONG, "SELECT event_id, identity, session_no, counts FROM g2"),
    "sess_overlap": (HOUR, "SELECT (SELECT count(*) FROM n2) AS new_sessions, (SELECT count(*) FROM n2 WHERE o > 1) AS merged, (SELECT sum(m)::BIGINT FROM n2) AS events_moved, (SELECT count(*) FROM o2) AS old_sessions, (SELECT count(*) FROM o2 WHERE k > 1) AS split FROM (SELECT 1)", "n0 AS (SELECT *, sum(CASE WHEN prev IS NULL OR date_diff('microsecond', prev, occurred_at) > 7200000000 THEN 1 ELSE 0 END) OVER (PARTITION BY identity ORDER BY rn ROWS UNBOUNDED PRECEDING) AS nn FROM g1), n1 AS (SELECT identity, session_no, nn, count(*) AS c FROM n0 GROUP BY ALL), n2 AS (SELECT identity, nn, count(*) AS o, sum(c) - max(c) AS m FROM n1 GROUP BY ALL), o2 AS (SELECT identity, session_no, count(*) AS k FROM n1 GROUP BY ALL)"),
    "sess_integrity": (HOUR, "SELECT count(*) AS sessions, sum(event_count)::BIGINT AS session_events, count(*) FILTER (page_view_count + product_view_count + click_count + add_to_cart_count + checkout_started_count + scroll_count <> event_count) AS odd_counters, count(*) FILTER (session_end < session_start) AS reversed, (SELECT count(*) FROM ins WHERE identity IS NOT NULL) AS identified_events FROM ss"),
    "sess_adjacent_overlap": ((600, 500), "SELECT identity, session_id, gap_s FROM (SELECT *, CAST(trunc(date_diff('microsecond', lag(session_end) OVER (PARTITION BY identity ORDER BY session_start, session_no), session_start) / 1000000) AS BIGINT) AS gap_s FROM ss) WHERE gap_s < 3600"),
    "sess_repaired": (LONG, "SELECT o.b AS old_without_browsing, o.e AS old_events, o.f AS old_fragments, o.n AS old_sessions, o.l[CAST(floor(o.n * 50 / 100) AS BIGINT) + 1] AS old_p50, o.l[CAST(floor(o.n * 75 / 100) AS BIGINT) + 1] AS old_p75, o.l[CAST(floor(o.n * 90 / 100) AS BIGINT) + 1] AS old_p90, w.b AS new_without_browsing, w.e AS new_events, w.f AS new_fragments, w.n AS new_sessions, w.l[CAST(floor(w.n * 50 / 100) AS BIGINT) + 1] AS new_p50, w.l[CAST(floor(w.n * 75 / 100) AS BIGINT) + 1] AS new_p75, w.l[CAST(floor(w.n * 90 / 100) AS BIGINT) + 1] AS new_p90 FROM (SELECT count(*) FILTER (cart AND p = 0 AND q = 0) AS b, sum(c)::BIGINT AS e, count(*) FILTER (gap BETWEEN 0 AND 86400) AS f, count(*) AS n, list_sort(list(ms)) AS l FROM olds) o, (SELECT count(*) FILTER (cart AND p = 0 AND q = 0) AS b, sum(c)::BIGINT AS e, count(*) FILTER (gap BETWEEN 0 AND 86400) AS f, count(*) AS n, list_sort(list(ms)) AS l FROM news) w", "olds AS (SELECT *, date_diff('microsecond', lag(b1) OVER (PARTITION BY identity ORDER BY a1, session_no), a1) // 1000000 AS gap FROM (SELECT identity, session_no, count(*) AS c, count(*) FILTER (event_name IN ('product_added_to_cart', 'checkout_started')) > 0 AS cart, count(*) FILTER (event_name = 'page_viewed') AS p, count(*) FILTER (event_name = 'product_viewed') AS q, min(occurred_at) AS a1, max(occurred_at) AS b1, date_diff('microsecond', min(occurred_at), max(occurred_at)) // 1000 AS ms FROM g1 GROUP BY ALL)), news AS (SELECT identity, session_no, event_count AS c, add_to_cart_count > 0 OR checkout_started_count > 0 AS cart, page_view_count AS p, product_view_count AS q, ms, date_diff('microsecond', lag(session_end) OVER (PARTITION BY identity ORDER BY session_start, session_no), session_start) // 1000000 AS gap FROM ss)"),
    "sess_patterns": (LONG, "SELECT pattern, count(*) AS sessions FROM @JOURNEY GROUP BY ALL ORDER BY sessions DESC, pattern LIMIT 10"),
    "sess_step_entries": (LONG, "SELECT session_id, row_number() OVER (PARTITION BY session_id ORDER BY occurred_at, seq) AS step, event_name, event_id, click_bucket, client_id, NULL::VARCHAR AS visitor_id, utm AS utm_source FROM ins"),
    "src_range_scan": (HOUR, "SELECT event_name, count(*) AS events, count(DISTINCT client_id) AS clients FROM act WHERE client_time >= TIMESTAMP '2024-01-08' AND client_time < TIMESTAMP '2024-01-15' GROUP BY ALL"),
    "src_rebuild_window": (HOUR, "SELECT event_id, event_name FROM act WHERE (client_time >= TIMESTAMP '2024-01-09 22:00:00' AND client_time < TIMESTAMP '2024-01-11 02:00:00') OR (client_time >= TIMESTAMP '2024-01-11' AND client_time < TIMESTAMP '2024-01-12' AND date_diff('microsecond', received_at, client_time) > 300999999)"),
    "src_json_sessions": (LONG, "SELECT CAST(sday AS VARCHAR) AS day, count(*) AS sessions, sum(event_count)::BIGINT AS events FROM ss GROUP BY sday"),
    "jn_semi_buyers": (HOUR, "SELECT event_name, count(*) AS events FROM act WHERE client_id IN (SELECT client_id FROM act WHERE event_name = 'checkout_started') GROUP BY ALL"),
    "evt_topic_route": (HOUR, "SELECT event_name, CASE WHEN lower(event_name) IN ('checkout_started', 'checkout_completed') THEN 'intent.checkout' WHEN contains(lower(event_name), 'add_to_cart') OR contains(lower(event_name), 'added_to_cart') THEN 'intent.atc' WHEN lower(event_name) = 'click' THEN 'intent.click' ELSE 'intent.other' END AS topic, count(*) AS events FROM act GROUP BY ALL"),
    "evt_contract": (HOUR, "SELECT reason AS reject_reason, count(*) AS n FROM @REASONS GROUP BY ALL"),
    "evt_dead_letters": (HOUR, "SELECT CASE WHEN event_name = 'checkout_started' THEN 'intent.checkout' WHEN event_name = 'product_added_to_cart' THEN 'intent.atc' WHEN event_name = 'click' THEN 'intent.click' ELSE 'intent.other' END AS topic, (seq % 3)::INTEGER AS partition, seq AS offset, reason AS reject_reason FROM @REASONS WHERE reason IS NOT NULL"),
    "evt_quarantined": (HOUR, "SELECT 'intent.dlq' AS topic, 'k' || seq AS key, reason AS dlq_reason, CASE WHEN event_name = 'checkout_started' THEN 'intent.checkout' WHEN event_name = 'product_added_to_cart' THEN 'intent.atc' WHEN event_name = 'click' THEN 'intent.click' ELSE 'intent.other' END AS dlq_source_topic, (seq % 3)::VARCHAR AS dlq_source_partition, seq::VARCHAR AS dlq_source_offset, CASE WHEN seq % 5 = 0 THEN '3' ELSE '1' END AS dlq_attempts, '1700000000' AS dlq_failed_at FROM @REASONS WHERE reason IS NOT NULL"),
    "evt_event_rows": (HOUR, "SELECT event_id, event_name, actor_id, client_id, CASE WHEN seq % 37 = 15 THEN repeat('9', 101) WHEN seq % 37 <> 14 THEN product_id END AS product_id, product_title, CASE seq % 6 WHEN 0 THEN 2.0 WHEN 2 THEN 1000.0 END AS quantity, (seq % 50) * 1.5::DOUBLE AS price, scroll_percent, strftime(occurred_at, '%Y-%m-%d %H:%M:%S') AS occurred_at, utm AS utm_source, NULL::VARCHAR AS utm_medium, NULL::VARCHAR AS utm_campaign, NULL::VARCHAR AS utm_term, NULL::VARCHAR AS utm_content FROM @REASONS WHERE reason IS NULL AND event_name <> 'click'"),
    "evt_click_rows": (HOUR, "SELECT event_id, (seq % 1000)::INTEGER AS click_x, 12 AS click_y, CASE seq % 4 WHEN 0 THEN 'Button' WHEN 1 THEN 'A' WHEN 2 THEN 'input' END AS click_tag, CASE WHEN seq % 5 < 2 THEN 'Btn-' || k END AS click_element_id, CASE WHEN seq % 6 = 0 THEN 'Buy' END AS click_element_name, CASE WHEN seq % 4 = 2 THEN 'TEXT' END AS click_element_type, CASE WHEN seq % 4 = 1 THEN url END AS click_href, seq % 2 = 0 AS url_changed, CASE WHEN seq % 3 = 0 THEN true END AS cart_changed, NULL::BOOLEAN AS ui_changed, click_bucket, strftime(occurred_at, '%Y-%m-%d %H:%M:%S') AS occurred_at FROM @REASONS WHERE reason IS NULL AND event_name = 'click'"),
    "evt_message_sessions": ((86400, 20, "event_id % 37 > 15 OR (event_id % 37 = 11 AND event_name = 'click') OR (event_id % 37 IN (12, 13) AND event_name <> 'click') OR (event_id % 37 IN (14, 15) AND event_name <> 'product_added_to_cart')"), f"SELECT event_id, identity, {uuid(chr(39) + 'b|' + chr(39) + ' || identity', 'opener')} AS session_id FROM (SELECT *, first_value(event_id) OVER (PARTITION BY identity, session_no ORDER BY occurred_at, received_at, event_name = 'click', seq) AS opener FROM ins)"),
    "evt_receipt_proxy": (HOUR, "SELECT event_id, strftime(CASE WHEN replaced THEN w ELSE client_time END, '%Y-%m-%d %H:%M:%S') AS occurred_at, replaced, CASE WHEN seq % 61 <> 0 THEN -19800::BIGINT END AS offset_s FROM (SELECT *, seq % 61 <> 0 AND client_time > w + INTERVAL 300 SECOND AS replaced FROM (SELECT *, received_at + to_seconds(seq % 400) AS w FROM r0))"),
    "evt_send_order": (HOUR, "SELECT row_number() OVER (ORDER BY received_at, topic, seq % 3, seq) AS place, topic, (seq % 3)::INTEGER AS partition, seq AS offset FROM (SELECT *, CASE WHEN event_name = 'checkout_started' THEN 'intent.checkout' WHEN event_name = 'product_added_to_cart' THEN 'intent.atc' WHEN event_name = 'click' THEN 'intent.click' ELSE 'intent.other' END AS topic FROM act)"),
    "evt_released": (HOUR, "SELECT topic, partition, o AS offset FROM bf WHERE k <= (SELECT min(l) FROM (SELECT max(k) AS l FROM bf WHERE partition = 1 GROUP BY topic)) AND (received_at <= TIMESTAMP '2024-01-19 23:59:49' OR k <= (SELECT min(l) FROM (SELECT max(k) AS l FROM bf GROUP BY topic, partition)))", "bf AS (SELECT *, {'t': received_at, 'n': topic, 'p': partition, 'o': o} AS k FROM (SELECT received_at, seq AS o, (seq % 3)::INTEGER AS partition, CASE WHEN event_name = 'checkout_started' THEN 'intent.checkout' WHEN event_name = 'product_added_to_cart' THEN 'intent.atc' WHEN event_name = 'click' THEN 'intent.click' ELSE 'intent.other' END AS topic FROM act))"),
    "fn_utm_all": (HOUR, "SELECT event_id, utm AS utm_source, CASE WHEN contains(x, '?') AND NOT contains(split_part(x, '?', 1), '#') THEN CASE WHEN contains(split_part(url || '&', '#', 1), '?') AND NOT contains(url, '#') THEN 'Mail a' END END AS utm_medium, CASE WHEN url IS NOT NULL THEN 'é' END AS utm_campaign, NULL::VARCHAR AS utm_term, NULL::VARCHAR AS utm_content FROM (SELECT *, url || '&UTM_Medium=' AS x FROM rt)"),
    "fn_cart_items": (LONG, "SELECT event_id, it.i AS product_id, it.t AS product_title FROM (SELECT event_id, unnest(@CART) AS it FROM pr0 WHERE ids IS NOT NULL)"),
    "fn_stored_path": (LONG, "SELECT s.session_id, sq AS sequence, pattern AS journey FROM @SEQ s JOIN @JOURNEY j USING (session_id)"),
    "fn_sql_functions": (HOUR, "SELECT CASE WHEN raw = '/' THEN 'home' WHEN starts_with(raw, '/products/') THEN 'pdp' WHEN starts_with(raw, '/collections/') THEN 'collection' WHEN starts_with(raw, '/checkout') THEN 'checkout' ELSE 'other' END AS page_type, regexp_replace(product_id, '[.]0$', '') AS product_id, count(*) AS n FROM rt GROUP BY ALL"),
    "fn_sql_pages": (HOUR, f"SELECT event_id, path AS page_path, device AS device_type, CASE WHEN event_name = 'checkout_started' THEN 'intent.checkout' WHEN event_name = 'product_added_to_cart' THEN 'intent.atc' WHEN event_name = 'click' THEN 'intent.click' ELSE 'intent.other' END AS topic, coalesce(regexp_matches(lower(user_agent), '{BOTS}') OR regexp_matches(lower(user_agent), '\\bbot\\b'), false) AS bot FROM rw"),
    "fn_sql_carts": (LONG, "SELECT event_id, it.i AS product_id, it.t AS product_title FROM (SELECT event_id, unnest(@CART) AS it FROM pr0 WHERE ids IS NOT NULL)"),
    "fn_sql_utm": (HOUR, "SELECT event_id, 'utm_source' AS name, utm AS value FROM rt WHERE utm IS NOT NULL"),
    "fn_zones": (HOUR, "SELECT CASE seq % 5 WHEN 0 THEN 'Asia/Kolkata' WHEN 1 THEN 'Europe/Berlin' WHEN 4 THEN 'America/Argentina/Buenos_Aires' ELSE 'UTC' END AS zone, count(*) AS n FROM act GROUP BY ALL"),
    "fn_click_target": (HOUR, "SELECT event_id, @TARGET FROM @CLICKS"),
    "ru_click_behavior": (LONG, f"SELECT summary_date, page_path, target_hash, min(tag) AS tag, min(element_id) AS element_id, min(element_name) AS element_name, min(element_type) AS element_type, min(href) AS href, min(value) AS value, count(*) AS clicks, count(*) FILTER (click_bucket = 'useful_click') AS useful_clicks, count(*) FILTER (click_bucket = 'dead_click') AS dead_clicks, count(DISTINCT actor_id) AS unique_actors FROM (SELECT {DAY}, path AS page_path, click_bucket, actor_id, @TARGET FROM (SELECT *, CASE WHEN seq % 4 = 1 AND path <> '(unknown)' THEN path ELSE '' END AS thref FROM ev WHERE event_name = 'click')) GROUP BY ALL"),
    "ru_daily_summary": (LONG, f"SELECT {SDAY}, count(*) FILTER (closed) AS sessions, count(DISTINCT identity) FILTER (closed) AS unique_actors, " + ", ".join(f"coalesce(sum({c}) FILTER (closed), 0)::BIGINT AS {k}" for k, c in (("total_events", "event_count"), ("page_views", "page_view_count"), ("product_views", "product_view_count"), ("clicks", "click_count"), ("useful_clicks", "useful_click_count"), ("dead_clicks", "dead_click_count"), ("add_to_carts", "add_to_cart_count"), ("checkout_starts", "checkout_started_count"), ("scroll_events", "scroll_count"))) + ", " + ", ".join(f"{_round(f'avg({c}) FILTER (closed)', 4)} AS {k}" for k, c in (("avg_session_time_ms", "ms"), ("avg_events_per_session", "event_count"), ("avg_product_views_per_session", "product_view_count"), ("avg_clicks_per_session", "click_count"))) + f", count(*) AS sessions_started, {_ratio('sum(useful_click_count) FILTER (closed)', 'sum(click_count) FILTER (closed)')} AS useful_click_rate, {_ratio('sum(dead_click_count) FILTER (closed)', 'sum(click_count) FILTER (closed)')} AS dead_click_rate FROM sw GROUP BY sday"),
    "ru_affected_dates_since": (HOUR, "SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS summary_date FROM (SELECT unnest(generate_series(greatest(CAST(min(received_at) - INTERVAL 3600 SECOND AS DATE), CAST(max(occurred_at) AS DATE) - 30), CAST(max(occurred_at) AS DATE), INTERVAL 1 DAY)) AS d FROM r0 WHERE received_at >= TIMESTAMP '2024-01-19 23:00:00')"),
    "ru_affected_dates_first": (HOUR, "SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS summary_date FROM (SELECT unnest(generate_series(greatest(CAST(min(received_at) - INTERVAL 3600 SECOND AS DATE), CAST(max(occurred_at) AS DATE) - 30), CAST(max(occurred_at) AS DATE), INTERVAL 1 DAY)) AS d FROM r0 WHERE received_at >= (SELECT max(received_at) FROM r0) - INTERVAL 21600 SECOND)"),
    "sc_calibration": (LONG, "SELECT CAST(sday AS VARCHAR) AS day, scored, population, p35, p72, p90, basis FROM ca LEFT JOIN p9 USING (sday)"),
    "sc_calibration_fallback": (HOUR, "SELECT CAST(sday AS VARCHAR) AS day, scored, population, p35, p72, p90, basis FROM ca LEFT JOIN p9 USING (sday)"),
    "sc_asof_thresholds": (LONG, "SELECT CAST(sday AS VARCHAR) AS day, CAST(from_day AS VARCHAR) AS from_day, p35, p72, p90 FROM aso"),
    "sc_components": (LONG, "SELECT session_id, v1 AS score, raw1 AS raw_score, stuck AS struggle_penalty, CASE WHEN short > 0 THEN -20.0::DOUBLE ELSE 0.0::DOUBLE END AS bounce_penalty, modifier, ['other', 'home', 'collection', 'pdp', 'checkout'][page_rank] AS page_type, concat_ws('|', CASE WHEN stuck < 0 THEN 'struggle_penalty' END, CASE WHEN short > 0 THEN 'bounce_penalty' END, 'page_modifier_' || ['other', 'home', 'collection', 'pdp', 'checkout'][page_rank]) AS reason_codes FROM sc WHERE status = 'scored'"),
    "sc_classification": (LONG, "SELECT CASE WHEN reason IS NULL THEN 'scored' WHEN reason = 'missing_duration' THEN 'pending' ELSE 'excluded' END AS status, reason, count(*) AS sessions FROM (SELECT CASE WHEN session_no % 11 = 0 OR (session_no % 7 = 0 AND session_no % 5 <> 0) THEN 'invalid_session' WHEN session_no % 5 = 0 THEN 'missing_duration' WHEN status <> 'scored' THEN status END AS reason FROM sc) GROUP BY ALL"),
    "sc_extras": (LONG, "SELECT session_id, event_count, d AS deepest_scroll, v AS products_viewed, a AS products_added FROM ss JOIN (SELECT session_id, max(scroll_percent) AS d, count(DISTINCT regexp_replace(product_id, '\\.0$', '')) FILTER (event_name = 'product_viewed') AS v, count(DISTINCT regexp_replace(product_id, '\\.0$', '')) FILTER (event_name = 'product_added_to_cart') AS a FROM ins GROUP BY ALL) USING (session_id)"),
    "sc_touched_actors": (LONG, "SELECT DISTINCT identity FROM sc"),
    "sc_scoring_window": (LONG, "SELECT session_id, CASE WHEN session_no % 4 = 0 THEN 'pending' ELSE 'scored' END AS status FROM ss WHERE session_end < TIMESTAMP '2024-01-21' AND (session_end >= TIMESTAMP '2024-01-20 11:00:00' OR (session_no % 4 = 0 AND session_start >= TIMESTAMP '2024-01-18'))"),
    "ev_wide_pivot": (LONG, "SELECT session_id, " + ", ".join(f"max(score) FILTER (version = '{v}') AS {v}_score, max(bucket) FILTER (version = '{v}') AS {v}_bucket" for v in VERSIONS) + " FROM vl GROUP BY ALL"),
    "ev_transitions": (LONG, "SELECT p.a, p.b, x.b AS src, y.b AS dst, coalesce(sessions, 0) AS sessions, coalesce(atc, 0) AS atc, coalesce(checkout, 0) AS checkout FROM (SELECT v.v AS a, w.v AS b FROM vs v, vs w WHERE v.i < w.i) p, (VALUES ('low'), ('medium'), ('high')) x(b), (VALUES ('low'), ('medium'), ('high')) y(b) LEFT JOIN (SELECT m.version AS a, n.version AS c, m.bucket AS src, n.bucket AS dst, count(*) AS sessions, count(*) FILTER (m.add_to_cart_count > 0) AS atc, count(*) FILTER (m.checkout_started_count > 0) AS checkout FROM vl m JOIN vl n USING (session_id) GROUP BY ALL) t ON t.a = p.a AND t.c = p.b AND t.src = x.b AND t.dst = y.b", "vs AS (SELECT unnest(['V1', 'V2', 'V3', 'V4', 'V5', 'V1C', 'V6']) AS v, unnest(range(7)) AS i)"),
    "ev_outcome_lift": (LONG, _outcome_sql("version, bucket", "version", "vl")),
    "ev_four_groups": (LONG, _outcome_sql('version, "group"', "version", """(SELECT *, CASE WHEN score = 0 THEN 'zero_score' WHEN bucket <> 'low' THEN bucket WHEN score < p35 THEN 'positive_low' END AS "group" FROM vl) WHERE "group" IS NOT NULL""")),
    "ev_monotonic": (LONG, _monotonic_sql("version", "vl")),
    "ev_engaged": (LONG, _monotonic_sql('version, "group"', """(SELECT *, 'engaged' AS "group" FROM vl WHERE stage >= 1 UNION ALL SELECT *, 'stage2' FROM vl WHERE stage >= 2)""")),
    "ev_score_ties": (LONG, f"SELECT version, score, n, atc, checkout, either, low, medium, high, {_pct('n', 'whole')} AS share, distinct_scores, rank FROM (SELECT *, sum(n) OVER (PARTITION BY version) AS whole, count(*) OVER (PARTITION BY version) AS distinct_scores, row_number() OVER (PARTITION BY version ORDER BY n DESC, score)::INTEGER AS rank FROM (SELECT version, score, {COUNTED}, count(*) FILTER (bucket = 'low') AS low, count(*) FILTER (bucket = 'medium') AS medium, count(*) FILTER (bucket = 'high') AS high FROM vl GROUP BY ALL)) WHERE rank <= 5"),
    "ev_bucket_stages": (LONG, f"""SELECT *, {_pct('n', 'sum(n) OVER (PARTITION BY version, "group")')} AS share_of_bucket FROM (SELECT version, "group", st AS stage, {COUNTED} FROM (SELECT *, bucket AS "group", stage AS st FROM vl WHERE bucket <> 'low' UNION ALL SELECT *, 'capped_from_high', NULL FROM vl WHERE free = 'high' AND bucket = 'medium') GROUP BY ALL)"""),
    "ev_stage_effects": (LONG, f"SELECT version, n, floored, {_pct('s0', 'n')} AS stage0_share, {_pct('s1', 'n')} AS stage1_share, {_pct('s2', 'n')} AS stage2_share, {_round('r2 / nullif(r1, 0)', 3)} AS atc_lift_2_over_1 FROM (SELECT *, {_pct('a2', 's2')} AS r2, {_pct('a1', 's1')} AS r1 FROM (SELECT version, count(*) AS n, count(*) FILTER (bucket = 'low' AND free <> 'low') AS floored, " + ", ".join(f"count(*) FILTER (stage = {i}) AS s{i}, count(*) FILTER (stage = {i} AND add_to_cart_count > 0) AS a{i}" for i in range(3)) + " FROM vl GROUP BY ALL))"),
    "ev_zero_reduction": (LONG, f"SELECT f.*, distinct_scores, most_common, most_common_n, {_pct('base_zeros - zeros', 'base_zeros')} AS reduction_pct, {_pct('recovered', 'base_zeros')} AS recovered_pct FROM (SELECT version, count(*) FILTER (s0 = 0) AS base_zeros, count(*) FILTER (score = 0) AS zeros, count(*) FILTER (s0 = 0 AND score <> 0) AS recovered, count(*) FILTER (s0 <> 0 AND score = 0) AS new_zeros, " + ", ".join(f"count(*) FILTER (s0 = 0 AND score <> 0 AND bucket = '{b}') AS recovered_{b}" for b in ("low", "medium", "high")) + ", count(*) FILTER (s0 = 0 AND score <> 0 AND add_to_cart_count > 0) AS recovered_atc, count(*) FILTER (score = 0 AND raw <= 0) AS raw_zero, count(*) FILTER (score = 0 AND raw > 0) AS penalised_to_zero, min(score) FILTER (s0 = 0 AND score <> 0) AS recovered_min, max(score) FILTER (s0 = 0 AND score <> 0) AS recovered_max FROM zr GROUP BY version) f LEFT JOIN (SELECT version, count(*) AS distinct_scores, first(score ORDER BY n DESC, score) AS most_common, max(n) AS most_common_n FROM (SELECT version, score, count(*) AS n FROM zr WHERE s0 = 0 GROUP BY ALL) GROUP BY version) USING (version)", "zr AS (SELECT vl.*, o.score AS s0 FROM vl JOIN (SELECT session_id, score FROM vl WHERE version = 'V1') o USING (session_id) WHERE version <> 'V1')"),
    "ev_parity": (LONG, f"SELECT version, count(*) AS compared, count(*) FILTER (vl.bucket = o.bucket) AS equal, count(*) FILTER (vl.bucket <> o.bucket) AS movers, {_round('max(abs(vl.score - o.score))', 2)} AS max_difference FROM vl JOIN (SELECT session_id, bucket, score FROM vl WHERE version = 'V1') o USING (session_id) GROUP BY version"),
    "ev_stored_parity": (LONG, f"SELECT count(st) AS compared, count(*) FILTER (abs(score - st) <= 0.01) AS equal, {_round('max(abs(score - st))', 4)} AS max_difference, count(*) FILTER (st IS NOT NULL AND sb = bucket) AS equal_buckets, count(*) FILTER (st IS NULL) AS without_stored FROM (SELECT *, CASE WHEN session_no % 5 <> 0 THEN score + CASE WHEN session_no % 7 = 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END END AS st, CASE WHEN session_no % 3 = 0 THEN 'low' ELSE bucket END AS sb FROM bk WHERE status = 'scored')"),
    "ev_tv_distance": (LONG, f"SELECT a.version, {_round('0.5::DOUBLE * (abs(a.l - b.l) + abs(a.m - b.m) + abs(a.h - b.h))', 4)} AS distance FROM @SHARES a, @SHARES b WHERE b.version = 'V1'"),
    "ev_zero_scores": (LONG, f"SELECT *, {_pct('zeros', 'n')} AS zero_share, {_pct('blind_checkouts', 'checkouts')} AS blind_share_of_checkouts, blind_checkouts * 20 > zeros AS warn FROM (SELECT version, count(*) AS n, count(*) FILTER (score <= 0) AS zeros, count(*) FILTER (score <= 0 AND checkout_started_count > 0) AS blind_checkouts, count(*) FILTER (score <= 0 AND add_to_cart_count > 0) AS blind_carts, count(*) FILTER (score <= 0 AND raw > 0) AS raw_positive, count(*) FILTER (bo < 0) AS bounced, count(*) FILTER (score <= 0 AND ms > 5000) AS zeros_over_5s, count(*) FILTER (checkout_started_count > 0) AS checkouts FROM vl GROUP BY ALL)"),
    "ev_threshold_shift": (LONG, "SELECT *, " + ", ".join(f"{_round(f'eligible_p{p} - all_p{p}', 4)} AS shift_p{p}" for p in (35, 50, 72, 90)) + " FROM (SELECT version, " + ", ".join(f"{_pick(c, f'len({c})', p / 100)} AS {t}_p{p}" for t, c in (("all", "a"), ("eligible", "e"), ("s0", "x"), ("s1", "y"), ("s2", "z")) for p in (35, 50, 72, 90)) + " FROM (SELECT version, list_sort(list(score)) AS a, list_sort(list(score) FILTER (stage >= 1)) AS e, list_sort(list(score) FILTER (stage = 0)) AS x, list_sort(list(score) FILTER (stage = 1)) AS y, list_sort(list(score) FILTER (stage = 2)) AS z FROM vl WHERE score > 0 GROUP BY ALL))"),
    "ev_duration_bands": (LONG, f"""SELECT *, {_pct('n', 'sum(n) OVER (PARTITION BY "group")')} AS share, coalesce(sum(CASE WHEN band = 'under_1s' THEN n END) OVER (PARTITION BY "group"), 0) * 2 >= sum(n) OVER (PARTITION BY "group") AS clustered FROM (SELECT "group", CASE WHEN ms < 1000 THEN 'under_1s' WHEN ms < 5000 THEN '1_5s' WHEN ms < 10000 THEN '5_10s' WHEN ms < 30000 THEN '10_30s' ELSE 'over_30s' END AS band, {COUNTED} FROM (SELECT *, unnest(['all', CASE WHEN score = 0 THEN 'v1_zero' END, 'stage' || stage, CASE WHEN page_view_count = 1 AND product_view_count <= 1 AND useful_click_count = 0 AND scroll_count = 0 THEN 'landing' END]) AS "group" FROM vl WHERE version = 'V1') WHERE "group" IS NOT NULL GROUP BY 1, 2)"""),
    "ev_duration_diagnostics": (LONG, f"SELECT version, n AS sessions, l[1] AS least, l[n] AS most, {_pct('a', 'n')} AS over_5s, {_pct('b', 'n')} AS over_10s, {_pct('z', 'n')} AS exactly_0, {_pct('u', 'n')} AS under_1s, " + ", ".join(f"{_pick('l', 'n', p / 100)} AS p{p}" for p in (25, 50, 75, 90)) + " FROM (SELECT version, count(*) AS n, list_sort(list(ms / 1000.0::DOUBLE)) AS l, count(*) FILTER (ms > 5000) AS a, count(*) FILTER (ms > 10000) AS b, count(*) FILTER (ms = 0) AS z, count(*) FILTER (ms < 1000) AS u FROM vl WHERE version = 'V1' GROUP BY ALL)"),
    "ev_scroll_diagnostics": (LONG, f"SELECT count(*) AS sessions, count(*) FILTER (scroll_count > 0) AS with_scroll, sum(scroll_count)::BIGINT AS scrolls, max(scroll_count) AS most, {_pct('count(*) FILTER (scroll_count > 0)', 'count(*)')} AS scroll_rate, sum(scroll_count) = 0 AS inactive FROM vl WHERE version = 'V1'"),
    "ev_struggle_differences": (LONG, "SELECT version, count(*) FILTER (click_count >= 10 AND dead_click_count / click_count > p90) AS would_fire, version NOT IN ('V3', 'V5') AS applies FROM vl GROUP BY ALL"),
    "ev_purchases": (LONG, f"SELECT *, {_pct('purchases', 'sessions')} AS cvr, {_round('revenue / nullif(purchases, 0)', 2)} AS avg_order_value FROM (SELECT version, bucket, count(*) AS sessions, count(*) FILTER (add_to_cart_count > 0) AS purchases, coalesce(sum(event_count) FILTER (add_to_cart_count > 0), 0)::DOUBLE AS revenue FROM vl WHERE checkout_started_count > 0 GROUP BY ALL)"),
    "ev_composition": (LONG, "SELECT version, bucket, n AS sessions, " + ", ".join(f"{_round(f'{c} / n / 100.0::DOUBLE', 4)} AS {k}" for k, c in (("avg_score", "a"), ("avg_product_views", "b"), ("avg_useful_clicks", "c"), ("avg_dead_clicks", "d"), ("avg_scrolls", "e"), ("avg_page_views", "f"))) + f", {_round('g / n / 1000.0::DOUBLE', 3)} AS avg_duration_s, {_pick('l', 'n', 0.5)} AS median_score, {_pick('m', 'n', 0.5)} AS median_duration_s, {_pct('atc', 'n')} AS atc_rate, {_pct('checkout', 'n')} AS checkout_rate, {_pct('either', 'n')} AS either_rate FROM (SELECT version, bucket, {COUNTED}, sum(CAST(round(score * 100) AS BIGINT))::BIGINT AS a, sum(product_view_count * 100)::BIGINT AS b, sum(useful_click_count * 100)::BIGINT AS c, sum(dead_click_count * 100)::BIGINT AS d, sum(scroll_count * 100)::BIGINT AS e, sum(page_view_count * 100)::BIGINT AS f, sum(ms)::BIGINT AS g, list_sort(list(score)) AS l, list_sort(list(ms / 1000.0::DOUBLE)) AS m FROM vl GROUP BY ALL)"),
    "ev_percentile_rules": (LONG, "SELECT version, n, " + ", ".join(f"{_pick('l', 'n', p / 100)} AS p{p}" for p in (25, 50, 75, 90)) + ", l[1] AS least, l[n] AS most, median AS median, " + ", ".join(f"l[CAST(floor(n * {p} / 100) AS BIGINT) + 1] AS rebuild_p{p}" for p in (50, 75, 90)) + " FROM (SELECT version, count(*) AS n, list_sort(list(score)) AS l, median(score) AS median FROM vl GROUP BY ALL)"),
    "ev_thresholds": (LONG, "SELECT version, p35, p72, CASE WHEN n >= 200 THEN 'percentile' WHEN n > 0 THEN 'percentile_small_sample' ELSE 'no_engaged_sessions' END AS method, n AS population, 'common' AS mode FROM vc UNION ALL SELECT version, CASE WHEN n >= 200 THEN p35 ELSE 25.0 END, CASE WHEN n >= 200 THEN p72 ELSE 55.0 END, CASE WHEN n >= 200 THEN 'percentile' ELSE 'fixed_fallback' END, n, 'production' FROM vc"),
    "ev_results": (LONG, f"SELECT session_id, version, 'scored' AS status, NULL::VARCHAR AS reason, {_round('score', 4)} AS score, {_round('raw', 4)} AS raw_score, bo::DOUBLE AS bounce, bucket, free AS bucket_without_floor, CASE WHEN population >= 500 THEN 'percentile' WHEN population > 0 THEN 'percentile_small_sample' ELSE 'no_engaged_sessions' END AS method, population, {_round('p35', 4)} AS p35, {_round('p72', 4)} AS p72, event_count FROM vl WHERE version IN ('V1', 'V5') UNION ALL SELECT session_id, v, 'excluded', status, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, event_count FROM sc, (VALUES ('V1'), ('V5')) t(v) WHERE status <> 'scored' UNION ALL SELECT session_id, 'V9', 'error', 'unknown version', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, event_count FROM sc WHERE status = 'scored'"),
    "ev_result_table": (LONG, f"""SELECT b.session_id, 'b' AS brand_id, {START}, version, {_round('r.score', 4)} AS score, r.bucket AS bucket, CASE WHEN r.score IS NULL THEN NULL WHEN entry_page_type = 'checkout' OR checkout_started_count > 0 OR add_to_cart_count > 0 THEN 'high' ELSE r.bucket END AS operational_bucket,
  CASE WHEN status <> 'scored' THEN 'excluded' WHEN r.score IS NULL THEN 'error' ELSE 'scored' END AS status, CASE WHEN status <> 'scored' THEN status END AS exclusion_reason, CASE WHEN status = 'scored' AND r.score IS NULL THEN 'missing: deepest_scroll' END AS error_reason,
  CASE WHEN r.score IS NOT NULL THEN concat_ws('|', CASE WHEN version = 'V5' THEN ['stage_0_passive', 'stage_1_exploration', 'stage_2_strong'][stage + 1] END, CASE WHEN version = 'V5' AND page_view_count >= 2 THEN 'bonus_page_views_ge2' END, CASE WHEN version = 'V5' AND product_view_count >= 2 THEN 'bonus_product_views_ge2' END,
    CASE WHEN version = 'V5' AND useful_click_count >= 2 THEN 'bonus_useful_clicks_ge2' END, CASE WHEN version = 'V5' AND useful_click_count >= 5 THEN 'bonus_useful_clicks_ge5' END, CASE WHEN version = 'V5' AND product_view_count >= 2 AND page_view_count >= 2 THEN 'bonus_product_and_pages' END,
    CASE WHEN version <> 'V5' AND stuck < 0 THEN 'struggle_penalty' END, CASE WHEN short > 0 THEN CASE WHEN version = 'V5' THEN 'bounce_adjustment' ELSE 'bounce_penalty' END END, 'page_modifier_' || ['other', 'home', 'collection', 'pdp', 'checkout'][page_rank]) END AS reason_codes,
  CASE WHEN r.score IS NOT NULL AND version <> 'V1' THEN stage END AS evidence_stage, r.free AS bucket_without_floor, product_view_count AS product_views, useful_click_count AS useful_clicks, dead_click_count AS dead_clicks, click_count, scroll_count AS scrolls, page_view_count AS page_views, {_round('ms / 60000.0::DOUBLE', 4)} AS minutes,
  event_count, add_to_cart_count, checkout_started_count, entry_page_type, ['other', 'home', 'collection', 'pdp', 'checkout'][page_rank] AS highest_page_type, CASE WHEN r.score IS NOT NULL THEN CASE WHEN version = 'V5' THEN 0.0::DOUBLE ELSE stuck END END AS struggle_penalty, r.bo::DOUBLE AS bounce_penalty, CASE WHEN r.score IS NOT NULL THEN modifier END AS page_modifier,
  {_round('r.raw', 4)} AS raw_score, {_round('r.p35', 4)} AS p35, {_round('r.p72', 4)} AS p72, {_round('b.p90', 4)} AS p90, CASE WHEN r.score IS NOT NULL THEN CASE WHEN population >= 500 THEN 'percentile' ELSE 'percentile_small_sample' END END AS threshold_method,
  {_round('b.score', 4)} AS production_score, b.bucket AS production_bucket, CASE WHEN status = 'scored' THEN 'scored' ELSE 'excluded' END AS production_status, CASE WHEN checkout_started_count > 0 THEN add_to_cart_count > 0 END AS purchased, CASE WHEN checkout_started_count > 0 THEN event_count::DOUBLE END AS order_value
  FROM bk b CROSS JOIN (VALUES ('V1'), ('V1C'), ('V5'), ('VS')) t(version) LEFT JOIN (SELECT session_id, version, score, raw, bo, bucket, free, p35, p72, population FROM vl UNION ALL SELECT session_id, 'VS', score, raw, bo, CASE WHEN stage = 0 THEN 'low' ELSE free END, free, p35, p72, n FROM vs2) r USING (session_id, version)""",
     f"""vs0 AS (SELECT sc.*, sc.raw1 + least(d::DOUBLE, 100.0::DOUBLE) * 0.1::DOUBLE AS raws FROM sc JOIN (SELECT session_id, max(scroll_percent) AS d FROM ins GROUP BY ALL) USING (session_id) WHERE status = 'scored' AND d IS NOT NULL),
vs1 AS (SELECT session_id, stage, raws AS raw, CASE WHEN short > 0 THEN -20 ELSE 0 END AS bo, {_score('raws', 'stuck', -20, -20)} AS score FROM vs0),
vs2 AS (SELECT *, CASE WHEN score <= 0 OR score < p35 THEN 'low' WHEN score < p72 THEN 'medium' ELSE 'high' END AS free FROM vs1, (SELECT n, {_pick('l', 'n', 0.35)} AS p35, {_pick('l', 'n', 0.72)} AS p72 FROM (SELECT count(*) FILTER (score > 0) AS n, list_sort(list(score) FILTER (score > 0)) AS l FROM vs1)))"""),
    "ev_replays": (LONG, "SELECT session_id, version, score, bucket, method FROM rb", "@REPLAYS"),
    "ev_distribution": (LONG, f"SELECT version, scored, low, medium, high, zero_score, {_pct('low', 'scored')} AS low_pct, {_pct('medium', 'scored')} AS medium_pct, {_pct('high', 'scored')} AS high_pct, {_pct('zero_score', 'scored')} AS zero_score_pct, total, excluded, {_pct('excluded', 'total')} AS excluded_pct FROM (SELECT version, count(*) AS scored, count(*) FILTER (bucket = 'low') AS low, count(*) FILTER (bucket = 'medium') AS medium, count(*) FILTER (bucket = 'high') AS high, count(*) FILTER (score = 0) AS zero_score FROM rb GROUP BY ALL), (SELECT count(*) AS total, count(*) FILTER (status <> 'scored') AS excluded FROM sc)", "@REPLAYS"),
    "ev_threshold_summary": (LONG, "SELECT " + ", ".join(f"{_round(f'(sum(CAST(round({c} * 100000000) AS HUGEINT) * population) FILTER ({c} IS NOT NULL))::DOUBLE / nullif(sum(population) FILTER ({c} IS NOT NULL), 0)::DOUBLE / 100000000::DOUBLE', 4)} AS {c}" for c in ("p35", "p72", "p90")) + ", sum(population)::BIGINT AS population, count(*) FILTER (basis = 'fixed_fallback') AS fallback_days, count(*) AS days FROM ca LEFT JOIN p9 USING (sday)"),
    "ev_other_paths": (LONG, "SELECT path AS page_path, count(DISTINCT session_id) AS sessions FROM ev WHERE event_name = 'page_viewed' AND url <> '' AND ptype = 'other' GROUP BY path ORDER BY sessions DESC, page_path LIMIT 25"),
    "ev_struggle": (LONG, f"SELECT n AS sessions, {', '.join(f"{_round(_pick('l', 'n', p / 100), 4)} AS p{p}" for p in (50, 75, 80, 85, 90, 95, 99))}, {_round('l[n]', 4)} AS most, len(list_filter(l, lambda r: r >= 1)) AS all_dead, {_pct('len(list_filter(l, lambda r: r >= 1))', 'n')} AS all_dead_pct, len(list_filter(l, lambda r: r >= 0.9::DOUBLE)) AS ninety_plus, len(list_filter(l, lambda r: r >= 0.5::DOUBLE)) AS fifty_plus, len(list_filter(l, lambda r: r > {_pick('l', 'n', 0.9)})) AS above_p90, len(list_filter(l, lambda r: r >= {_pick('l', 'n', 0.9)})) AS from_p90, scored, n - scored AS excluded FROM (SELECT count(*) AS n, coalesce(list_sort(list(dead_click_count / click_count)), []) AS l, count(*) FILTER (status = 'scored') AS scored FROM bk WHERE click_count >= 10)"),
    "ev_page_types": (LONG, f"SELECT ['other', 'home', 'collection', 'pdp', 'checkout'][page_rank] AS page_type, count(*) AS n, {_round('sum(CAST(round(score * 100) AS BIGINT))::BIGINT / count(*) / 100.0::DOUBLE', 4)} AS avg_score, count(*) FILTER (bucket = 'low') AS low, count(*) FILTER (bucket = 'medium') AS medium, count(*) FILTER (bucket = 'high') AS high, count(*) FILTER (stuck < 0) AS stuck FROM bk WHERE status = 'scored' GROUP BY page_rank"),
    "dq_score_frequency": (LONG, f"SELECT score, n, {_ratio('sum(n) OVER (ORDER BY n DESC, score ROWS UNBOUNDED PRECEDING)', 'sum(n) OVER ()')} AS running_share FROM (SELECT score, count(*) AS n FROM bk WHERE status = 'scored' GROUP BY ALL)"),
    "dq_feature_rollup": (LONG, "SELECT CASE WHEN grouping(bucket) = 1 THEN 'all' ELSE bucket END AS bucket, count(*) AS n, " + ", ".join(f"{_round(f'avg({c})', 4)} AS {c}" for c in ("event_count", "page_view_count", "product_view_count", "click_count", "useful_click_count", "dead_click_count", "scroll_count")) + " FROM bk WHERE status = 'scored' GROUP BY ROLLUP (bucket)"),
    "dq_health": (LONG, "SELECT count(*) FILTER (page_view_count = 0 AND product_view_count = 0 AND ct) AS carts_without_browsing, count(*) FILTER (score <= 0 AND ct) AS score_blind, count(session_id) - count(DISTINCT session_id) AS duplicate_sessions, (SELECT count(event_id) - count(DISTINCT event_id) FROM ev) AS duplicate_events FROM (SELECT *, add_to_cart_count > 0 OR checkout_started_count > 0 AS ct FROM bk)"),
    "dq_why_low": (LONG, "SELECT level, CASE level WHEN 'low' THEN CASE WHEN br AND st THEN 'short and no engagement' WHEN br THEN 'short' ELSE 'no engagement' END WHEN 'medium' THEN CASE WHEN click_count = 0 AND (ca OR co) THEN 'no click' WHEN click_count = 0 THEN 'scroll only' ELSE 'no cart or checkout' END WHEN 'high' THEN CASE WHEN ca AND co THEN 'cart and checkout' WHEN ca THEN 'cart' ELSE 'checkout' END ELSE 'bot' END AS cause, count(*) AS sessions, max(CASE level WHEN 'high' THEN 1 WHEN 'medium' THEN 2 WHEN 'low' THEN 3 ELSE 0 END) AS place FROM (SELECT *, CASE WHEN status = 'bot' THEN 'unclassified' WHEN br OR st THEN 'low' WHEN click_count > 0 AND (ca OR co) THEN 'high' ELSE 'medium' END AS level FROM (SELECT *, ms < 5000 AS br, click_count = 0 AND scroll_count = 0 AS st, add_to_cart_count > 0 AS ca, checkout_started_count > 0 AS co FROM bk)) GROUP BY 1, 2"),
    "dq_score_percentiles": (LONG, "SELECT n AS scored, l[1] AS least, l[n] AS most, med AS median, ds AS distinct_scores, mo AS mode, mc AS mode_count, " + ", ".join(f"{_pick('l', 'n', p / 100)} AS p{p}" for p in (10, 25, 35, 50, 72, 75, 90, 95)) + " FROM (SELECT count(*) AS n, list_sort(list(score)) AS l, median(score) AS med, count(DISTINCT score) AS ds FROM bk WHERE status = 'scored'), (SELECT score AS mo, count(*) AS mc FROM bk WHERE status = 'scored' GROUP BY score ORDER BY mc DESC, score LIMIT 1)"),
    "dq_buckets": (LONG, "SELECT 'predictive' AS kind, coalesce(bucket, '(null)') AS bucket, count(*) AS n FROM bk WHERE status = 'scored' GROUP BY 2 UNION ALL SELECT 'operational', coalesce(operational_bucket, '(null)'), count(*) FROM bk WHERE status = 'scored' GROUP BY 2 UNION ALL SELECT 'visitor', coalesce(bucket, '(null)'), count(*) FROM (SELECT *, row_number() OVER (PARTITION BY identity ORDER BY score DESC NULLS LAST, session_id) AS k FROM bk) WHERE k = 1 GROUP BY 2"),
    "dq_cohorts": (LONG, f"SELECT cohort, count(*) AS sessions, {_round('sum(CAST(round(score * 100) AS BIGINT))::BIGINT / count(*) / 100.0::DOUBLE', 4)} AS avg_score, count(*) FILTER (bucket = 'high') AS high, count(*) FILTER (bucket = 'medium') AS medium, count(*) FILTER (bucket = 'low') AS low FROM (SELECT *, unnest([CASE WHEN product_view_count > 0 THEN 'with product views' ELSE 'without product views' END, CASE WHEN add_to_cart_count > 0 THEN 'with add to cart' END, CASE WHEN checkout_started_count > 0 THEN 'with checkout started' END, CASE WHEN click_count = 0 AND scroll_count = 0 AND product_view_count = 0 AND add_to_cart_count = 0 AND checkout_started_count = 0 THEN 'page views only' END, CASE WHEN event_count <= 2 OR ms < 5000 THEN 'bounced' ELSE 'not bounced' END]) AS cohort FROM bk WHERE status = 'scored') WHERE cohort IS NOT NULL GROUP BY cohort"),
    "dq_features_by_bucket": (LONG, "SELECT kind, b AS bucket, count(*) AS sessions, " + ", ".join(f"{_round(f'avg({c})', 4)} AS avg_{c}" for c in ("product_view_count", "page_view_count", "scroll_count", "useful_click_count", "dead_click_count", "event_count")) + f", {_round('avg(ms) / 1000', 4)} AS avg_seconds, {_pct('count(*) FILTER (add_to_cart_count > 0)', 'count(*)')} AS pct_atc, {_pct('count(*) FILTER (checkout_started_count > 0)', 'count(*)')} AS pct_checkout, {_pct('count(*) FILTER (event_count <= 2 OR ms < 5000)', 'count(*)')} AS pct_bounced, {_round('sum(CAST(round(score * 100) AS BIGINT))::BIGINT / count(*) / 100.0::DOUBLE', 4)} AS avg_score, CASE b WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END AS place FROM (SELECT *, 'predictive' AS kind, bucket AS b FROM bk UNION ALL SELECT *, 'operational', operational_bucket FROM bk) WHERE status = 'scored' GROUP BY kind, b"),
    "dq_bounce_rule": (LONG, "SELECT count(*) FILTER (event_count <= 2) AS two_or_fewer_events, count(*) FILTER (ms < 5000) AS under_5s, count(*) FILTER (event_count <= 2 AND ms >= 5000) AS by_event_count_only, count(*) FILTER (ms < 5000 AND event_count > 2) AS by_duration_only, count(*) AS scored FROM bk WHERE status = 'scored'"),
    "dq_clicks": (LONG, f"SELECT CAST(day AS VARCHAR) AS day, clicks, useful, dead, unclassified, {_pct('dead', 'clicks')} AS dead_pct FROM (SELECT day, count(*) AS clicks, count(*) FILTER (click_bucket = 'useful_click') AS useful, count(*) FILTER (click_bucket = 'dead_click') AS dead, count(*) FILTER (click_bucket IS NULL) AS unclassified FROM ev WHERE event_name = 'click' GROUP BY day)"),
    "dq_freshness": (LONG, "SELECT strftime(max(received_at), '%Y-%m-%d %H:%M:%S') AS last_received, last(event_id ORDER BY received_at, seq) AS last_event, strftime((SELECT max(session_end) FROM ss), '%Y-%m-%d %H:%M:%S') AS last_session_end, CAST((SELECT max(sday) FROM ca) AS VARCHAR) AS last_threshold_day FROM act"),
    "dq_against_external": (LONG, f"SELECT bucket, external_pct, sessions, visitors, own_pct, {_round('own_pct - external_pct', 2)} AS delta_pp FROM (SELECT *, {_pct('sessions', 'sum(sessions) OVER ()')} AS own_pct FROM (SELECT b AS bucket, x AS external_pct, count(bk.bucket) AS sessions, count(DISTINCT identity) AS visitors FROM (VALUES ('low', 50.0::DOUBLE), ('medium', 30.0::DOUBLE), ('high', 20.0::DOUBLE)) t(b, x) LEFT JOIN bk ON status = 'scored' AND bk.bucket = t.b GROUP BY ALL))"),
    "dq_bounce_impact": (LONG, f"""SELECT CASE WHEN event_count <= 2 AND ms < 5000 THEN 'both' WHEN event_count <= 2 THEN 'events only' WHEN ms < 5000 THEN 'duration only' ELSE 'no penalty' END AS "group", count(*) AS sessions, {_round('sum(CAST(round(score * 100) AS BIGINT))::BIGINT / count(*) / 100.0::DOUBLE', 4)} AS avg_score, {_pct('count(*) FILTER (score = 0)', 'count(*)')} AS zero_pct, """ + ", ".join(f"""{_pct(f"count(*) FILTER (bucket = '{b}')", 'count(*)')} AS {b}_pct""" for b in ("high", "medium", "low")) + " FROM bk WHERE status = 'scored' GROUP BY 1"),
    "dq_override_impact": (LONG, f"SELECT count(*) AS scored, count(*) FILTER (add_to_cart_count > 0) AS with_atc, count(*) FILTER (checkout_started_count > 0) AS with_checkout, count(*) FILTER (entry_page_type = 'checkout') AS entered_on_checkout, count(*) FILTER (operational_bucket = 'high') AS operational_high, count(*) FILTER (bucket = 'high') AS predictive_high, count(*) FILTER (operational_bucket = 'high' AND bucket <> 'high') AS forced_high, {_pct(HIGH, 'count(*)')} AS operational_high_pct FROM bk WHERE status = 'scored'"),
    "dq_premature_closes": (LONG, f"SELECT *, {_pct('premature', 'closed')} AS premature_pct FROM (SELECT CAST(sday AS VARCHAR) AS day, count(*) AS sessions, count(*) FILTER (closed) AS closed, count(*) FILTER (closed AND session_no % 3 = 2) AS premature FROM sw GROUP BY sday)"),
    "dq_open_cursors": (LONG, "SELECT count(*) AS open, strftime(max(session_end), '%Y-%m-%d %H:%M:%S') AS newest FROM sw WHERE NOT closed"),
    "snk_insert_new": (LONG, "SELECT * FROM h1 UNION ALL SELECT * FROM h2 WHERE identity NOT IN (SELECT identity FROM h1)", "@HALVES"),
    "snk_upsert": (LONG, "SELECT * FROM h2 UNION ALL SELECT * FROM h1 WHERE identity NOT IN (SELECT identity FROM h2)", "@HALVES"),
    "snk_update_join": (LONG, "SELECT h1.identity, CASE WHEN h2.n > 5 THEN h2.n ELSE h1.n END AS n, h1.version FROM h1 LEFT JOIN h2 USING (identity)", "@HALVES"),
    "snk_delete_unchanged": (LONG, "SELECT * FROM h1 WHERE NOT EXISTS (SELECT 1 FROM h2 WHERE h2.identity = h1.identity AND h2.version = h1.version)", "@HALVES"),
    "snk_coalesce_upsert": (LONG, "SELECT identity, coalesce(b.u, a.u) AS first_utm_source FROM (SELECT identity, min(first_utm_source) AS u FROM ss WHERE session_no <= 3 GROUP BY ALL) a FULL JOIN (SELECT identity, max(first_utm_source) AS u FROM ss WHERE session_no > 3 GROUP BY ALL) b USING (identity)"),
    "snk_stale_keys": (LONG, "SELECT DISTINCT CAST(day AS VARCHAR) AS day, path AS page_path FROM ev o WHERE event_name = 'click' AND day IN (SELECT day FROM ev WHERE event_name = 'page_viewed') AND NOT EXISTS (SELECT 1 FROM ev n WHERE n.event_name = 'page_viewed' AND n.day = o.day AND n.path = o.path)"),
}

MACROS = {
    "@SEQ": "(SELECT *, left(array_to_string(c[:15], '>') || CASE WHEN len(c) > 15 THEN '>...' ELSE '' END, 500) AS sq FROM (SELECT *, list_filter(names, lambda x, i: i = 1 OR x <> names[i - 1]) AS c FROM ss))",
    "@JOURNEY": "(SELECT session_id, array_to_string(list_transform(list_filter(names, lambda x, i: i = 1 OR x <> names[i - 1]), lambda n: CASE n WHEN 'page_viewed' THEN 'PV' WHEN 'product_viewed' THEN 'PDV' WHEN 'product_added_to_cart' THEN 'ATC' WHEN 'checkout_started' THEN 'CO' WHEN 'click' THEN 'CL' WHEN 'scroll_depth' THEN 'SC' ELSE n END), ' > ') AS pattern FROM ss)",
    "@SHARES": "(SELECT version, count(*) FILTER (bucket = 'low') / count(*) AS l, count(*) FILTER (bucket = 'medium') / count(*) AS m, count(*) FILTER (bucket = 'high') / count(*) AS h FROM vl GROUP BY ALL)",
    "@CART": CART,
    "@TARGET": "tag, eid AS element_id, ename AS element_name, etype AS element_type, thref AS href, evalue AS value, md5(concat_ws('|', tag, eid, ename, etype, thref, evalue)) AS target_hash",
    "@CLICKS": "(SELECT *, CASE WHEN seq % 4 = 1 AND path <> '(unknown)' THEN path ELSE '' END AS thref FROM rt WHERE event_name = 'click')",
    "@HALVES": "h1 AS (SELECT identity, sum(event_count)::BIGINT AS n, max(session_no) AS version FROM ss WHERE session_no <= 3 GROUP BY ALL), h2 AS (SELECT identity, sum(event_count)::BIGINT AS n, max(session_no) AS version FROM ss WHERE session_no >= 2 GROUP BY ALL)",
    "@REASONS": """(SELECT *, regexp_extract(props, '(\\d+)', 1) AS k, CASE seq % 37 WHEN 0 THEN 'payload is not valid JSON' WHEN 1 THEN 'payload must be a JSON object' WHEN 2 THEN 'unsupported schema_version' WHEN 3 THEN 'unsupported type' WHEN 4 THEN 'event_id is required'
      WHEN 5 THEN 'brand_id must not be blank' WHEN 6 THEN 'type click and event_name click must go together' WHEN 7 THEN 'occurred_at must be an ISO timestamp ending in Z' WHEN 8 THEN 'occurred_at is not a valid ISO timestamp' WHEN 9 THEN 'referrer must be a string'
      WHEN 10 THEN 'visitor_id is longer than 100 characters' WHEN 11 THEN CASE WHEN event_name <> 'click' THEN 'signals must be an object' END WHEN 12 THEN CASE WHEN event_name = 'click' THEN 'click payload is required for a click' END
      WHEN 13 THEN CASE WHEN event_name = 'click' THEN 'invalid click_bucket' END WHEN 14 THEN CASE WHEN event_name = 'product_added_to_cart' THEN 'product_added_to_cart requires raw.product_id' END
      WHEN 15 THEN CASE WHEN event_name = 'product_added_to_cart' THEN 'raw.product_id is longer than 100 characters' END END AS reason FROM rt JOIN (SELECT event_id AS seq, props FROM events) USING (seq))""",
    "@REPLAYS": None,
    "@PAGES": f"""SELECT CAST(coalesce(v.day, c.day) AS VARCHAR) AS summary_date, coalesce(v.path, c.path) AS page_path, coalesce(v.n, 0)::BIGINT AS page_views, coalesce(v.ua, 0)::BIGINT AS unique_actors, coalesce(v.us, 0)::BIGINT AS unique_sessions, v.sp AS avg_scroll_percent, v.mx AS max_scroll_percent,
  coalesce(v.a, 0)::BIGINT AS add_to_cart_events, coalesce(v.k, 0)::BIGINT AS checkout_started_events, coalesce(c.n, 0) AS clicks, coalesce(c.u, 0) AS useful_clicks, coalesce(c.d, 0) AS dead_clicks, {_ratio("coalesce(c.d, 0)", "coalesce(c.n, 0)")} AS dead_click_rate
  FROM (SELECT day, path, sum(n) AS n, sum(ua) AS ua, sum(us) AS us, {_round("(sum(sp * n::HUGEINT) FILTER (sp IS NOT NULL))::DOUBLE / (sum(n) FILTER (sp IS NOT NULL))::DOUBLE / 1000000000::DOUBLE", 2)} AS sp, max(mx) AS mx, sum(a) AS a, sum(k) AS k FROM (SELECT day, raw, path, count(*) AS n, count(DISTINCT actor_id) AS ua, count(DISTINCT session_id) AS us,
    CAST(floor(sum(CAST(round(scroll_percent * 1000000) AS BIGINT))::DOUBLE / count(scroll_percent) * 1000 + 0.5::DOUBLE) AS HUGEINT) AS sp, max(scroll_percent) AS mx,
    count(*) FILTER (event_name = 'product_added_to_cart') AS a, count(*) FILTER (event_name = 'checkout_started') AS k FROM ev WHERE event_name <> 'click' AND url <> '' GROUP BY ALL) GROUP BY day, path) v
  FULL JOIN (SELECT day, path, count(*) AS n, count(*) FILTER (click_bucket = 'useful_click') AS u, count(*) FILTER (click_bucket = 'dead_click') AS d FROM ev WHERE event_name = 'click' GROUP BY ALL) c ON v.day = c.day AND v.path = c.path""",
}


def _replays() -> str:
    plain, revised = "modifier", "[0.90::DOUBLE, 0.95, 1.00, 1.05, 1.15][page_rank]"
    variants = (("A", -20, plain, False, False), ("B", 0, plain, False, False), ("C", 0, plain, True, False), ("D", -20, revised, False, False), ("E", -20, plain, False, True), ("F", 0, revised, True, True), ("F2", 0, revised, True, False))
    rows = []
    for name, bounce, modifier, zero, everyone in variants:
        score = _round(f"greatest(0.0::DOUBLE, least((raw1 + stuck + CASE WHEN short > 0 THEN {bounce}.0::DOUBLE ELSE 0.0::DOUBLE END) * {modifier}, 100.0::DOUBLE))", 2)
        score = f"CASE WHEN event_count <= 2 AND ms < 5000 AND useful_click_count = 0 AND scroll_count = 0 THEN 0.0::DOUBLE ELSE {score} END" if zero else score
        rows.append(f"SELECT session_id, sday, '{name}' AS version, {score} AS score, {str(everyone).lower()} AS everyone FROM sc WHERE status = 'scored'")
    return f"""rp AS ({' UNION ALL '.join(rows)}), rt0 AS (SELECT version, sday, count(*) FILTER (everyone OR score > 0) AS n, list_sort(list(score) FILTER (everyone OR score > 0)) AS l FROM rp GROUP BY ALL),
rt1 AS (SELECT version, sday, n, CASE WHEN n >= 500 THEN {_pick('l', 'n', 0.35)} ELSE 25.0::DOUBLE END AS p35, CASE WHEN n >= 500 THEN {_pick('l', 'n', 0.72)} ELSE 55.0::DOUBLE END AS p72, CASE WHEN n >= 500 THEN 'percentile' ELSE 'fixed_fallback' END AS method FROM rt0),
rb AS (SELECT rp.*, method, CASE WHEN score <= 0 OR score < p35 THEN 'low' WHEN score < p72 THEN 'medium' ELSE 'high' END AS bucket FROM rp JOIN rt1 USING (version, sday))"""


MACROS["@REPLAYS"] = _replays()


def oracles() -> dict[str, str]:
    out = {}
    for name, (how, *parts) in SELECTS.items():
        for _ in range(2):
            for macro, text in MACROS.items():
                parts = [p.replace(macro, text) for p in parts]
        select, more = parts[0], "".join(f", {p}" for p in parts[1:])
        out[name] = base(*how).rstrip() + more + "\n" + select
    return out
